"""Promises the published tables must keep, as rows of (name, ok, detail)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.operators.access import exclusion_matches, hidden_columns
from searchtide.sources.curated import partition

SEARCH_ACTION = "search"


def _check(measured: DataFrame, name: str, ok, detail) -> DataFrame:
    """A contract row from a one-row table; a missing measure breaks the promise."""
    return measured.select(
        F.lit(name).alias("name"), F.coalesce(ok, F.lit(False)).alias("ok"), detail.cast("string").alias("detail"))


def raw_actions(raw: DataFrame) -> DataFrame:
    return raw.select("action").distinct()


def contract_checks(
    raw: DataFrame,
    curated: DataFrame,
    quality_results: DataFrame,
    trending: DataFrame,
    content_gaps: DataFrame,
    hour_genre: DataFrame,
    day: str,
    genre: str,
    min_listed: int = 100,
    min_cells: int = 200,
) -> DataFrame:
    rows = F.count(F.lit(1)).alias("n")
    n = F.col("n")
    top = trending.orderBy(F.desc("current_cnt"), "keyword_norm", "derived_genre").limit(1).agg(
        rows, F.first("keyword_norm").alias("keyword"), F.first("derived_genre").alias("genre"))
    listed = trending.select("keyword_norm").unionAll(content_gaps.select("keyword_norm"))
    actions = F.array_join(F.array_sort(F.collect_set("action")), ",").alias("actions")
    return reduce(DataFrame.unionByName, [
        _check(partition(curated, day, genre).agg(rows), "curated partition has rows", n > 0, n),
        _check(quality_results.agg(rows), "quality results are visible", n > 0, n),
        _check(raw.agg(actions), "raw action is search", F.col("actions") == SEARCH_ACTION, F.col("actions")),
        _check(top, "top trending row is a keyword",
               (F.col("genre") != "EMPTY_QUERY") & (F.trim("keyword") != ""), F.col("keyword")),
        _check(listed.agg(rows), "keyword lists are deep", n >= min_listed, n),
        _check(hour_genre.agg(rows), "hour matrix is complete", n >= min_cells, n),
    ])


def access_checks(curated: DataFrame, views: Mapping[str, str]) -> DataFrame:
    """Does the view of each role, as the catalog has it, hide exactly the columns the role must not see?"""
    rows = [
        (f"columns hidden from {role}", exclusion_matches(curated, view, role), ",".join(hidden_columns(role)) or "all columns visible")
        for role, view in views.items()
    ]
    return curated.sparkSession.createDataFrame(rows, "name string, ok boolean, detail string")
