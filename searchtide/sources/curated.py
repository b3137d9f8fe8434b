"""The curated table: Parquet, partitioned by day and genre.

There are two ways to keep it. :func:`commit_curated` publishes versions (:mod:`searchtide.sources.versions`): readers never see half a
run, and genre folders that a rewritten day no longer has go with the same step. :func:`write_curated` replaces folders in
place, for tables that other engines read as plain folders. :func:`read_curated` reads both.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from searchtide.plans.curate import CurationRules, finished
from searchtide.schemas import CURATED
from searchtide.sources import folders, versions

PARTITIONS = ("dt", "derived_genre")


def write_curated(
    prepared: DataFrame,
    path: str,
    run_id: str = "unknown",
    rules: CurationRules = CurationRules(),
    one_file_per_group: bool = False,
) -> None:
    """Write prepared events, replacing the (day, genre) partitions they fall into.

    Rows are gathered by partition first, so a partition of normal size becomes one file.
    A partition too large for one task is split over several (adaptive rebalancing);
    ``one_file_per_group`` forbids that. Hashes and arrays are computed after the shuffle.
    """
    _written(prepared, run_id, rules, one_file_per_group).option("partitionOverwriteMode", "dynamic").parquet(path)


def _written(prepared: DataFrame, run_id: str, rules: CurationRules, one_file_per_group: bool) -> DataFrameWriter:
    keys = [F.col(k) for k in PARTITIONS]
    # the writer wants rows sorted by partition; sorted here, while they are narrow, they need no second
    # sort, provided the partition columns cannot be null
    named = prepared.withColumn("dt", F.coalesce("dt", F.lit("")))
    gathered = named.repartition(*keys) if one_file_per_group else named.hint("rebalance", *keys)
    gathered = gathered.sortWithinPartitions(*PARTITIONS)
    return finished(gathered, run_id, rules).write.mode("overwrite").option("compression", "snappy").partitionBy(*PARTITIONS)


def day_part(day: str) -> str:
    """Folder of a day; that of the unnamed day is Spark's for a missing value."""
    return f"dt={day or '__HIVE_DEFAULT_PARTITION__'}"


def commit_curated(
    prepared: DataFrame,
    root: str,
    run_id: str = "unknown",
    rules: CurationRules = CurationRules(),
    one_file_per_group: bool = False,
    clear_days: bool = True,
    base: versions.Version | None = None,
    days: Iterable[str] = (),
    also: Callable[[str], Mapping[str, tuple[str, ...]]] | None = None,
) -> versions.Version:
    """Publish a version in which the (day, genre) folders of ``prepared`` are replaced by it.

    ``clear_days`` also drops the other genre folders of the days written. The version started from (``base``, by default
    the newest when the work begins) decides what counts as a change by somebody else. ``days`` are days that are rewritten even if no
    row is left of them. ``also`` writes more into a commit folder it is given, and returns the changes that are published with the rows.
    """
    spark = prepared.sparkSession
    base = versions.current(spark, root) if base is None else base
    commit = versions.new_commit(root)
    _written(prepared, run_id, rules, one_file_per_group).parquet(commit)
    changes: dict[str, tuple[str, ...]] = dict(versions.written_parts(spark, commit, len(PARTITIONS)))
    if clear_days:
        rewritten = {part.split("/")[0] for part in changes} | {day_part(d) for d in days}
        changes = {part: () for part in base.parts if part.split("/")[0] in rewritten} | changes
    if also is not None:
        changes |= also(versions.new_commit(root))
    try:
        return versions.publish(spark, root, base, changes, run_id)
    except versions.Conflict:
        folders.remove(spark, commit)
        raise


def read_curated(spark: SparkSession, path: str) -> DataFrame:
    """The curated table, with its partition columns declared as text. Filters on them skip folders."""
    if versions.is_versioned(spark, path):
        newest = versions.current(spark, path)
        return versions.read(spark, path, CURATED, newest, [p for p in newest.parts if p.startswith("dt=")])
    return spark.read.schema(CURATED).parquet(path).select(*CURATED.names)


def remove_stale_partitions(spark: SparkSession, path: str, run_id: str, days: Column | None = None) -> list[str]:
    """Delete (day, genre) folders left in place by earlier runs on the days that ``run_id`` rewrote (:func:`write_curated`).

    Replacing partitions one by one leaves a folder behind when a day no longer has rows of a
    genre, for example after the keyword table moved its only keyword. Such a folder holds no
    row of this run, although its day does. ``days`` is a condition on ``dt`` for the days the run
    can have written, so that the others are not looked at.
    """
    if run_id == "unknown":
        raise ValueError("stale partitions can be told apart only by a run id of their own")
    mine = F.count_if(F.col("_pipeline_run_id") == run_id) > 0
    rows = read_curated(spark, path)
    groups = (rows if days is None else rows.where(days)).groupBy(*PARTITIONS).agg(mine.alias("mine"))
    # one row per folder: days times genres
    found = groups.collect()
    days = {g["dt"] for g in found if g["mine"]}
    stale = [f"{path}/dt={g['dt']}/derived_genre={g['derived_genre']}" for g in found if g["dt"] in days and not g["mine"]]
    for folder in stale:
        folders.remove(spark, folder)
    return stale


def newest_day(spark: SparkSession, path: str) -> date | None:
    """The latest day of the table, from the names of its folders; no file is opened."""
    if versions.is_versioned(spark, path):
        names = {p.split("/")[0] for p in versions.current(spark, path).parts}
    else:
        names = set(folders.subfolders(spark, path))
    days = [n[3:] for n in names if re.fullmatch(r"dt=\d{4}-\d{2}-\d{2}", n)]
    return date.fromisoformat(max(days)) if days else None


def days_between(rows: DataFrame, first: date, last: date) -> DataFrame:
    return rows.where(F.col("dt").between(first.isoformat(), last.isoformat()))


def partition(rows: DataFrame, day: str, genre: str) -> DataFrame:
    """Rows of one folder of the table."""
    return rows.where((F.col("dt") == day) & (F.col("derived_genre") == genre))
