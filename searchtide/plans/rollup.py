"""Sums per day from which the reports are answered, kept up to date for changed days only.

Three tables, all of them additive over days: *cells* (day, hour, platform, genre), *keywords* (day, keyword, genre, platform) and *sketches*
(the distinct keywords of a day as a mergeable HyperLogLog sketch). They are published together as versions
(:mod:`searchtide.sources.versions`); a version notes which version of the curated table it stands for. A refresh looks up which days the
curated table has changed since, reads the folders of these days, and replaces their sums.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.plans import reports
from searchtide.schemas import CURATED
from searchtide.sources import versions

_COUNTS = [T.StructField(m, T.LongType()) for m in reports.MEASURES]
_DAY = T.StructField("dt", T.StringType())
CELLS = T.StructType([
    _DAY, T.StructField("hour_of_day_vn", T.IntegerType()), T.StructField("platform_group", T.StringType()),
    T.StructField("derived_genre", T.StringType()), *_COUNTS,
])
KEYWORDS = T.StructType([
    _DAY, T.StructField("keyword_norm", T.StringType()), T.StructField("derived_genre", T.StringType()),
    T.StructField("platform_group", T.StringType()), *[c for c in _COUNTS if c.name in ("searches", "abandoned")],
])
SKETCHES = T.StructType([_DAY, T.StructField("sketch", T.BinaryType())])
KINDS = {"cells": CELLS, "keywords": KEYWORDS, "sketches": SKETCHES}
#: sketches have 2^SKETCH_BITS registers: an error of about 0.8 %
SKETCH_BITS = 14


def _sums(kind: str, rows: DataFrame) -> DataFrame:
    if kind == "sketches":
        return rows.groupBy("dt").agg(F.hll_sketch_agg("keyword_norm", SKETCH_BITS).alias("sketch"))
    schema = KINDS[kind]
    measures = tuple(c for c in reports.MEASURES if c in schema.names)
    return reports.tally(rows, *[c for c in schema.names if c not in reports.MEASURES], measures=measures)


def changed_days(spark: SparkSession, table: str, since: int, upto: int) -> list[str]:
    """Day folders of the curated table (``dt=...``) that its versions after ``since`` touched."""
    touched = {p.split("/")[0] for n in versions.numbers(spark, table) if since < n <= upto for p in versions.at(spark, table, n).touched}
    return sorted(p for p in touched if p.startswith("dt="))


def refresh_rollup(spark: SparkSession, table: str, root: str) -> list[str]:
    """Bring the rollup below ``root`` up to date with the curated table; returns the day folders that were read."""
    source, base = versions.current(spark, table), versions.current(spark, root)
    days = changed_days(spark, table, int(base.run or 0), source.number)
    if source.number == int(base.run or 0):
        return []
    wanted = [p for p in source.parts if p.split("/")[0] in set(days)]
    rows = versions.read(spark, table, CURATED, source, wanted)
    changes: dict[str, tuple[str, ...]] = {f"kind={kind}/{day}": () for kind in KINDS for day in days}
    if wanted:
        commit = versions.new_commit(root)
        for kind in KINDS:
            # a few rows for each keyword of a day; a day too large for one task is split
            summed = _sums(kind, rows).hint("rebalance", F.col("dt"))
            summed.write.partitionBy("dt").parquet(f"{commit}/kind={kind}")
        changes |= {p: w for p, w in versions.written_parts(spark, commit, 2).items()}
    versions.publish(spark, root, base, changes, str(source.number), also_read=base.parts)
    return days


def read_rollup(spark: SparkSession, root: str, kind: str, first: date | None = None, last: date | None = None) -> DataFrame:
    """One of the tables, or some days of it. All report functions that take a tally take cells or keywords."""
    version = versions.current(spark, root)
    low = "" if first is None else first.isoformat()
    high = "~" if last is None else last.isoformat()
    # the unnamed day has no date; it belongs to the table as a whole only
    whole = first is None and last is None
    parts = [p for p in version.parts if p.startswith(f"kind={kind}/dt=") and (whole or low <= p.split("/dt=")[1] <= high)]
    return versions.read(spark, root, KINDS[kind], version, parts)


def distinct_keywords(sketches: DataFrame) -> DataFrame:
    """About how many distinct keywords the days of the sketches have together; one row ``kw``."""
    merged = F.hll_union_agg("sketch")
    return sketches.agg(F.coalesce(F.hll_sketch_estimate(merged), F.lit(0).cast("long")).alias("kw"))
