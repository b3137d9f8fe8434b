"""Row counts along the curation job, and the alarm on lost rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions.moments import event_moment
from searchtide.vocab import FIRST_GOOD_YEAR, RETENTION_FLOOR

STAGES = ("raw_rows", "post_year_rows", "post_dedup_rows", "output_rows")


def retention(output: Column, raw: Column) -> Column:
    return F.when(raw > 0, output.cast("double") / raw.cast("double")).otherwise(0.0)


def with_alarm(counts: DataFrame, floor: float = RETENTION_FLOOR) -> DataFrame:
    """Add ``retention`` and ``retention_alarm`` to a row with the four counts; no raw rows means 0."""
    share = retention(F.col("output_rows"), F.col("raw_rows"))
    return counts.withColumn("retention", share).withColumn("retention_alarm", share < floor)


def lineage_counts(raw: DataFrame) -> DataFrame:
    """The counts of a run worked out from raw events alone, reading two columns.

    Everything after deduplication keeps every row, so the output count equals the one before it.
    """
    good = F.coalesce(F.year(event_moment(F.col("datetime"))) >= FIRST_GOOD_YEAR, F.lit(False))
    per_id = raw.select("eventid", good.alias("good")).groupBy("eventid").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("good").alias("good_rows"))
    distinct = F.count_if(F.col("good_rows") > 0)
    counts = per_id.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum("good_rows"), F.lit(0)).alias("post_year_rows"),
        distinct.alias("post_dedup_rows"),
        distinct.alias("output_rows"),
    )
    return with_alarm(counts)
