"""One row per event id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def fingerprint(events: DataFrame) -> Column:
    """A number for the whole row, equal for equal rows."""
    return F.xxhash64(*sorted(events.columns))


def keep_first_event(events: DataFrame, keep_null_ids: bool = True) -> DataFrame:
    """Keep the earliest row of each ``eventid`` over all days.

    Order: event time, then day, then a fingerprint of the whole row, so the survivor is the same
    on every run. The fingerprint stands in for the remaining columns: the shuffle then carries
    only columns that are used later. All rows without an id count as one event, unless
    ``keep_null_ids`` is false, which drops them.

    ``row_number() = 1`` lets Spark keep one row per id in each map task before the shuffle, so an
    id (or the missing id) with very many copies does not gather in one task.
    """
    if not keep_null_ids:
        events = events.where(F.col("eventid").isNotNull())
    return earliest(events.withColumn("_fingerprint", fingerprint(events)), "eventid", "_fingerprint").drop("_fingerprint")


def earliest(events: DataFrame, key: str, mark: str) -> DataFrame:
    """The earliest row of each key; of several of one time and day, that with the least mark."""
    first = Window.partitionBy(key).orderBy("event_ts", "dt", mark)
    return events.withColumn("_copy", F.row_number().over(first)).where(F.col("_copy") == 1).drop("_copy")
