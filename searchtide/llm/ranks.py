"""Consecutive numbers for rows in a given order, without sorting them in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.shared import free_name, staged

#: bits of a row's place within its slice in ``monotonically_increasing_id``
_PLACE_BITS = 33


def ranked(rows: DataFrame, keys: list[Column], name: str, label: str = "ranks") -> DataFrame:
    """The rows with ``name``: 0, 1, 2, ... in the order of the keys. Staged in the shared folder.

    Rows are range-partitioned by the keys and, last, by their place in the input, so that even rows
    equal in all keys are spread. Slice and place of a row are fixed by writing them down; then the sizes of the
    slices before it are added. That table has one row per shuffle partition.
    """
    slices = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie, at = free_name(rows, "_tie"), free_name(rows, "_at")
    spread = rows.withColumn(tie, F.monotonically_increasing_id())
    order = [*keys, F.col(tie)]
    fixed = spread.repartitionByRange(slices, *order).sortWithinPartitions(*order).drop(tie)
    fixed = staged(fixed.withColumn(at, F.monotonically_increasing_id()), label)
    number, before, width = free_name(rows, "_slice"), free_name(rows, "_before"), free_name(rows, "_width")
    whole = fixed.withColumn(number, F.shiftright(at, _PLACE_BITS))
    widths = whole.groupBy(number).agg(F.count("*").alias(width))
    earlier = Window.orderBy(number).rowsBetween(Window.unboundedPreceding, -1)
    starts = widths.select(number, F.coalesce(F.sum(width).over(earlier), F.lit(0)).alias(before))
    place = F.col(at).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + F.col(before)
    return whole.join(F.broadcast(starts), number).select(*rows.columns, place.alias(name))
