"""Left lookup of a key in a dictionary-like table, whatever the size of either side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: largest table (bytes of key and value text) that is sent to every executor
BROADCAST_BYTES = 64 * 1024 * 1024


def text_bytes(table: DataFrame) -> int:
    """Measured size of a table of strings, with an allowance per row for the hash table."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in table.columns), F.lit(32))
    return table.agg(F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()["bytes"]


def attach(
    rows: DataFrame,
    table: DataFrame,
    key: str,
    value: str,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add ``value`` from ``table(key, value)`` to ``rows``; null where the key is not found.

    A table measured to be small is broadcast. A larger one is joined by shuffle: rows without a key are
    spread by their content, as they match nothing, and a key with very many rows is split by adaptive
    execution, which may split the left side of a left join.
    """
    pairs = table.select(key, value).where(F.col(key).isNotNull())
    unique = pairs.groupBy(key).agg(F.max(value).alias(value))
    if text_bytes(pairs) <= broadcast_bytes:
        return rows.join(F.broadcast(unique), key, "left")
    joined = "_lookup"
    apart = F.concat(F.lit("-"), F.xxhash64(*rows.columns).cast("string"))
    spread = rows.withColumn(joined, F.when(F.col(key).isNull(), apart).otherwise(F.concat(F.lit("+"), F.col(key))))
    keyed = unique.select(F.concat(F.lit("+"), F.col(key)).alias(joined), value)
    return spread.join(keyed, joined, "left").drop(joined)
