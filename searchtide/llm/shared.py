"""What several operators need from the session: shipped code and tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.session import shared_folder
from searchtide.sources.folders import remove

#: rows of a narrow table that may be sent to every executor
BROADCAST_ROWS = 100_000


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the executors once per application, so that Python tasks can import it."""
    context = spark.sparkContext
    if getattr(context, "_searchtide_shipped", False):
        return spark
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="searchtide-code-"), "searchtide.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(root)))
    context.addPyFile(archive)
    context._searchtide_shipped = True
    return spark


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/searchtide/{name}-{uuid.uuid4().hex}"


def staged(rows: DataFrame, name: str) -> DataFrame:
    """Write rows to the shared folder and read them back: cuts lineage, survives lost executors."""
    spark, path = rows.sparkSession, new_folder(rows.sparkSession, name)
    rows.write.parquet(path)
    table = spark.read.schema(rows.schema).parquet(path)
    table._searchtide_folder = path
    return table


def released(*tables: DataFrame) -> None:
    """Remove staged tables that no later step reads, and the shuffle files of all steps that have ended.

    Spark keeps shuffle files until the driver's garbage is collected, which may be long after they are needed.
    """
    for table in tables:
        remove(table.sparkSession, table._searchtide_folder)
    tables[0].sparkSession.sparkContext._jvm.System.gc()


def shuffled(table: DataFrame) -> DataFrame:
    """A table that is joined by shuffle: Spark sizes it by compressed files, and does not count what explode adds."""
    return table.hint("merge")


def counted(table: DataFrame, most: int = BROADCAST_ROWS, items: str | None = None) -> DataFrame:
    """A staged narrow table, marked for broadcast if it is counted to have at most ``most`` rows, else for a shuffle.

    ``items`` names an array, which may have ten elements a row: at most ten times ``most`` elements in all rows.
    """
    size = F.size(items) if items else F.lit(0)
    n = table.agg(F.count("*").alias("rows"), F.sum(F.greatest(size, F.lit(0)).cast("long")).alias("items")).first()
    return F.broadcast(table) if n["rows"] <= most and (n["items"] or 0) <= 10 * most else shuffled(table)


#: a sieve is a bitmap of this many slots of so many words of 64 bits, whatever the number of keys
_SLOTS, _WORDS = 1 << 16, 16


def sieve(keys: DataFrame, key: str) -> DataFrame:
    """The hashes of all keys as a bitmap, marked for broadcast: always 2^26 bits. For :func:`in_sieve`."""
    hashed = F.xxhash64(key)
    word = F.shiftright(hashed, 22).bitwiseAND(F.lit(_WORDS - 1))
    bit = F.expr(f"shiftleft(1L, CAST(shiftright(xxhash64(`{key}`), 16) & 63 AS INT))")
    words = [F.bit_or(F.when(word == k, bit).otherwise(F.lit(0).cast("long"))) for k in range(_WORDS)]
    slots = keys.where(F.col(key).isNotNull()).groupBy(hashed.bitwiseAND(F.lit(_SLOTS - 1)).alias("slot")).agg(F.array(*words).alias("words"))
    return F.broadcast(staged(slots, "sieve"))


def in_sieve(key: Column, made: DataFrame) -> Column:
    """Condition of a join with a sieve: holds for all keys it was made of and a few others, never for null."""
    hashed = F.xxhash64(key)
    word = F.get(made["words"], F.shiftright(hashed, 22).bitwiseAND(F.lit(_WORDS - 1)).cast("int"))
    bit = F.shiftright(hashed, 16).bitwiseAND(F.lit(63)).cast("int")
    return (hashed.bitwiseAND(F.lit(_SLOTS - 1)) == made["slot"]) & key.isNotNull() & (F.call_function("getbit", word, bit) == 1)


def free_name(rows: DataFrame, name: str) -> str:
    """A column name that the rows do not have."""
    while name in rows.columns:
        name += "_"
    return name
