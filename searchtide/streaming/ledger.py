"""Which event ids have been seen, over any distance in time.

The ledger lies in bucket folders of a versioned table (:mod:`searchtide.sources.versions`), by hash of the id. Every batch adds one
file to each bucket it has ids for, and a Bloom filter for each of these files. A later batch tests its ids against the filters (about
2 bytes per id ever seen) and opens only the files that may know one of them; what it finds there is then joined by id. When
``MOST_FILES`` batches have gathered, they are merged into one.

An entry names the copy of the event that counts: its time, its day folder and a fingerprint of the row. Of several entries for an
id the least one holds; it only ever gets earlier.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.sources import folders, versions

BUCKETS = 64
#: files of a bucket before they are merged
MOST_FILES = 16
#: bits of one block of a filter, as ``bitmap_construct_agg`` makes it
_BLOCK_BITS = 32_768
_HASHES = 4
#: ids that a block is made for: 16 bits each, one wrong answer in 400
_BLOCK_IDS = 2_048
#: filters that are sent to every task as a whole; larger ones are joined by shuffles
_SENT_BYTES = 64 * 1024**2

ENTRY = T.StructType([
    T.StructField("id_key", T.StringType()), T.StructField("event_ts", T.TimestampType()),
    T.StructField("dt", T.StringType()), T.StructField("fingerprint", T.LongType()),
])
_FILTER = T.StructType([
    T.StructField("bucket", T.LongType()), T.StructField("blocks", T.LongType()), T.StructField("block", T.LongType()),
    T.StructField("bits", T.BinaryType()), T.StructField("commit", T.StringType()),
])
IDS, FILTERS = "kind=ids", "kind=filters"


def id_key(event_id: Column) -> Column:
    """The id as a key; a missing id is an id of its own."""
    return F.coalesce(F.concat(F.lit("+"), event_id), F.lit("-"))


def _bucket() -> Column:
    return F.pmod(F.xxhash64("id_key"), F.lit(BUCKETS))


def _block(blocks: Column) -> Column:
    return F.pmod(F.xxhash64("id_key", F.lit("block")), blocks)


def _positions() -> list[Column]:
    first, step = F.xxhash64("id_key", F.lit("a")), F.xxhash64("id_key", F.lit("b"))
    # in 31 bits each, so that nothing overflows
    first, step = (F.pmod(c, F.lit(2**31)) for c in (first, step))
    return [F.pmod(first + F.lit(k) * step, F.lit(_BLOCK_BITS)) for k in range(_HASHES)]


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, F.pmod(position, F.lit(8)).cast("int")) == 1


def add(entries: DataFrame, commit: str) -> dict[str, tuple[str, ...]]:
    """Write entries and their filters into a commit. Returns the folders to add to the table."""
    spark = entries.sparkSession
    entries.select(*ENTRY.names, _bucket().alias("bucket")).hint("rebalance", F.col("bucket")).write.partitionBy("bucket").parquet(f"{commit}/{IDS}")
    # the bucket comes from the folder
    written = spark.read.schema(T.StructType([*ENTRY.fields, T.StructField("bucket", T.LongType())])).parquet(f"{commit}/{IDS}")
    most = written.groupBy("bucket").count().agg(F.max("count")).first()[0] or 0
    blocks = max(1, -(-most // _BLOCK_IDS))
    # an id that is there twice sets the same bits twice
    marked = written.select(
        "bucket", F.lit(blocks).cast("long").alias("blocks"), _block(F.lit(blocks)).alias("block"), F.explode(F.array(*_positions())).alias("position"))
    filters = marked.groupBy("bucket", "blocks", "block").agg(F.bitmap_construct_agg("position").alias("bits"))
    filters.write.parquet(f"{commit}/{FILTERS}")
    own = commit.rsplit("/", 1)[1]
    buckets = [b for b in folders.subfolders(spark, f"{commit}/{IDS}") if "=" in b]
    return {f"{IDS}/{b}": (f"{own}/{IDS}/{b}",) for b in buckets} | {FILTERS: (f"{own}/{FILTERS}",)}


def candidates(spark: SparkSession, root: str, version: versions.Version, keys: DataFrame) -> DataFrame:
    """``id_key, commit, bucket`` for the keys that some file of the ledger may know, by its filter alone."""
    filters = versions.read(spark, root, _FILTER, version, [FILTERS])
    # a batch writes filters of one size; there are at most MOST_FILES of them
    written = filters.select("commit", "blocks").distinct().collect()
    sizes = [F.struct(F.lit(r["commit"]).alias("commit"), F.lit(r["blocks"]).alias("blocks")) for r in written]
    asked = keys.select("id_key", F.explode(F.array(*sizes)).alias("file")).select(
        "id_key", "file.commit", _bucket().alias("bucket"), _block(F.col("file.blocks")).alias("block"))
    # the planner knows no sizes but those of files, by which it may take the keys for the smaller side
    small = sum(r["blocks"] for r in written) * BUCKETS * _BLOCK_BITS // 8 <= _SENT_BYTES
    near = asked.join(filters.drop("blocks").hint("broadcast" if small else "merge"), ["commit", "bucket", "block"])
    # one condition after the other is compiled; a function over an array of positions is not
    return near.where(reduce(and_, [_bit(F.col("bits"), p) for p in _positions()])).select("id_key", "commit", "bucket")


def known(spark: SparkSession, root: str, version: versions.Version, keys: DataFrame, work: str) -> tuple[DataFrame, list[str]]:
    """The entries that hold for those of the keys that are known, and the folders that were opened to find them."""
    if FILTERS not in version.parts:
        return spark.createDataFrame([], ENTRY).limit(0), []
    candidates(spark, root, version, keys).write.parquet(f"{work}/candidates")
    found = spark.read.parquet(f"{work}/candidates")
    # at most BUCKETS x MOST_FILES folders
    opened = sorted(f"{root}/data/commit={r['commit']}/{IDS}/bucket={r['bucket']}" for r in found.select("commit", "bucket").distinct().collect())
    if not opened:
        return spark.createDataFrame([], ENTRY).limit(0), []
    entries = spark.read.schema(ENTRY).parquet(*opened).join(found.select("id_key").distinct(), "id_key")
    return least(entries), opened


def least(entries: DataFrame) -> DataFrame:
    """One entry per id: the one that holds."""
    first = F.min(F.struct("event_ts", "dt", "fingerprint")).alias("e")
    return entries.groupBy("id_key").agg(first).select("id_key", "e.event_ts", "e.dt", "e.fingerprint")


def merged(spark: SparkSession, root: str, version: versions.Version, commit: str) -> dict[str, tuple[str, ...]]:
    """If many batches have gathered, their entries as one file per bucket, written into a commit; else nothing."""
    buckets = [p for p in version.parts if p.startswith(f"{IDS}/")]
    if len(version.parts.get(FILTERS, ())) < MOST_FILES:
        return {}
    changes = add(least(versions.read(spark, root, ENTRY, version, buckets)), commit)
    return {p: () for p in buckets} | changes
