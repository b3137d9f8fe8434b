"""Mixing sources to target weights with hash-threshold histograms.

The share of a source in the mix is given by weights; a target stops at ``MOST_TIMES`` times the source's
size and the excess goes to the other sources by weight. A target is met by whole passes over the
source and one partial pass: documents whose hash lies below a threshold. The threshold comes
from histograms: words by source and leading hash bits are summed, the bucket in which the budget ends is
refined by the next bits, and so on down to single hashes. Nothing is sorted or ranked but one row per
source and the at most 4,096 buckets of a source. A smaller budget takes a subset of what a larger one takes.

Everything is DataFrame functions.

Defined results: a null or blank text has size 0 and takes 0 words. A null source is a source of its own,
last in order. The hash is of the id, so rows with the same id (or without one) are taken together. An empty table
gives an empty result. Other columns stay as they are in ``mixed``, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm.shared import counted, staged
from searchtide.llm.texts import WORD

MOST_TIMES = 3
#: weights of the sources in order, repeated
WEIGHTS = (1, 2, 3)
HASH_BITS = 60
#: hash bits used by each histogram; the last one is by whole hash
STEPS = (12, 24, 36, HASH_BITS)


def id_hash(key: Column) -> Column:
    """The first 60 bits of the MD5 of the id as text."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    return F.conv(F.substring(F.md5(text), 1, HASH_BITS // 4), 16, 10).cast("long")


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``doc_id``, ``source``, ``size`` (words) and ``hash`` of every row; staged."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), words.alias("size"), id_hash(F.col(id_col)).alias("hash"))
    return staged(rows, "sizes")


def targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """``source``, ``source_size``, ``target``, whole ``passes`` and the words ``rest`` of a partial pass.

    One row per source. With sources in order of size per weight, those up to a point are at
    their cap, and the others share what is left by weight.
    """
    every = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(in_order) - 1) % len(weights)
    every = every.select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), place + 1).cast("long").alias("weight"))
    every = every.withColumn("cap", F.col("source_size") * most_times)
    fullest = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    total = F.sum("source_size").over(Window.partitionBy())
    capped = F.coalesce(F.sum("cap").over(fullest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(fullest.rowsBetween(0, Window.unboundedFollowing))
    every = every.withColumn("level", (total - capped).cast("double") / open_weight)
    # the first level that its source can bear; those after it are lower
    level = F.max(F.when(F.col("level") <= F.col("cap") / F.col("weight"), F.col("level"))).over(Window.partitionBy())
    every = every.withColumn("target", F.least(F.col("cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    every = every.withColumn("passes", passes)
    return staged(every.select("source", "source_size", "target", "passes", (F.col("target") - F.col("passes") * F.col("source_size")).alias("rest")), "targets")


def thresholds(sized: DataFrame, wanted: DataFrame) -> DataFrame:
    """``source`` and ``threshold``: documents with a smaller hash belong to the partial pass."""
    keys = [F.col("source").alias("s")]
    state = wanted.select(*keys, "rest", F.lit(0).cast("long").alias("prefix"), F.lit(0).cast("long").alias("done"))
    before = 0
    for bits in STEPS:
        own = sized.join(counted(state), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright("hash", HASH_BITS - before) == F.col("prefix")))
        bucket = F.shiftright("hash", HASH_BITS - bits)
        filled = own.groupBy("s", bucket.alias("bucket")).agg(F.sum("size").alias("words"), F.first("rest").alias("rest"), F.first("done").alias("done"))
        upto = F.sum("words").over(Window.partitionBy("s").orderBy("bucket")) + F.col("done")
        filled = filled.withColumn("upto", upto).where("upto > rest")
        edge = filled.groupBy("s").agg(F.min(F.struct("bucket", "upto", "words", "rest")).alias("e"))
        state = edge.select("s", "e.rest", F.col("e.bucket").alias("prefix"), (F.col("e.upto") - F.col("e.words")).alias("done"), F.col("e.words").alias("words"))
        state = staged(state, "edges")
        before = bits
    # the document at the edge is taken if that comes nearer to the target
    taken = (2 * (F.col("rest") - F.col("done")) >= F.col("words")).cast("long")
    return staged(state.select("s", (F.col("prefix") + taken).alias("threshold")), "thresholds")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target``, ``taken`` (words) and ``copies`` of every row."""
    sized = sizes(docs, id_col, text_col, source_col)
    plan = _plan(sized, weights, most_times)
    out = sized.join(plan, F.col("source").eqNullSafe(F.col("s"))).withColumn("copies", _copies(F.col("hash")))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies")


def _plan(sized: DataFrame, weights: tuple[int, ...], most_times: int) -> DataFrame:
    wanted = targets(sized, weights, most_times)
    edges = thresholds(sized, wanted).withColumnRenamed("s", "edge_source")
    plan = wanted.withColumnRenamed("source", "s").join(counted(edges), F.col("s").eqNullSafe(F.col("edge_source")), "left")
    # a source without an edge is taken whole in its partial pass, as is only possible if nothing of it is over
    return counted(staged(plan.select("s", "source_size", "target", "passes", "threshold"), "plan"))


def _copies(hashed: Column) -> Column:
    return F.col("passes") + F.when(hashed < F.coalesce("threshold", F.lit(1 << HASH_BITS)), 1).otherwise(0)


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          weights: tuple[int, ...] = WEIGHTS, most_times: int = MOST_TIMES) -> DataFrame:
    """The rows of the mix, each as often as it is taken, with all their columns."""
    sized = sizes(docs, id_col, text_col, source_col)
    plan = _plan(sized, weights, most_times)
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rows = rows.join(plan, F.col(f"row.`{source_col}`").eqNullSafe(F.col("s")))
    copies = _copies(id_hash(F.col(f"row.`{id_col}`"))).cast("int")
    return rows.select("row", F.explode(F.array_repeat(F.lit(1), copies))).select("row.*")
