"""Document fingerprints from closed syncmers.

A text is its words; the inner substrings of a run of ``RUN_WORDS`` words are its pairs of neighbouring
words. A run is an anchor if the pair with the smallest hash is its first or its last. Whether a run is an anchor depends
on the run alone and not on what stands around it, so an unchanged passage keeps its anchors
wherever it moves. A text with fewer words is one anchor as a whole; a text without words has none.

The fingerprint is the set of anchor hashes; as a string it is a digest over all of them. Results also hold every anchor with
its position, from which likeness and alignment follow. Likeness is twice the shared
anchors over the anchors of both. ``aligned`` matches anchors of two texts by position.

Everything is DataFrame functions.

Defined results: a null text is an empty text. Two texts without anchors have likeness 1, one of them without
has 0. Documents follow each other by id and then by text, so repeated ids follow each other; the last is followed by the
first, a single document by itself. A row without an id has no place in this order: its next text is
empty and its likeness to the next null. Only the two named columns are looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.llm.ranks import ranked
from searchtide.llm.texts import WORD

RUN_WORDS = 6
#: pairs of neighbouring words in a run
PAIRS = RUN_WORDS - 1
#: ranges of ids that the table is cut into; a range is sorted by one task
MOST_RANGES = 16_384
_FINE = 64


def word_hashes(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w))


def pair_hashes(words: Column) -> Column:
    later = F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0)))
    return F.filter(F.zip_with(words, later, lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))), lambda h: h.isNotNull())


def anchors(words: Column, pairs: Column) -> Column:
    """Position and hash of each anchor, from columns that hold word and pair hashes."""
    def run(i: Column) -> Column:
        inner = [F.get(pairs, i + k) for k in range(PAIRS)]
        middle = F.least(*inner[1:-1])
        at_edge = (inner[0] <= middle) | (inner[-1] <= middle)
        return F.when(at_edge, F.struct(i.alias("at"), F.xxhash64(*inner[::2]).alias("hash")))

    runs = F.filter(F.transform(F.sequence(F.lit(0), F.size(pairs) - PAIRS), run), lambda a: a.isNotNull())
    whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(words).alias("hash")))
    none = F.array().cast("array<struct<at:int,hash:bigint>>")
    return F.when(F.size(pairs) >= PAIRS, runs).when(F.size(words) > 0, whole).otherwise(none)


def anchor_set(found: Column) -> Column:
    return F.array_distinct(F.transform(found, lambda a: a["hash"]))


def digest(hashes: Column) -> Column:
    """SHA-256 over all hashes in order; empty if there are none."""
    text = F.array_join(F.transform(F.array_sort(hashes), lambda h: F.lower(F.lpad(F.hex(h), 16, "0"))), "")
    return F.when(F.size(hashes) > 0, F.sha2(text, 256)).otherwise(F.lit(""))


def likeness(one: Column, other: Column) -> Column:
    both = F.size(one) + F.size(other)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(one, other)) / both)


def anchored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``anchors`` (position in words and hash) of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), word_hashes(F.coalesce(F.col(text_col), F.lit(""))).alias("words"))
    rows = rows.select("doc_id", "words", pair_hashes(F.col("words")).alias("pairs"))
    return rows.select("doc_id", anchors(F.col("words"), F.col("pairs")).alias("anchors"))


def aligned(one: DataFrame, other: DataFrame) -> DataFrame:
    """Anchors that two tables of ``anchored`` share, by ``one_id``, ``other_id`` and ``shift`` of the position.

    Hashes that stand in both tables at many places are joined at all of them: give it tables in which a
    passage is not repeated often, such as the candidates for one document.
    """
    a = one.select(F.col("doc_id").alias("one_id"), F.explode("anchors").alias("a")).select("one_id", F.col("a.hash").alias("hash"), F.col("a.at").alias("one_at"))
    b = other.select(F.col("doc_id").alias("other_id"), F.explode("anchors").alias("b")).select("other_id", F.col("b.hash").alias("hash"), F.col("b.at").alias("other_at"))
    return a.join(b, "hash").groupBy("one_id", "other_id", (F.col("other_at") - F.col("one_at")).alias("shift")).agg(F.count("*").alias("shared"))


def _ranges(docs: DataFrame, id_col: str) -> list:
    """First ids of nearly equal ranges of ids; a bounded list, from one pass over the ids and one to make them exact."""
    spark = docs.sparkSession
    wanted = min(MOST_RANGES, max(1, 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null")
    if not isinstance(docs.schema[id_col].dataType, T.NumericType):
        # there are no percentiles of texts: every so-manieth id in the order of all of them
        placed = ranked(ids.distinct(), [F.col("id")], "place", "ids")
        step = max(1, -(-placed.count() // wanted))
        return sorted(r["id"] for r in placed.where(F.col("place") % step == 0).collect())
    cuts = ids.agg(F.percentile_approx("id", [i / wanted for i in range(wanted)], 20 * wanted).alias("cuts")).first()["cuts"] or []
    cuts = sorted(set(cuts))
    if not cuts:
        return []
    firsts = ids.groupBy(_range(F.col("id"), cuts).alias("range")).agg(F.min("id").alias("first"))
    return sorted(r["first"] for r in firsts.collect())


def _range(key: Column, firsts: list) -> Column:
    """Number of listed values up to the key: first among every 64th, then among the 64 from there."""
    coarse = F.size(F.filter(F.array(*map(F.lit, firsts[::_FINE])), lambda f: f <= key))
    block = F.slice(F.array(*map(F.lit, firsts)), F.greatest(coarse - 1, F.lit(0)) * _FINE + 1, F.lit(_FINE))
    return F.greatest(coarse - 1, F.lit(0)) * _FINE + F.size(F.filter(block, lambda f: f <= key))


def followed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``part`` and ``late`` with every document next to the one that follows it.

    A range of ids is one part. The first document of each part also stands at the end of the part before (``late``),
    that of the first at the end of the last.
    """
    firsts = _ranges(docs, id_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    part = _range(F.col("doc_id"), firsts) if firsts else F.lit(0)
    rows = rows.withColumn("part", F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(part))
    if not firsts:
        return rows.withColumn("late", F.lit(False))
    before = F.when(F.col("doc_id") == F.lit(firsts[0]), F.lit(len(firsts))).otherwise(F.col("part") - 1)
    starts = F.element_at(F.array(*map(F.lit, firsts)), F.greatest(F.col("part"), F.lit(1))) == F.col("doc_id")
    places = F.when(starts, F.array(F.struct(F.col("part"), F.lit(False).alias("late")), F.struct(before.alias("part"), F.lit(True).alias("late")))).otherwise(
        F.array(F.struct(F.col("part"), F.lit(False).alias("late"))))
    return rows.select("doc_id", "text", F.explode(places).alias("place")).select("doc_id", "text", "place.part", "place.late")


def compared(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints and all anchors of every text and of its edited text, and likeness to the edited and the next text.

    The edited text has its last half replaced by as many characters from the start of the next document.
    """
    order = Window.partitionBy("part").orderBy("late", "doc_id", "text")
    rows = followed(docs, id_col, text_col).withColumn("next_text", F.coalesce(F.when(F.col("doc_id").isNotNull(), F.lead("text").over(order)), F.lit("")))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("doc_id", "text", "part", "late", n.cast("long").alias("n_chars"),
                       F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    keys = ["doc_id", "text", "part", "late", "n_chars"]
    rows = rows.select(*keys, F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"), word_hashes(F.col("text")).alias("w"), word_hashes(F.col("edited")).alias("v"))
    keys.append("edited_sha256")
    rows = rows.select(*keys, "w", "v", pair_hashes(F.col("w")).alias("wp"), pair_hashes(F.col("v")).alias("vp"))
    rows = rows.select(*keys, anchors(F.col("w"), F.col("wp")).alias("anchors"), anchors(F.col("v"), F.col("vp")).alias("edited_anchors"))
    keys += ["anchors", "edited_anchors"]
    rows = rows.select(*keys, anchor_set(F.col("anchors")).alias("own"), anchor_set(F.col("edited_anchors")).alias("new"))
    rows = rows.select(*keys, "own", "new", F.lead("own").over(order).alias("next")).where(~F.col("late"))
    near_next = F.when(F.col("doc_id").isNotNull(), likeness(F.col("own"), F.col("next")))
    return rows.select("doc_id", "n_chars", "edited_sha256", digest(F.col("own")).alias("fingerprint"), digest(F.col("new")).alias("edited_fingerprint"),
                       likeness(F.col("own"), F.col("new")).alias("near_edited"), near_next.alias("near_next"), "anchors", "edited_anchors")
