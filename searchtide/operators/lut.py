"""Upkeep of the keyword table: which keywords to ask about, and what to do with the answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.functions.text import dictionary, strip
from searchtide.operators.lookup import BROADCAST_BYTES, text_bytes
from searchtide.vocab import GENRE_ALIASES, META_QUERIES, REPLY_FENCE, UNKNOWN, UNSENDABLE, VERDICT_CODES

BATCH_SIZE = 50
MAX_NEW = 15_000

_JSON = {"allowSingleQuotes": "false"}


def unknown_keywords(rows: DataFrame) -> DataFrame:
    """All keywords without genre and how often they were searched."""
    open_rows = rows.where((F.col("derived_genre") == UNKNOWN) & (F.col("keyword_norm") != ""))
    return open_rows.groupBy("keyword_norm").agg(F.count(F.lit(1)).alias("cnt"))


def without(keywords: DataFrame, known: DataFrame) -> DataFrame:
    """Keywords that are not in ``known(keyword)``; the known table is broadcast only if measured small."""
    keys = known.select(F.col("keyword").alias("keyword_norm"))
    side = F.broadcast(keys) if text_bytes(keys) <= BROADCAST_BYTES else keys
    return keywords.join(side, "keyword_norm", "left_anti")


def candidates(unknown: DataFrame, lut: DataFrame, resolved: DataFrame) -> DataFrame:
    """Keywords that nobody knows yet. Only then the budget of a run applies (see :func:`batches`), so known keywords
    never take the place of new ones."""
    return without(without(unknown, lut), resolved)


def is_classifiable(keyword: Column) -> Column:
    """Longer than two characters and not a text the search box itself produces."""
    text = strip(keyword)
    return (F.char_length(text) > 2) & ~text.isin(*META_QUERIES)


def batches(keywords: DataFrame, max_new: int = MAX_NEW, size: int = BATCH_SIZE) -> DataFrame:
    """``(batch_id, rank, keyword)`` for the ``max_new`` most searched classifiable keywords.

    The ranking runs in one task, over no more than ``max_new`` rows.
    """
    asked = keywords.where(is_classifiable(F.col("keyword_norm")))
    asked = asked.orderBy(F.desc("cnt"), "keyword_norm").limit(max_new)
    rank = F.row_number().over(Window.orderBy(F.desc("cnt"), "keyword_norm"))
    return asked.withColumn("rank", rank).select(
        F.floor((F.col("rank") - 1) / size).cast("int").alias("batch_id"), "rank", F.col("keyword_norm").alias("keyword"))


def sanitized(batched: DataFrame) -> DataFrame:
    """Add ``clean``, the text sent to the classifier; of keywords with equal text only the first is sent."""
    clean = strip(F.regexp_replace("keyword", UNSENDABLE, " "))
    first = Window.partitionBy("batch_id", "clean").orderBy("rank")
    return (
        batched.withColumn("clean", clean).where(F.col("clean") != "")
        .withColumn("n", F.row_number().over(first)).where(F.col("n") == 1).drop("n")
    )


def normalized_genre(answer: Column) -> Column:
    """A genre code for whatever the classifier wrote; ``UNKNOWN`` if it is no genre."""
    code = strip(F.upper(answer))
    named = F.coalesce(dictionary(GENRE_ALIASES)[code], code)
    return F.when(named.isin(*VERDICT_CODES), named).otherwise(UNKNOWN)


def reply_entries(replies: DataFrame) -> DataFrame:
    """``(batch_id, failed, entries)`` from ``(batch_id, reply)``: the JSON object in each reply text.

    A reply without exactly one JSON object fails. The object is read inside an array, because
    text behind a lone object would go unnoticed.
    """
    text = F.regexp_replace(strip(F.col("reply")), REPLY_FENCE, "")
    objects = F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<map<string,string>>", _JSON)
    entries = F.when(F.size(objects) == 1, F.map_entries(F.get(objects, F.lit(0))))
    return replies.select("batch_id", entries.isNull().alias("failed"), entries.alias("entries"))


def verdict_pairs(parsed: DataFrame) -> DataFrame:
    """``(batch_id, pos, name, answer)``: last value of each key, keys and values swapped where inverted.

    A reply is inverted when more than half of its keys are genre codes.
    """
    rows = parsed.where(~F.col("failed")).select("batch_id", F.posexplode("entries").alias("pos", "entry")).select(
        "batch_id", "pos", F.col("entry.key").alias("key"), F.col("entry.value").alias("value"))
    per_key = Window.partitionBy("batch_id", "key")
    once = (
        rows.withColumn("last", F.max("pos").over(per_key)).withColumn("first", F.min("pos").over(per_key))
        .where(F.col("pos") == F.col("last")).select("batch_id", F.col("first").alias("pos"), "key", "value")
    )
    code_share = F.avg(F.upper("key").isin(*VERDICT_CODES).cast("int")).over(Window.partitionBy("batch_id"))
    judged = once.withColumn("inverted", code_share > 0.5)
    return judged.where(~F.col("inverted") | F.col("value").isNotNull()).select(
        "batch_id", "pos",
        F.when(F.col("inverted"), F.col("value")).otherwise(F.col("key")).alias("name"),
        F.when(F.col("inverted"), F.col("key")).otherwise(F.col("value")).alias("answer"),
    )


def applied_verdicts(pairs: DataFrame, batched: DataFrame) -> DataFrame:
    """``(batch_id, keyword, genre)`` for answers about a keyword of their own batch that name a genre.

    An answer may name a keyword by its cleaned text or as it is; the cleaned text goes first.
    If several answers reach one keyword, the last one counts.
    """
    sent = sanitized(batched).select("batch_id", F.col("clean").alias("name"), F.col("keyword").alias("by_clean"))
    plain = batched.select("batch_id", F.col("keyword").alias("name"), F.col("keyword").alias("by_name"))
    named = (
        pairs.withColumn("genre", normalized_genre(F.col("answer"))).where(F.col("genre") != UNKNOWN)
        .join(sent, ["batch_id", "name"], "left").join(plain, ["batch_id", "name"], "left")
        .withColumn("keyword", F.coalesce("by_clean", "by_name")).where(F.col("keyword").isNotNull())
    )
    return named.groupBy("batch_id", "keyword").agg(F.max_by("genre", "pos").alias("genre"))


def unresolved(batched: DataFrame, verdicts: DataFrame, failed: DataFrame) -> DataFrame:
    """Keywords that were asked about and got no genre; failed batches are left for the next run."""
    answered = batched.join(failed.select("batch_id"), "batch_id", "left_anti")
    return answered.join(verdicts, ["batch_id", "keyword"], "left_anti").select("keyword").distinct()


def merged_lut(lut: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The table with new verdicts in place of old ones."""
    fresh = verdicts.select("keyword", "genre")
    return lut.select("keyword", "genre").join(fresh.select("keyword"), "keyword", "left_anti").unionByName(fresh)


def merged_resolved(resolved: DataFrame, *more: DataFrame) -> DataFrame:
    together = resolved.select("keyword")
    for other in more:
        together = together.unionByName(other.select("keyword"))
    return together.distinct()
