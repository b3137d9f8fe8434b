"""Importance resampling towards a target distribution over hashed word n-grams.

Features of a text are its runs of ``shortest`` to ``longest`` words, hashed into buckets. A bucket's gain is the logarithm of its
share in the target texts over its share in the raw texts, in thousandths. A text's weight is the sum of the gains of its
features; Gumbel noise from its id is added, and the highest scores are drawn, which is sampling without replacement in
proportion to the exponential of the weight.

Within a batch n-grams are interned in an open-addressed NumPy table: keys are XXH64 hashes, a key that is found is
verified byte by byte, and a slot stores the bucket (CRC32) and the count of its n-gram. So the bucket is worked out once per
distinct n-gram; counting reads the slots, and weighing gathers the gains by the slot id of each occurrence.

The bucket counts of a task are one array; arrays are added up in two steps, so what reaches the driver has one row per bucket.
Ranks come from a range partition (:mod:`searchtide.llm.ranks`), not from one sorted task.

Defined results: a null, empty or wordless text has no features, weight 0, and a score from its noise alone; it is never
drawn if fewer words than ``least_words`` are asked for. Repeated rows are scored and drawn each for themselves. A null id is hashed as
an empty one and comes after all others in a tie. An empty target or an empty table gives counts of zero. Only the columns named
are looked at.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm import texts as tx
from searchtide.llm.ranks import ranked
from searchtide.llm.shared import staged

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

#: ASCII bytes other than digits and lower-case letters separate words
_SEPARATORS = np.zeros(256, dtype=bool)
_SEPARATORS[:128] = True
_SEPARATORS[ord("0") : ord("9") + 1] = False
_SEPARATORS[ord("a") : ord("z") + 1] = False


class Grams(NamedTuple):
    """N-grams of several texts as slices of one buffer. Those of text ``i`` are ``first[i]:first[i + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    stops: np.ndarray
    first: np.ndarray
    words: np.ndarray


class Slots(NamedTuple):
    """Slots of a table: the n-gram that holds each slot (-1: none), and the slot of each n-gram."""

    holder: np.ndarray
    of: np.ndarray


def grams(texts: pa.Array, shortest: int = 1, longest: int = 1) -> Grams:
    """All runs of ``shortest`` to ``longest`` words of each text, words joined by one blank."""
    data, offsets = tx.encoded(texts)
    words = tx.split(tx.lowered(data), offsets, _SEPARATORS)
    n = len(words.strings)
    bounds = np.frombuffer(words.strings.buffers()[1], np.int64)[: n + 1] if n else np.zeros(1, np.int64)
    begin, end = bounds[:-1] + np.arange(n), bounds[1:] + np.arange(n)
    # a blank after each word, and eight bytes more so that eight can be read from any place
    joined = np.full((end[-1] if n else 0) + 9, 32, np.uint8)
    if n:
        place = np.arange(bounds[-1]) + np.repeat(np.arange(n), end - begin)
        joined[place] = np.frombuffer(words.strings.buffers()[2], np.uint8)[: bounds[-1]]
    owner = tx.owners(words.first)
    starts, stops, owners = [], [], []
    for size in range(shortest, longest + 1):
        inside = np.flatnonzero(tx.whole(owner, size))
        starts.append(begin[inside])
        stops.append(end[inside + size - 1])
        owners.append(owner[inside])
    starts, stops, owners = (np.concatenate(c) for c in (starts, stops, owners))
    if longest > shortest:
        order = np.argsort(owners, kind="stable")
        starts, stops, owners = starts[order], stops[order], owners[order]
    return Grams(joined, starts, stops, np.searchsorted(owners, np.arange(len(offsets))), np.diff(words.first))


def _same_bytes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether slices ``a`` and ``b`` (numbers of slices, pairwise) hold the same bytes."""
    eight, size = tx.eight(data), stops - starts
    same = size[a] == size[b]
    for k in range(-(-tx.SHORT // 8)):
        left = size[a] - 8 * k
        on = np.flatnonzero(same & (left > 0) & (size[a] <= tx.SHORT) & (a != b))
        if len(on):
            unlike = eight[starts[a[on]] + 8 * k] ^ eight[starts[b[on]] + 8 * k]
            # bytes beyond the slice do not count
            unlike <<= (8 * np.maximum(0, 8 - left[on])).astype(np.uint64)
            same[on] &= unlike == 0
    for i in np.flatnonzero(same & (size[a] > tx.SHORT) & (a != b)).tolist():
        x, y = a[i], b[i]
        same[i] = np.array_equal(data[starts[x] : stops[x]], data[starts[y] : stops[y]])
    return same


def interned(found: Grams, keys: np.ndarray | None = None) -> Slots:
    """An open-addressed table of the n-grams: equal n-grams share a slot, different ones never do.

    All n-grams probe at once. Of those that meet a free slot one takes it; those equal to its holder in hash and
    bytes stay, the others move on to the next slot. At most half of the slots are taken.
    """
    keys = tx.slice_hashes(found.data, found.starts, found.stops) if keys is None else keys
    n = len(keys)
    capacity = 1 << max(4, (2 * n).bit_length())
    holder, of = np.full(capacity, -1, np.int64), np.zeros(n, np.int64)
    at, moving = (keys & np.uint64(capacity - 1)).astype(np.int64), np.arange(n)
    while len(moving):
        here = at[moving]
        free = holder[here] < 0
        holder[here[free]] = moving[free]
        held = holder[here]
        stays = keys[held] == keys[moving]
        match = np.flatnonzero(stays)
        stays[match] = _same_bytes(found.data, found.starts, found.stops, moving[match], held[match])
        of[moving[stays]] = here[stays]
        moving = moving[~stays]
        at[moving] = (at[moving] + 1) & (capacity - 1)
    return Slots(holder, of)


def slot_buckets(found: Grams, slots: Slots, buckets: int = BUCKETS) -> np.ndarray:
    """The bucket stored in each slot: CRC32 of the n-gram's bytes, modulo ``buckets``. Free slots have 0."""
    stored = np.zeros(len(slots.holder), np.int64)
    taken = np.flatnonzero(slots.holder >= 0)
    view, crc = memoryview(found.data), zlib.crc32
    cuts = zip(found.starts[slots.holder[taken]].tolist(), found.stops[slots.holder[taken]].tolist())
    stored[taken] = np.fromiter((crc(view[a:b]) for a, b in cuts), np.int64, len(taken)) % buckets
    return stored


def bucket_counts(docs: DataFrame, text_col: str = "text", shortest: int = 1, longest: int = 1, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    spark = docs.sparkSession

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                found = grams(part.column("text"), shortest, longest)
                slots = interned(found)
                count = np.bincount(slots.of, minlength=len(slots.holder))
                stored = slot_buckets(found, slots, buckets)
                total += np.bincount(stored, weights=count, minlength=buckets).astype(np.int64)
        if total.any():
            yield pa.RecordBatch.from_arrays([pa.array([total])], ["counts"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += batch.column("counts").flatten().to_numpy().reshape(-1, buckets).sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total])], ["counts"])

    by_task = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "counts array<long>")
    # as many arrays as there are input tasks become as many as shuffle partitions, then one row per bucket
    fewer = by_task.repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))).mapInArrow(added, "counts array<long>")
    rows = fewer.select(F.posexplode("counts").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for row in rows.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Gain of each bucket in thousandths of a natural logarithm, rounded down; every bucket counts once more than seen."""
    n, s_all, t_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([
        math.floor(1000 * math.log((float(t) + 1) * (s_all + n) / ((float(s) + 1) * (t_all + n)))) for s, t in zip(raw, target)
    ], np.int64)


def noise(key: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id in thousandths, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def plain_noise(key: object, seed: int = SEED) -> int:
    """The same for one id, in Python."""
    h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str = "doc_id", text_col: str = "text", shortest: int = 1, longest: int = 1) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                found = grams(part.column("text"), shortest, longest)
                slots = interned(found)
                by_slot = gain[slot_buckets(found, slots, len(gain))]
                weight = tx.sums(by_slot[slots.of], found.first)
                columns = [part.column("doc_id"), pa.array(found.words.astype(np.int64)), pa.array(np.diff(found.first).astype(np.int64)), pa.array(weight)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(summed, f"doc_id {kind}, n_words long, n_features long, weight long")


def resampled(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text",
    shortest: int = 1, longest: int = 1, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED,
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (1 is the highest score; null: not drawn) of every row."""
    gain = gains(bucket_counts(docs, text_col, shortest, longest, buckets), bucket_counts(target, target_text_col, shortest, longest, buckets))
    # written down, since a range partition reads its input twice
    scored = staged(weighed(docs, gain, id_col, text_col, shortest, longest), "weights").withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    long_enough = F.col("n_words") >= least_words
    order = [long_enough.desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    placed = ranked(scored, order, "place", "resampled")
    drawn = placed.where(long_enough).count() * percent // 100
    return placed.select(*scored.columns, F.when(F.col("place") < drawn, F.col("place") + 1).alias("rank"))
