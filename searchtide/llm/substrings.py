"""Repeated passages across documents: seed, extend, remove.

A window is ``WINDOW`` consecutive words of a document. Its seed is the run of ``SEED`` words in it with the smallest hash
(the leftmost of equals): equal windows have equal seeds at the same place, and neighbouring windows mostly share one, so a
document has about one seed for every seven words. Documents are joined on seeds that occur more than once. Around
a seed a match extends over all windows that have it as their seed. An extent (first and last window of such a
stretch) equal to an earlier one is repeated as a whole, which settles the inside of a long passage; only where one seed
has different extents, at the ends of passages, are windows compared one by one. Adjoining repeats
then merge to maximal ones.

A window repeats if its words also start earlier: in a document with a smaller id, or earlier in the same
document. Words are compared by hashes: each word has two independent XXH64, one for seeds and one for windows, and windows are
equal if the 64 bits of the seed's eight words and the 64 bits of all twenty agree.

Seeds that occur once are sifted out before anything is moved: a bitmap of fixed size (``BITMAP_BITS``) holds the repeated
ones. It only saves work; whatever passes it is grouped exactly.

Defined results: a null, empty or short text has no window and nothing is removed. A null id is smaller than
any other. Rows that share an id are one document: equal starts in them are not earlier. An empty table gives an empty
result. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm import texts as tx
from searchtide.llm.shared import staged

WINDOW = 20
SEED = 8
BITMAP_BITS = 1 << 26
#: seeds of the two XXH64 of a word: one for the runs that are seeds, one for the windows
_SEEDS = (0x5EED, 0x31D0)


class Windows(NamedTuple):
    """Windows of a batch: text, start in words, hash, place of the seed, hash of the seed."""

    text: np.ndarray
    start: np.ndarray
    hash: np.ndarray
    seed_at: np.ndarray
    seed: np.ndarray


def windows(words: tx.Parts) -> tuple[Windows, np.ndarray]:
    """Windows that do not repeat within their own text; and of all windows which do (by first word)."""
    ids, vocabulary = tx.numbered(words.strings)
    name, other = (tx.strong_hashes(vocabulary, seed)[ids] for seed in _SEEDS)
    owner = tx.owners(words.first)
    repeat = np.zeros(len(ids), bool)
    starts = np.flatnonzero(tx.whole(owner, WINDOW))
    if len(starts) == 0:
        none = np.zeros(0, np.int64)
        return Windows(none, none, none.astype(np.uint64), none, none.astype(np.uint64)), repeat
    whole = tx.mixed(tx.rolled(other, WINDOW)[starts])
    _, once = np.unique(whole ^ tx.mixed(owner[starts].astype(np.uint64) + np.uint64(1)), return_index=True)
    local = np.ones(len(starts), bool)
    local[once] = False
    repeat[starts[local]] = True
    runs = tx.mixed(tx.rolled(name, SEED))
    seen = np.lib.stride_tricks.sliding_window_view(runs, WINDOW - SEED + 1)
    starts, whole = starts[~local], whole[~local]
    at = np.concatenate([seen[starts[k : k + 65536]].argmin(axis=1) for k in range(0, len(starts), 65536)]) + starts
    text = owner[starts]
    return Windows(text, starts - words.first[text], whole, at, runs[at]), repeat


def extents(found: Windows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and one past the last window of each stretch with one seed, and a hash of the extent."""
    if len(found.text) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    new = np.ones(len(found.text), bool)
    new[1:] = (found.seed_at[1:] != found.seed_at[:-1]) | (np.diff(found.start) != 1) | (found.text[1:] != found.text[:-1])
    first = np.flatnonzero(new)
    stop = np.append(first[1:], len(new))
    ends = tx.rolled(np.ravel(np.column_stack([found.hash[first], found.hash[stop - 1], (stop - first).astype(np.uint64)])), 3)[::3]
    return first, stop, tx.mixed(ends)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, tx.Parts]]:
    for batch in batches:
        for part in tx.chunks(batch, "text"):
            yield part, tx.words_of(*tx.encoded(part.column("text")))


def repeated_seeds(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Bitmap of the seeds that occur more than once, of a size that does not depend on the input."""

    def seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, words in _parts(batches):
            found, _ = windows(words)
            first, _, _ = extents(found)
            yield pa.RecordBatch.from_arrays([_signed(found.seed[first])], ["seed"])

    every = _rows(docs, id_col, text_col).mapInArrow(seeds, "seed long").groupBy("seed").agg(F.count("*").alias("n")).where("n > 1")
    place = F.col("seed").bitwiseAND(BITMAP_BITS - 1)
    bits = every.groupBy(F.shiftright(place, 6).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(seed & 63 as int))")).alias("bits")).toArrow()
    bitmap = np.zeros(BITMAP_BITS // 64, np.int64)
    bitmap[bits["word"].to_numpy()] = bits["bits"].to_numpy()
    return bitmap.view(np.uint64)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Extents around seeds that occur more than once (and a few others), with their windows; staged."""
    bitmap = docs.sparkSession.sparkContext.broadcast(repeated_seeds(docs, id_col, text_col))

    def extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words in _parts(batches):
            found, _ = windows(words)
            first, stop, extent = extents(found)
            place = found.seed[first] & np.uint64(BITMAP_BITS - 1)
            kept = np.flatnonzero((bitmap.value[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1))
            first, stop, extent = first[kept], stop[kept], extent[kept]
            sizes = stop - first
            inside = np.repeat(first - np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(first) else first, sizes) + np.arange(sizes.sum())
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), _signed(found.hash[inside]))
            yield pa.RecordBatch.from_arrays(
                [_signed(found.seed[first]), _signed(extent), part.column("doc_id").take(pa.array(found.text[first])),
                 pa.array(found.start[first].astype(np.int32)), lists], ["seed", "extent", "doc_id", "start", "windows"])

    kind = docs.schema[id_col].dataType.simpleString()
    out = _rows(docs, id_col, text_col).mapInArrow(extended, f"seed long, extent long, doc_id {kind}, start int, windows array<long>")
    return staged(out, "extents")


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (first window and number of windows) of windows that start earlier in other documents."""
    found = candidates(docs, id_col, text_col)
    place = F.struct("doc_id", "start").alias("place")
    narrow = found.select("seed", "extent", place, F.size("windows").alias("n"))
    first = staged(narrow.groupBy("seed", "extent").agg(F.min("place").alias("first"), F.count("*").alias("times")), "firsts")
    # extents that are earlier elsewhere as a whole
    many = first.where("times > 1").select("seed", "extent", "first")
    again = narrow.join(many, ["seed", "extent"]).where("place > first").select("place.doc_id", "place.start", "n")
    # the earliest of each extent, where one seed has several: window by window
    unsure = first.groupBy("seed").agg(F.count("*").alias("extents")).where("extents > 1").select("seed")
    earliest = first.join(unsure, "seed").select("seed", "extent", F.col("first.doc_id").alias("first_id"), F.col("first.start").alias("first_start"))
    held = found.join(earliest, ["seed", "extent"]).where(F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("start") == F.col("first_start")))
    single = held.select("seed", "doc_id", "start", F.posexplode("windows").alias("k", "window"))
    single = staged(single.select("seed", "window", F.struct("doc_id", (F.col("start") + F.col("k")).alias("start")).alias("place")), "windows")
    least = single.groupBy("seed", "window").agg(F.min("place").alias("first"), F.count("*").alias("times")).where("times > 1").drop("times")
    later = single.join(least, ["seed", "window"]).where("place > first").select("place.doc_id", "place.start", F.lit(1).alias("n"))
    spans = again.union(later).groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return staged(spans, "spans")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_text`` (words left, one blank between) and ``removed`` (maximal
    repeats as first word and word after the last) of every row."""
    spans = repeats(docs, id_col, text_col).select(F.col("doc_id").alias("span_id"), "spans")
    rows = _rows(docs, id_col, text_col).join(spans, F.col("doc_id").eqNullSafe(F.col("span_id")), "left").drop("span_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, words in _parts(batches):
            _, repeat = windows(words)
            change = np.zeros(len(repeat) + 1, np.int64)
            own = np.flatnonzero(repeat)
            np.add.at(change, own, 1)
            np.add.at(change, own + WINDOW, -1)
            lists = part.column("spans")
            counts = pa.compute.fill_null(pa.compute.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            begin = flat.field("start").to_numpy() + np.repeat(words.first[:-1], counts)
            # rows that share an id may have different texts: stay within this one
            last = np.repeat(words.first[1:], counts)
            end = np.minimum(begin + flat.field("n").to_numpy() + WINDOW - 1, last)
            np.add.at(change, np.minimum(begin, last), 1)
            np.add.at(change, end, -1)
            gone = np.cumsum(change)[:-1] > 0
            kept_first = np.concatenate([[0], np.cumsum(~gone)])[words.first]
            kept = pa.ListArray.from_arrays(pa.array(kept_first.astype(np.int32)), words.strings.filter(pa.array(~gone)))
            text = pa.compute.binary_join(kept.cast(pa.list_(pa.string())), " ")
            edge = np.diff(gone.astype(np.int8), prepend=0)
            owner = tx.owners(words.first)
            edge[1:] = np.where((owner[1:] != owner[:-1]) & gone[1:], 1, edge[1:]) if len(edge) > 1 else edge[1:]
            starts = np.flatnonzero(edge == 1)
            stops = starts.copy()
            if len(starts):
                closing = np.flatnonzero(gone & ~np.append(gone[1:] & (owner[1:] == owner[:-1]), False)) + 1
                stops = closing
            base = words.first[owner[starts]] if len(starts) else starts
            spans = pa.StructArray.from_arrays([pa.array((starts - base).astype(np.int32)), pa.array((stops - base).astype(np.int32))], ["start", "stop"])
            removed = pa.ListArray.from_arrays(pa.array(np.searchsorted(starts, words.first).astype(np.int32)), spans)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(np.diff(words.first)), pa.array(tx.sums(gone, words.first)), text, removed],
                ["doc_id", "n_words", "n_removed", "kept_text", "removed"])

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(cut, f"doc_id {kind}, n_words long, n_removed long, kept_text string, removed array<struct<start:int,stop:int>>")


