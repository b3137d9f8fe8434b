"""Importance resampling against plain counting."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from searchtide.llm import resampling as rs
from searchtide.llm import texts as tx
from searchtide.llm.ranks import ranked
from tests.llm.conftest import CLASHING, EDGES, prose
from tests.conftest import SMALL

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def features(text, shortest, longest):
    words = WORD.findall(lower(text))
    return words, [" ".join(words[i : i + n]) for n in range(shortest, longest + 1) for i in range(len(words) - n + 1)]


def plain(rows, target, shortest=1, longest=1, buckets=rs.BUCKETS, least=rs.LEAST_WORDS, percent=rs.PERCENT):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, shortest, longest)[1])

    s, t = counts([x for _, x in rows]), counts(target)
    s_all, t_all = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))

    out = []
    for key, text in rows:
        words, found = features(text, shortest, longest)
        weight = sum(gain(zlib.crc32(f.encode()) % buckets) for f in found)
        out.append([key, len(words), len(found), weight, weight + rs.plain_noise(key)])
    order = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    drawn = order[: len(order) * percent // 100]
    return out, [(r[0], r[4]) for r in drawn]


def check(rows, target, got, **settings):
    out, drawn = plain(rows, target, **settings)
    assert Counter(tuple(r)[:5] for r in got) == Counter(map(tuple, out))
    ranks = sorted((r["rank"], r["doc_id"], r["score"]) for r in got if r["rank"] is not None)
    assert [r[0] for r in ranks] == list(range(1, len(drawn) + 1)) and [r[1:] for r in ranks] == drawn


@pytest.mark.parametrize("settings", [{}, {"shortest": 1, "longest": 3, "buckets": 97, "least_words": 2, "percent": 60}])
def test_whole_tables(ready, docs, edges, settings):
    plainly = {{"least_words": "least"}.get(k, k): v for k, v in settings.items()}
    target = ready.read.parquet(f"{SMALL}/benchmark.parquet")
    texts = [r["text"] for r in target.collect()]
    for frame in (docs, edges):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        check(rows, texts, rs.resampled(frame, target, **settings).collect(), **plainly)


def test_empty_tables_and_targets(ready, docs, edges):
    nothing = docs.limit(0)
    assert rs.resampled(nothing, docs).count() == 0
    rows = [(r["doc_id"], r["text"]) for r in edges.collect()]
    check(rows, [], rs.resampled(edges, nothing).collect())
    assert rs.resampled(edges, edges, least_words=10**9).where("rank is not null").count() == 0
    names = ready.createDataFrame([("b", prose(1, 30)), ("a", prose(1, 30)), (None, None)], "doc_id string, text string")
    check([("b", prose(1, 30)), ("a", prose(1, 30)), (None, None)], [], rs.resampled(names, nothing, percent=100).collect(), percent=100)


def test_extra_columns_do_not_clash(ready, docs):
    clashing = docs.select("doc_id", "text", *[F.lit("own").alias(c) for c in (*CLASHING, "weight", "score", "rank", "place", "_at", "_slice", "n_words")])
    left, right = (rs.resampled(d, docs.limit(5)).collect() for d in (clashing, docs))
    assert Counter(left) == Counter(right)


def test_the_target_is_preferred(ready):
    raw = [(i, prose(i, 60)) for i in range(300)] + [(1000 + i, " ".join(f"rare{(i + k) % 40}" for k in range(60))) for i in range(30)]
    frame = ready.createDataFrame(raw, "doc_id long, text string")
    target = ready.createDataFrame([(" ".join(f"rare{(3 * i + k) % 40}" for k in range(50)),) for i in range(50)], "text string")
    drawn = {r["doc_id"] for r in rs.resampled(frame, target).where("rank is not null").collect()}
    assert len(drawn) == 33 and len([d for d in drawn if d >= 1000]) == 30


# --- the table ----------------------------------------------------------------------------------


def of(texts, **sizes):
    return rs.grams(pa.array(texts, pa.string()), **sizes)


def spelled(found):
    return [found.data[a:b].tobytes().decode() for a, b in zip(found.starts, found.stops)]


def test_grams_of_odd_texts():
    texts = [t for _, t, _, _ in EDGES] + ["A-b c\x7fd", "", "Ünï 1a"]
    found = of(texts, shortest=1, longest=3)
    for i, text in enumerate(texts):
        own = spelled(rs.Grams(found.data, found.starts[found.first[i] : found.first[i + 1]], found.stops[found.first[i] : found.first[i + 1]], None, None))
        assert Counter(own) == Counter(features(text, 1, 3)[1])
    assert len(of([None, ""]).starts) == 0 and len(of([]).words) == 0


@pytest.mark.parametrize("seed", [0, 7])
def test_hashes_are_xxh64(seed):
    words = ["a" * n for n in range(1, 80)] + ["é" * n for n in range(1, 30)] + [prose(3, 40).replace(" ", "")]
    found = of([" ".join(words)])
    got = tx.slice_hashes(found.data, found.starts, found.stops, seed).tolist()
    assert got == [xxhash.xxh64_intdigest(w.encode(), seed) for w in spelled(found)]


@pytest.mark.parametrize("keys", ["own", "all equal", "few", "last slot"])
def test_slots_tell_all_words_apart(keys):
    """Even if hashes collide: equal words share a slot, different ones do not, and counts are exact."""
    words = (prose(5, 3000) + " " + "x" * 33 + " " + "x" * 32 + "y " + "x" * 33 + " abcdefgh abcdefghi abcdefg").split()
    found = of([" ".join(words)])
    n = len(found.starts)
    forced = {"own": None, "all equal": np.zeros(n, np.uint64), "few": tx.slice_hashes(found.data, found.starts, found.stops) % np.uint64(5),
              "last slot": np.full(n, 2**64 - 1, np.uint64)}[keys]
    slots = rs.interned(found, forced)
    texts = spelled(found)
    by_slot = {}
    for word, slot in zip(texts, slots.of.tolist()):
        assert by_slot.setdefault(slot, word) == word
    assert len(by_slot) == len(set(texts))
    stored, count = rs.slot_buckets(found, slots), np.bincount(slots.of)
    assert {w: (int(stored[s]), int(count[s])) for s, w in by_slot.items()} == {w: (zlib.crc32(w.encode()) % rs.BUCKETS, c) for w, c in Counter(texts).items()}


def test_ranks_of_equal_rows(ready):
    rows = ready.createDataFrame([(i % 3, "same") for i in range(1000)] + [(None, "same")] * 5, "k int, place string")
    got = ranked(rows, [F.col("k").asc_nulls_last()], "n").collect()
    assert sorted(r["n"] for r in got) == list(range(1005))
    spans = {k: (min(r["n"] for r in got if r["k"] == k), max(r["n"] for r in got if r["k"] == k)) for k in (0, 1, 2, None)}
    assert spans == {0: (0, 333), 1: (334, 666), 2: (667, 999), None: (1000, 1004)}
    assert ranked(rows.limit(0), [F.col("k")], "n").count() == 0
