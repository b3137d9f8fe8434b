"""Operators that score or rewrite texts one by one, against plain versions."""

from __future__ import annotations

import math
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from searchtide.llm import langid, lbl, pieces, quality
from searchtide.llm import texts as tx
from tests.llm.conftest import CLASHING, EDGES, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def held(key, parts, part):
    return crc32(("" if key is None else str(key)).encode()) % parts == part


def by_text(rows):
    """Rows of an operator beside the texts they came from; both in the order of the input."""
    return rows.collect()


# --- flat texts ---------------------------------------------------------------------------------


def test_words_and_lines_of_odd_texts():
    texts = [t for _, t, _, _ in EDGES]
    data, offsets = tx.encoded(pa.array(texts, pa.string()))
    words = tx.words_of(data, offsets)
    found = [words.strings[a:b].to_pylist() for a, b in zip(words.first, words.first[1:])]
    assert found == [WORD.findall(t or "") for t in texts]
    lines = tx.lines_of(data, offsets)
    assert [lines.strings[a:b].to_pylist() for a, b in zip(lines.first, lines.first[1:])] == [[x for x in (t or "").split("\n") if x] for t in texts]


def test_equal_strings_have_equal_hashes():
    hashes = tx.string_hashes(pa.array(["abc", "abd", "abc", "", "é", "abcabc"]))
    assert hashes[0] == hashes[2] and len(set(hashes.tolist())) == 5


def test_characters_are_whole_letters():
    """Of one to four bytes, over the borders of texts, alone and at the ends."""
    texts = ["aé", None, "", "語語x", "😀", "é😀é", "plain", "e\u0301"]
    data, offsets = tx.encoded(pa.array(texts))
    values, first = tx.characters(data, offsets)
    got = [values[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got == [[int.from_bytes(c.encode(), "big") for c in t or ""] for t in texts]
    ascii_data, ascii_offsets = tx.encoded(pa.array(["abc", "", "d"]))
    values, first = tx.characters(ascii_data, ascii_offsets)
    assert [values[a:b].tolist() for a, b in zip(first, first[1:])] == [[97, 98, 99], [], [100]]


def test_features_count_characters_not_bytes():
    """As many n-grams of a text as it has places for n characters, none over the border of two texts."""
    texts = ["日本語の文", "ab", "", "naïve é"]
    data, offsets = tx.encoded(pa.array(texts))
    words = tx.words_of(data, offsets)
    ids, names = tx.numbered(words.strings)
    kinds = quality._hashed(data, offsets, words, ids, names)[2:]
    for n, (bucket, first) in zip(quality.CHARACTER_GRAMS, kinds):
        assert np.diff(first).tolist() == [max(0, len(t) - n + 1) for t in texts] and len(bucket) == first[-1]


def test_chunks_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 100, None, "b" * 10, "c" * 500, ""])], ["text"])
    assert sum((p.column(0).to_pylist() for p in tx.chunks(batch, "text", 50)), []) == batch.column(0).to_pylist()


# --- quality ------------------------------------------------------------------------------------


def plain_counts(text):
    words = WORD.findall(text or "")
    lines, seen, dup = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    runs = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if runs[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered), failed


def test_quality_counts(ready, edges, docs):
    for rows in (edges.select("doc_id", "text"), docs.select("doc_id", "text")):
        got = Counter(tuple(r)[:7] for r in quality.score(rows, None).collect())
        assert got == Counter((r["doc_id"], *plain_counts(r["text"])) for r in rows.collect())


def test_quality_learns_from_labels(docs, labels):
    model = quality.fit(docs, labels)
    found = quality.score(docs, model).join(labels, "doc_id").where("not base_failed").toPandas()
    assert (found.kept == (found.quality == 1)).mean() > 0.95


def test_quality_keeps_columns_and_edges(ready, edges, labels):
    kept = quality.keep_good(edges, None)
    assert kept.columns == edges.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(i for i, t, _, _ in EDGES if not plain_counts(t)[5])
    assert quality.fit(edges.limit(0), labels) is None and quality.score(edges.limit(0), None).count() == 0
    odd = ready.createDataFrame([(5, 1), (5, 0), (None, 0), (99, 0), (4, None)], "doc_id long, quality int")
    assert quality.fit(edges, odd) is None


def test_calibration_orders_probabilities():
    slope, shift = quality._calibrated(np.array([-2.0, -1, 1, 2, 3]), np.array([0.0, 0, 1, 1, 1]))
    assert slope > 0 and -1 < shift < 2


def test_cut_does_not_move_with_the_number_of_labels(ready, monkeypatch):
    """The same labels once and 100 times, of which the larger table fills the sample of one kind only, then of both."""
    rng = np.random.default_rng(3)
    margin, good = np.concatenate([rng.normal(1, 1.5, 870), rng.normal(-1, 1.5, 110)]), np.repeat([1.0, 0.0], [870, 110])
    cuts = {}
    for times in (1, 100):
        kept = np.concatenate([np.flatnonzero(np.tile(good, times) == k)[:1500] for k in (0, 1)])
        slope, shift = quality._calibrated(np.tile(margin, times)[kept], np.tile(good, times)[kept], {1: 870 * times, 0: 110 * times})
        cuts[times] = -shift / slope
    assert cuts[100] == pytest.approx(cuts[1], abs=0.3)
    # what is handed over are the numbers of all labels with a document, not those of the sample
    seen = []
    true = quality._calibrated
    monkeypatch.setattr(quality, "_calibrated", lambda m, g, totals: seen.append(totals) or true(m, g, totals))
    docs = ready.createDataFrame([(i, prose(i, 60)) for i in range(60)], "doc_id long, text string")
    labels = ready.createDataFrame([(i, int(i >= 10)) for i in range(60)] + [(99, 0), (98, 1), (None, 0)], "doc_id long, quality int")
    assert quality.fit(docs, labels, rows_of_each=10) is not None and seen == [{0: 10, 1: 50}]


def test_labels_without_documents_are_not_chosen(ready):
    """Far more labels than documents: the sample is taken among those that have one."""
    docs = ready.createDataFrame([(i, prose(i, 60)) for i in range(40)], "doc_id long, text string")
    labels = ready.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, quality int")
    assert quality.fit(docs, labels, rows_of_each=10) is not None


def test_features_do_not_come_to_the_driver(ready, monkeypatch):
    """The model is trained in a task: what is brought to the driver are one row of weights and the rows that are counted."""
    docs = ready.createDataFrame([(i, prose(i, 60)) for i in range(40)], "doc_id long, text string")
    labels = ready.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    brought, true = [], type(docs).toArrow
    monkeypatch.setattr(type(docs), "toArrow", lambda rows: brought.append(true(rows)) or brought[-1])
    assert quality.fit(docs, labels) is not None
    assert [t.num_rows for t in brought] == [1] and "buckets" not in brought[0].column_names


# --- pieces -------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load()


def test_exact_is_what_decoding_says(vocabulary):
    """Also with a vocabulary that cannot spell some bytes."""
    texts = ["a plain text", "", " two  blanks\n", "\U0001d11e é ▁", "x" * 100]
    broken = vocabulary._replace(byte_ids=[vocabulary.byte_ids[65]] * 256)
    for given in (vocabulary, broken):
        coder = pieces.Encoder(given)
        for text in texts * 2:
            ids = np.frombuffer(coder.encode(text), np.int32)
            assert coder.comes_back(text, ids) == (coder.decode(ids) == text)
    assert not coder.all_exact


def test_trie_holds_exactly_the_keys():
    keys = {k.encode(): i for i, k in enumerate(["a", "ab", "abc", "b", "é", "bca", "zz"])}
    trie = pieces.double_array(keys)

    def find(key):
        at = 0
        for byte in key:
            nxt = trie.base[at] + byte
            if nxt >= len(trie.check) or trie.check[nxt] != at or nxt == 0:
                return -1
            at = nxt
        return trie.piece[at]

    assert all(find(k) == i for k, i in keys.items())
    assert all(find(k.encode()) == -1 for k in ("c", "abcd", "bc", "z", "ba"))


def brute_score(vocabulary, known, text):
    """Best sum of log scores over all segmentations into pieces and single characters."""
    best = [0.0] + [-math.inf] * len(text)
    for end in range(1, len(text) + 1):
        for begin in range(max(0, end - 20), end):
            part = text[begin:end].encode()
            score = vocabulary.scores[known[part]] if part in known else vocabulary.unknown if end - begin == 1 else -math.inf
            best[end] = max(best[end], best[begin] + score)
    return best[-1]


def test_viterbi_is_the_best_segmentation(vocabulary):
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    known = {vocabulary.pieces[i]: i for i in range(len(vocabulary.pieces)) if vocabulary.pieces[i] and not model.is_byte(i)}
    for text in (" the quick brown fox", " internationalisation", " zzqxj日本", "  a", " \U0001d11eé"):
        found, at, total = pieces.best(vocabulary, text.encode()), 0, 0.0
        bytes_of = set(vocabulary.byte_ids)
        while at < len(found):
            if found[at] in bytes_of:
                lead = vocabulary.pieces[found[at]][0]
                at += 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                total += vocabulary.unknown
            else:
                total += vocabulary.scores[found[at]]
                at += 1
        assert total == pytest.approx(brute_score(vocabulary, known, text), rel=1e-9)


def test_cut_texts_score_as_whole_ones(vocabulary):
    text = " some words, and\nsome more  of them"
    coder = pieces.Encoder(vocabulary)
    cut = np.frombuffer(coder.encode(text[1:]), np.int32).tolist()
    assert cut == pieces.best(vocabulary, text.encode())


def test_decoding_gives_the_text_back(edges, docs, vocabulary):
    for rows in (edges, docs):
        got = pieces.decode(pieces.encode(rows, vocabulary), vocabulary).select("text", "tokens", "n_tokens", "exact", "decoded").collect()
        assert len(got) == rows.count()
        for r in got:
            if r["text"] is None:
                assert r["tokens"] is None and r["n_tokens"] is None and r["exact"] is None
            else:
                assert r["exact"] and r["decoded"] == r["text"] and r["n_tokens"] == len(r["tokens"])
    out = pieces.encode(edges, vocabulary)
    assert set(CLASHING) - {"exact"} <= set(out.columns) and pieces.encode(edges.limit(0), vocabulary).count() == 0


# --- language -----------------------------------------------------------------------------------


def test_kernel_counts_shared_grams():
    texts = ["abcab", "bcabc", "xyz"]
    rows = langid.presence(pa.array(texts))
    grams = [{t[i : i + n] for n in langid.GRAMS for i in range(len(t) - n + 1)} for t in texts]
    values = langid._kernel(rows, rows)
    for i, a in enumerate(grams):
        for j, b in enumerate(grams):
            assert values[i, j] == pytest.approx(len(a & b) / math.sqrt(len(a) * len(b)), abs=1e-6)


def test_language_of_held_out_texts(docs):
    model = langid.fit(docs.where(~langid.held_out(docs["doc_id"], 4, 2)))
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    out = [(found[r["doc_id"]]["lang_pred"], r["lang"]) for r in docs.collect() if held(r["doc_id"], 4, 2)]
    assert len(out) > 30 and sum(a == b for a, b in out) / len(out) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_language_edges(edges):
    got = langid.predict(edges, langid.fit(edges)).collect()
    assert len(got) == len(EDGES)
    assert all(r["lang_pred"] in {"en", "de", "fr", "und"} for r in got)
    assert {r["lang_pred"] for r in got if r["doc_id"] in (0, 1, 2, 11)} == {"und"}
    empty = edges.limit(0)
    assert langid.fit(empty) is None and {r["lang_pred"] for r in langid.predict(edges, None).collect()} == {"und"}


# --- language model -----------------------------------------------------------------------------


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("head", [lbl.HEAD, 40])
def test_base_scores(edges, docs, monkeypatch, head):
    monkeypatch.setattr(lbl, "HEAD", head)
    for rows in (edges, docs):
        texts = rows.select("doc_id", "text").collect()
        counts = Counter()
        for key, text in texts:
            if not held(key, 5, 1):
                counts.update([*WORD.findall(lower(text)), ""])
        total, distinct = sum(counts.values()), len(counts)
        expected = []
        for key, text in texts:
            tokens = [*WORD.findall(lower(text)), ""]
            score = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens)
            expected.append((str(key), len(tokens), sum(counts[t] > 0 for t in tokens), total, round(score, 5)))
        got = lbl.score(rows, rows.where(~langid.held_out(rows["doc_id"], 5, 1))).collect()
        assert Counter((str(r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in got) == Counter(expected)
        assert all(r["score"] < 0 for r in got)


def test_model_is_normalised():
    rng = np.random.default_rng(1)
    vectors = lbl.Vectors(rng.normal(size=(lbl.CLASSES, lbl.DIMENSIONS)) * 0.3, rng.normal(size=(lbl.CLASSES, lbl.DIMENSIONS)) * 0.3,
                          np.ones((2, lbl.DIMENSIONS)), rng.normal(size=lbl.CLASSES))
    one, two, whole = lbl.tables(vectors)
    for a, b in ((0, 1), (5, 900), (1000, 1000)):
        assert np.exp(one[a] + two[b] - whole[a, b]).sum() == pytest.approx(1, abs=1e-4)


def test_training_beats_word_counts_where_order_matters():
    rng = np.random.default_rng(0)
    line = np.resize([3, 4, 5, 6], 40_000) + 10 * rng.integers(0, 2, 40_000)
    share = np.full(lbl.CLASSES, 1 / lbl.CLASSES)
    begin = lbl.Vectors(rng.normal(0, 0.3, (lbl.CLASSES, lbl.DIMENSIONS)), np.zeros((lbl.CLASSES, lbl.DIMENSIONS)), np.ones((2, lbl.DIMENSIONS)), np.log(share))
    one, two, whole = lbl.tables(lbl.trained(begin, line[1:-1], line[:-2], line[2:], share))
    logp = one[line[1:-1], line[2:]] + two[line[:-2], line[2:]] - whole[line[1:-1], line[:-2]]
    assert logp.mean() > math.log(1 / 6)


def test_every_position_is_trained_on(ready):
    """15 words and the end: every 16th position alone would only ever be the first word."""
    words = [f"word{i}" for i in range(15)]
    docs = ready.createDataFrame([(i, " ".join(words)) for i in range(200)], "doc_id long, text string").coalesce(1)
    counts, _ = lbl.summed(lbl.token_counts(docs))
    moved = np.abs(lbl.fit(lbl.shards(docs, counts), counts).context - lbl.start(counts).context).max(axis=1)
    assert (moved[lbl._classes(pa.array(words, pa.large_string()), counts)] > 0).all()


def test_scores_do_not_depend_on_the_cut(docs, monkeypatch):
    """Texts in 1, 8 and 64 partitions, several shards, pieces shorter than the texts."""
    monkeypatch.setattr(lbl, "SHARD_TOKENS", 20_000)
    monkeypatch.setattr(lbl, "PIECE_TOKENS", 100)
    found = []
    for cut in (1, 8, 64):
        rows = docs.select("doc_id", "text").repartition(cut)
        found.append({r["doc_id"]: (r["score"], r["base_score"], r["n_tokens"]) for r in lbl.score(rows, rows).collect()})
    assert found[0].keys() == found[1].keys() == found[2].keys()
    for key, (score, base, n) in found[0].items():
        assert all(f[key][0] == pytest.approx(score, abs=1e-6) and f[key][2] == n for f in found[1:])
    gain = sum(s - b for s, b, _ in found[0].values()) / sum(n for _, _, n in found[0].values())
    assert gain > 0.05


def test_shards_hold_every_position_once(docs, monkeypatch):
    monkeypatch.setattr(lbl, "SHARD_TOKENS", 20_000)
    monkeypatch.setattr(lbl, "PIECE_TOKENS", 100)
    counts, _ = lbl.summed(lbl.token_counts(docs))
    rows = lbl.shards(docs, counts).collect()
    assert len(rows) > 5 and len({r["shard"] for r in rows}) == len(rows)
    assert sum(len(lbl._positions(np.frombuffer(r["lines"], np.int16), np.array(r["lengths"]))) for r in rows) == counts.tokens


def test_common_words_are_looked_up_without_a_new_table(docs, monkeypatch):
    """Places by hash are those by comparison, also where hashes are equal; and no batch makes a table of all common words."""
    words = pa.array([*dict.fromkeys(prose(1, 500).split()), "", "é", "x" * 40], pa.large_string())
    asked = pa.array(["", "é", "nowhere", "x" * 40, "x" * 41, *words.to_pylist()[:50]], pa.large_string())
    wanted = [words.to_pylist().index(w) if w in words.to_pylist() else -1 for w in asked.to_pylist()]
    assert lbl.Head(words).places(asked).tolist() == wanted
    assert lbl.Head(words[:0]).places(asked).tolist() == [-1] * len(asked)
    with monkeypatch.context() as patch:
        patch.setattr(lbl.tx, "strong_hashes", lambda strings, seed: np.zeros(len(strings), np.uint64))
        assert lbl.Head(words).places(asked).tolist() == wanted
    counts, _ = lbl.summed(lbl.token_counts(docs))
    products, common, tables, true = lbl.tables(lbl.start(counts)), lbl.Head(counts.head), [], lbl.pc.index_in
    monkeypatch.setattr(lbl, "pc", type("Counted", (), {"__getattr__": lambda self, name: (
        (lambda strings, table: tables.append(len(table)) or true(strings, table)) if name == "index_in" else getattr(pa.compute, name))})())
    found = lbl._sums_of(words, np.arange(len(words)), np.array([0, len(words)]), counts, products, common)
    assert found["n_tokens"].tolist() == [len(words) + 1] and max(tables) <= lbl.SINGLE


def test_scoring_without_training_texts(edges):
    got = lbl.score(edges, edges.limit(0)).collect()
    assert len(got) == len(EDGES) and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in got)
    assert lbl.score(edges.limit(0), edges).count() == 0


def test_prose_differs():
    assert prose(1, 5) != prose(2, 5)


def test_segments_of_several_texts_are_solved_together(monkeypatch):
    """The same pieces as one by one, and no short segment is solved alone."""
    vocabulary = pieces.load()
    texts = ["", "\n\n  a\n", "▁▁ x", "héllo wörld 日本語 😀😀", "\x00\x01 b", "é" * 40, None, " \n ", *(prose(k, 300) for k in range(5))]
    cut = pieces.Encoder(vocabulary).segments
    alone = [None if t is None else sum((pieces.best(vocabulary, s.encode()) for s in cut(" " + t)), []) if t else [] for t in texts]
    assert pieces.best_of(vocabulary, pieces.arrays(vocabulary), [])[0].tolist() == []

    def never(*_):
        raise AssertionError("solved alone")

    with monkeypatch.context() as patch:
        patch.setattr(pieces, "TOGETHER", 7)
        patch.setattr(pieces, "best", never)
        coder = pieces.Encoder(vocabulary)
        found = coder.encode_all([t for t in texts if t != "é" * 40])
    assert [None if f is None else np.frombuffer(f, np.int32).tolist() for f in found] == [a for a, t in zip(alone, texts) if t != "é" * 40]
    assert coder.all_exact
    # a long segment is solved, and not kept
    assert np.frombuffer(coder.encode("é" * 40), np.int32).tolist() == alone[5] and " " + "é" * 40 not in coder.known
