"""Operators that compare documents with each other, against plain versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from searchtide.llm import mixing, neardup, sanitise, shared, substrings, syncmers, warc
from tests.llm.conftest import CLASHING, EDGES, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def rows_of(frame):
    return [(r["doc_id"], r["text"]) for r in frame.collect()]


# --- near duplicates ----------------------------------------------------------------------------


def plain_fingerprint(text):
    words = WORD.findall(lower(text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, distance=4):
    """Group of each fingerprint by brute force."""
    group = {p: p for p in prints}

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for a, b in combinations(sorted(set(prints)), 2):
        if (a ^ b).bit_count() <= distance:
            group[find(a)] = find(b)
    return {p: find(p) for p in prints}


def check_groups(rows, got):
    prints = [(key, plain_fingerprint(text)) for key, text in rows]
    group = plain_groups([p for _, p in prints])
    least = {}
    for key, p in prints:
        if key is not None:
            least[group[p]] = min(key, least.get(group[p], key))
    expected = Counter((key, f"{p:016x}", least.get(group[p])) for key, p in prints)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == expected


def test_near_duplicates(edges, docs):
    for frame in (edges, docs):
        check_groups(rows_of(frame), neardup.near_duplicates(frame).collect())
    assert neardup.near_duplicates(edges.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_links_of_dense_clusters(ready, seed):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 1 << 63, 6)
    near = [int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for c in centres for _ in range(60)]
    frame = ready.createDataFrame([(i, neardup._signed(p)) for i, p in enumerate(near)], "doc_id long, bits long")
    got = {r["bits"]: r["component_id"] for r in neardup.groups(frame).collect()}
    group = plain_groups(near)
    least = {}
    for i, p in enumerate(near):
        least.setdefault(group[p], i)
    assert all(got[neardup._signed(p)] == least[group[p]] for p in near)


def test_links_found_grow_with_the_nodes(ready, monkeypatch):
    """All 400 nodes of a cluster are linked to each other; only a few of these links are listed, and two nodes beside it are still found."""
    rng = np.random.default_rng(5)
    near = sorted({sum(1 << int(b) for b in rng.choice(64, 3, replace=False)) for _ in range(400)})
    far = [near[0] ^ (0b1111111 << 50), near[0] ^ (0b1111111 << 50) ^ (0b1111111 << 20)]
    plain, listed = neardup._links, []

    def counted(*args):
        found = plain(*args)
        listed.append(found.count())
        return found

    monkeypatch.setattr(neardup, "_links", counted)
    rows = [(i, neardup._signed(p)) for i, p in enumerate([*near, *far])]
    got = {r["bits"]: r["component_id"] for r in neardup.groups(ready.createDataFrame(rows, "doc_id long, bits long"), 7).collect()}
    assert {got[b] for _, b in rows} == {0}
    # no two nodes are within one bit, and all pairs would be 200 for each node
    assert sum(listed) < 40 * len(rows)


@pytest.mark.parametrize("most", [1 << 19, 20])
def test_cells_cut_into_chunks_lose_no_link(ready, monkeypatch, most):
    monkeypatch.setattr(neardup, "CELL_NODES", most, raising=False)
    rng = np.random.default_rng(11)
    near = sorted({int(c) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 9), replace=False)) for c in rng.integers(0, 1 << 63, 3) for _ in range(70)})
    nodes = ready.createDataFrame([(neardup._signed(p), i, neardup._signed(p)) for i, p in enumerate(near)], "bits long, least long, root long")
    partitions = [(neardup._mask(range(k, 64, 3)), [0, *(neardup._mask([b]) for b in range(k, 64, 3)), *(neardup._mask(c) for c in combinations(range(k, 64, 3), 2))]) for k in range(3)]
    links = neardup._links(nodes, partitions, 7)
    # probes are compared where they are: a node moves once for each piece of a partition, and only the table of large cells is joined
    assert links._jdf.queryExecution().executedPlan().toString().count("Join ") == (most < len(near))
    root = {b: b for b in map(neardup._signed, near)}
    for u, v in links.select("u", "v").collect():
        assert u > v
        root = {k: root[v] if g == root[u] else g for k, g in root.items()} if root[u] != root[v] else root
    group = plain_groups(near, 7)
    assert {frozenset(k for k in root if root[k] == g) for g in root.values()} == {frozenset(neardup._signed(p) for p in near if group[p] == g) for g in group.values()}
    assert len({*group.values()}) > 3


def test_tables_of_a_round_are_removed(ready):
    """The rounds of near copies write texts' shingles anew; only what the result reads is left in the shared folder."""
    import os

    top = shared.new_folder(ready, "x").removeprefix("file:").rsplit("/", 1)[0]
    there = lambda: {f for f in (os.listdir(top) if os.path.isdir(top) else []) if f.split("-")[0] in ("open", "alike", "members", "nodes", "leaders")}
    before, rows = there(), near_copies(2)
    kept = neardup.keep_one(ready.createDataFrame(rows, "doc_id long, text string"), distance=24)
    # the last state of the nodes and of what is open, and the leaders of the round that found none
    assert len(there() - before) <= 3
    check_kept(rows, rows_of(kept), 24)


@pytest.mark.parametrize("most", [100_000, 100, 0])
def test_rows_without_some_ids(ready, most):
    rows = [(k if k % 50 else None, str(k), k) for k in range(600)] + [(7, "again", 0), (9, "again", 0)]
    docs = ready.createDataFrame(rows, "doc_id long, text string, slot long")
    goes = shared.staged(ready.range(0, 600, 3).select(F.col("id").alias("gone_id")), "gone")
    kept = neardup._without(docs, "doc_id", goes, most)
    assert kept.columns == docs.columns
    assert Counter(map(tuple, kept.collect())) == Counter(r for r in rows if r[0] is None or r[0] % 3)


def test_small_files_do_not_make_a_broadcast(ready):
    """What has more rows than may be broadcast is joined by shuffle, however few bytes its files have; so are tables nobody has counted."""
    table = shared.staged(ready.range(50).select(F.col("id").alias("key")), "keys")
    other = ready.range(1000).select(F.col("id").alias("key"))
    plan = lambda frame: frame._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(other.join(shared.counted(table, 50), "key"))
    assert "BroadcastHashJoin" not in plan(other.join(shared.counted(table, 49), "key"))
    wide = shared.staged(table.withColumn("terms", F.array_repeat(F.lit("term"), 10)), "keys")
    assert "BroadcastHashJoin" in plan(other.join(shared.counted(wide, 50, "terms"), "key"))
    wide = shared.staged(table.withColumn("terms", F.array_repeat(F.lit("term"), 11)), "keys")
    assert "BroadcastHashJoin" not in plan(other.join(shared.counted(wide, 50, "terms"), "key"))
    nodes = shared.staged(ready.range(100).select(F.col("id").alias("bits"), F.col("id").alias("least"), F.col("id").alias("root")), "nodes")
    found = neardup.components(ready.createDataFrame([(2, 1), (5, 1)], "u long, v long"))
    assert "BroadcastHashJoin" not in plan(neardup._rooted(nodes, found))


def test_thresholds_cover_the_distance():
    cost, chosen = neardup.allocated(1000, [22, 21, 21], [[10.0, 50.0, 100.0], [9e9, 9e9, 9e9], [10.0, 50.0, 100.0]])
    assert sum(t + 1 for t in chosen) == 5 and chosen[1] == -1 and cost < 1e9
    assert sorted(b for g in neardup.grouped_bits(10, np.eye(64) * 5, 5) for b in g) == list(range(64))


def shingles(text, size=5):
    words = WORD.findall(lower(text))
    return frozenset(" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def alike(a, b):
    return len(a & b) >= 0.8 * len(a | b)


def plain_bits(text):
    found = [xxhash.xxh64_intdigest(w.encode(), 42) for w in set(WORD.findall(lower(text)))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in found) > len(found))


def check_kept(rows, kept, distance=neardup.KEEP_DISTANCE):
    """In ascending order each document stays that is not similar to one of its group that stays; groups are linked by fingerprints."""
    sets = {key: shingles(text) for key, text in rows}
    bits = {key: plain_bits(text) for key, text in rows}
    group = {key: key for key in sets}
    for x, y in combinations(sorted(sets), 2):
        if group[x] != group[y] and (bits[x] ^ bits[y]).bit_count() <= distance:
            group = {k: group[x] if g == group[y] else g for k, g in group.items()}
    stay = []
    for key in sorted(sets):
        if not any(group[k] == group[key] and alike(sets[key], sets[k]) for k in stay):
            stay.append(key)
    assert sorted(k for k, _ in kept) == stay


def near_copies(seed):
    import random

    draw = random.Random(seed)
    rows = []
    for family in range(12):
        words = prose(seed * 100 + family, 150).split()
        for _ in range(draw.randrange(1, 9)):
            changed = list(words)
            for _ in range(draw.randrange(0, 5)):
                changed[draw.randrange(len(changed))] = f"x{draw.randrange(999)}"
            rows.append(" ".join(changed))
            if draw.random() < 0.3:
                words = changed
    draw.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", range(2))
def test_one_of_each_group_stays(ready, docs, seed):
    rows = near_copies(seed) if seed else rows_of(docs)
    kept = neardup.keep_one(ready.createDataFrame(rows, "doc_id long, text string"))
    kept = rows_of(kept)
    assert len(kept) < len(rows) and set(kept) <= set(rows)
    check_kept(rows, kept)


def test_most_near_copies_go(ready):
    """Of the pairs of different texts that share 0.8 of their shingles, at most one in ten stays."""
    rows = [(1000 * seed + key, text) for seed in (3, 4, 5) for key, text in near_copies(seed)]
    kept = {k for k, _ in rows_of(neardup.keep_one(ready.createDataFrame(rows, "doc_id long, text string")))}
    sets = {key: shingles(text) for key, text in rows}
    pairs = [p for p in combinations(sets, 2) if sets[p[0]] != sets[p[1]] and alike(sets[p[0]], sets[p[1]])]
    assert len(pairs) > 50 and sum(x in kept and y in kept for x, y in pairs) <= 0.1 * len(pairs)


@pytest.mark.parametrize("leaders", [1, 3, 64])
def test_rounds_do_not_change_what_stays(ready, monkeypatch, leaders):
    """One group of many texts that are no copies of each other, each with near copies."""
    monkeypatch.setattr(neardup, "MOST_LEADERS", leaders)
    rows = near_copies(7)
    kept = rows_of(neardup.keep_one(ready.createDataFrame(rows, "doc_id long, text string"), distance=24))
    check_kept(rows, kept, 24)


def test_a_chain_is_not_one_copy(ready):
    """Each is similar to the next, the ends are not similar to each other: the ends stay."""
    words = prose(8, 300).split()
    rows = [(k, " ".join([*(f"new{i}" for i in range(10 * k)), *words[10 * k :]])) for k in range(7)]
    assert not alike(shingles(rows[0][1]), shingles(rows[-1][1])) and alike(shingles(rows[0][1]), shingles(rows[1][1]))
    kept = rows_of(neardup.keep_one(ready.createDataFrame(rows, "doc_id long, text string"), distance=24))
    check_kept(rows, kept, 24)
    assert {k for k, _ in kept} > {0}


def test_one_stays_of_edges(edges):
    kept = neardup.keep_one(edges)
    assert kept.columns == edges.columns and neardup.keep_one(edges.limit(0)).count() == 0
    got = Counter(r["doc_id"] for r in kept.collect())
    # null, empty and blank are equal, and so are 5 and 6; 7 is also a near copy of 5; rows with one id stay or go together; no id always stays
    assert got == Counter(i for i, _, _, _ in EDGES if i not in (1, 2, 6, 7))


def test_components_of_chains_and_stars(ready):
    links = [(i + 1, i) for i in range(50)] + [(200 + i, 100) for i in range(50)]
    got = {r["node"]: r["root"] for r in neardup.components(ready.createDataFrame(links, "u long, v long")).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[200 + i] for i in range(50)} == {100}


# --- repeated passages --------------------------------------------------------------------------


def plain_removed(rows):
    """Words left of each document, by a set of all windows seen so far."""
    seen, out = {}, {}
    for key, text in sorted(rows):
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for s in range(len(words) - 19):
            window = tuple(words[s : s + 20])
            if window in seen:
                gone[s : s + 20] = [True] * 20
            else:
                seen[window] = (key, s)
        out[key] = (len(words), sum(gone), " ".join(w for w, g in zip(words, gone) if not g))
    return out


def check_removed(ready, rows):
    got = substrings.deduplicated(ready.createDataFrame(rows, "doc_id long, text string")).collect()
    expected = plain_removed(rows)
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in got} == expected
    assert all(sum(s["stop"] - s["start"] for s in r["removed"]) == r["n_removed"] for r in got)


def test_repeats(ready, docs):
    check_removed(ready, rows_of(docs))


@pytest.mark.parametrize("seed", range(2))
def test_passages_that_share_parts(ready, seed):
    import random

    draw = random.Random(seed)
    passage = prose(99, 90).split()
    rows = []
    for i in range(60):
        a = draw.randrange(0, 60)
        part = passage[a : a + draw.randrange(10, 45)]
        rows.append((i, " ".join([*prose(i, draw.randrange(0, 30)).split(), *part, *prose(i + 500, draw.randrange(0, 9)).split(), *part[: draw.randrange(0, 30)]])))
    rows += [(100, "a b " * 60), (101, "a b " * 40), (102, None), (103, ""), (104, " ".join(passage[:20])), (105, " ".join(passage[:19]))]
    check_removed(ready, rows)


def test_words_that_polynomial_hashes_confuse(ready):
    """Two Thue-Morse words of 1,024 letters: equal under every polynomial modulo a power of two, but not the same word."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    two = "".join("ba"[bin(i).count("1") % 2] for i in range(1024))
    begin = " ".join(f"w{i}" for i in range(19))
    rows = ready.createDataFrame([(1, f"{begin} {one}"), (2, f"{begin} {two}"), (3, f"{begin} {one}")], "doc_id long, text string")
    assert {r["doc_id"]: r["n_removed"] for r in substrings.deduplicated(rows).collect()} == {1: 0, 2: 0, 3: 20}


def test_repeats_of_edges(edges):
    got = substrings.deduplicated(edges).collect()
    assert len(got) == len(EDGES) and substrings.deduplicated(edges.limit(0)).count() == 0
    by = {r["doc_id"]: r for r in got if r["doc_id"] not in (7, 11)}
    # the row without an id is the smallest and keeps its words
    assert by[None]["n_removed"] == 0 and by[5]["n_removed"] == 120 and by[6]["n_removed"] == 120


# --- personal data ------------------------------------------------------------------------------

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for place, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = [int(d) for d in re.sub("[^0-9]", "", m.group())]
            if kind == "ip" and max(map(int, m.group().split("."))) > 255 or kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
                if not 14 <= len(digits) <= 19 or total % 10:
                    continue
            out.append((m.start(), place, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(out))


def test_base_spans(ready, edges, docs):
    import random

    draw = random.Random(5)
    odd = [(i, "".join(draw.choice("a1 .@+-()é4\n") for _ in range(draw.randint(0, 90)))) for i in range(300)]
    odd += [(300, "a@b.c_d@e.f 4111-1111-1111-1111 " * 400), (301, "1 " * 4000), (302, "a" * 20_000 + "@"), (303, "0001.2.3.4 1.2.3.4.5.6.7.8 256.1.1.1 +1 (555) 123-4567")]
    for frame in (ready.createDataFrame(odd, "doc_id long, text string"), edges, docs):
        rows = rows_of(frame)
        got = frame.select("doc_id", sanitise.joined_spans(sanitise.base_spans(F.coalesce("text", F.lit("")))).alias("s")).collect()
        assert Counter((r["doc_id"], r["s"]) for r in got) == Counter((k, plain_spans(t)) for k, t in rows)


SECRET = [(i, f"{prose(i, 3)} {w} Zorblax wrote to secret.person@corp.org {v} about {prose(i + 50, 60)} zorblax") for i, (w, v) in enumerate(
    [("when", "today"), ("then", "again"), ("where", "once"), ("why", "later")])] + [(10 + i, f"when the then where why {prose(i, 80)} wrote about") for i in range(40)]


def test_terms_that_reveal(ready):
    docs = ready.createDataFrame(SECRET, "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in sanitise.spans(docs).select("doc_id", sanitise.joined_spans(F.col("all_spans")).alias("s")).collect()}
    for key, text in SECRET[:4]:
        places = {(m.start(), m.end()) for m in re.finditer("(?i)zorblax", text)}
        assert places == {tuple(map(int, s.split(":")[1:])) for s in got[key].split(",") if s.startswith("term")}
    assert not any("term" in got[key] for key, _ in SECRET[4:])
    # by brute force: PMI over the information of the entity
    found = sanitise.mentions(docs)
    scores = {r["term"]: r["disclosure"] for r in sanitise.disclosures(docs, found, threshold=-9.0).collect()}
    n, n_t = len(SECRET), sum("wrote" in t for _, t in SECRET)
    assert scores["zorblax"] == pytest.approx(1.0)
    assert scores["wrote"] == pytest.approx(np.log2(4 * n / (4 * n_t)) / -np.log2(4 / n))


def test_copies_reveal_nothing(ready):
    docs = ready.createDataFrame([(i, "Zorblax wrote to secret.person@corp.org today") for i in range(9)] + [(20 + i, prose(i, 9)) for i in range(9)], "doc_id long, text string")
    assert sanitise.spans(docs).where("size(all_spans) > size(base)").count() == 0


def test_terms_far_from_values_of_few_documents(ready):
    """A value of two documents, and values of one document each that share a domain; terms stand many words away."""
    rows = [(i, f"{prose(i, 30)} Quuxley {prose(i + 9, 40)} rare.person@home.org {prose(i + 20, 20)} {w}") for i, w in enumerate(["oncewritten", "alsorare"])]
    rows += [(10 + i, f"{prose(i + 60, 25)} Zibblet {prose(i + 70, 30)} {w}@club.org") for i, w in enumerate(["ann", "bob", "cid"])]
    rows += [(30 + i, prose(i + 100, 80)) for i in range(60)]
    docs = ready.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["s"] for r in sanitise.spans(docs).select("doc_id", sanitise.joined_spans(F.col("all_spans")).alias("s")).collect()}
    for key, text in rows:
        places = {(m.start(), m.end()) for m in re.finditer("Quuxley|Zibblet", text)}
        assert places == {tuple(map(int, s.split(":")[1:])) for s in got[key].split(",") if s.startswith("term")}


def test_sanitised(ready, edges):
    docs = ready.createDataFrame(SECRET, "doc_id long, text string")
    text = {r["doc_id"]: r["text"] for r in sanitise.sanitised(docs).collect()}
    assert all("<email>" in text[k] and "orblax" not in text[k] and "corp.org" not in text[k] for k in range(4))
    assert all(text[k] == t for k, t in SECRET[4:])
    out = sanitise.sanitised(edges)
    assert out.columns == edges.columns
    assert Counter((r["doc_id"], r["text"], r["kept"]) for r in out.collect()) == Counter((i, t, "own kept") for i, t, _, _ in EDGES)
    assert sanitise.spans(edges.limit(0)).count() == sanitise.sanitised(edges.limit(0)).count() == 0


# --- mixing -------------------------------------------------------------------------------------


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, target, full = sum(sizes.values()), {}, set()
    while True:
        left, share = total - sum(most * sizes[s] for s in full), sum(weight[s] for s in order if s not in full)
        target = {s: most * sizes[s] if s in full else left * weight[s] / share for s in order}
        over = {s for s in order if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_words_taken(edges, docs):
    for frame in (edges, docs):
        sizes = Counter()
        for r in frame.collect():
            sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
        target = plain_targets(sizes)
        got = mixing.targets(mixing.sizes(frame)).collect()
        assert {r["source"]: r["source_size"] for r in got} == dict(sizes)
        assert all(r["target"] == pytest.approx(target[r["source"]]) for r in got)
    longest = max(len(WORD.findall(r["text"])) for r in docs.collect())
    mixed = mixing.mix(docs).join(docs.select("doc_id", "source"), "doc_id").collect()
    assert all(r["taken"] <= 3 * r["size"] for r in mixed) and len(mixed) == docs.count()
    for source in {r["source"] for r in mixed}:
        own = [r for r in mixed if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= longest / 2 + 1


def test_mixed_rows(edges):
    out = mixing.mixed(edges)
    assert out.columns == edges.columns and set(CLASHING) <= set(out.columns)
    times = Counter((r["doc_id"], r["copies"]) for r in mixing.mix(edges).collect())
    expected = Counter()
    for (key, copies), n in times.items():
        expected[key] += copies * n
    assert Counter(r["doc_id"] for r in out.collect()) == +expected
    assert mixing.mix(edges.limit(0)).count() == mixing.mixed(edges.limit(0)).count() == 0


def test_budgets_are_nested(docs):
    sized = mixing.sizes(docs)
    small, large = ({r["s"]: r["threshold"] for r in mixing.thresholds(sized, mixing.targets(sized).withColumn("rest", F.col("source_size") * part)).collect()} for part in (0.2, 0.6))
    assert all(small[s] <= large.get(s, 1 << 60) for s in small)


# --- fingerprints -------------------------------------------------------------------------------


def plain_followers(rows):
    order = sorted((k, t or "") for k, t in rows if k is not None)
    return {(k, t): order[(i + 1) % len(order)][1] for i, (k, t) in enumerate(order)}


@pytest.mark.parametrize("parts", ["1", "8"])
def test_edited_texts(ready, edges, docs, parts):
    before = ready.conf.get("spark.sql.shuffle.partitions")
    ready.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        for frame in (docs, edges.where("doc_id <> 11")):
            rows = rows_of(frame)
            after = plain_followers(rows)
            expected = Counter()
            for key, text in rows:
                text = text or ""
                half = len(text) // 2
                edited = text[: len(text) - half] + (after[key, text] if key is not None else "")[:half]
                expected[key, len(text), hashlib.sha256(edited.encode()).hexdigest()] += 1
            got = syncmers.compared(frame).collect()
            assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == expected
            assert all(0 <= r["near_edited"] <= 1 and (r["near_next"] is None) == (r["doc_id"] is None) for r in got)
    finally:
        ready.conf.set("spark.sql.shuffle.partitions", before)


def test_ids_may_be_texts(ready, docs):
    """In the order of the ids as texts."""
    named = docs.select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("doc_id"), "text")
    rows = sorted((r["doc_id"], r["text"] or "") for r in named.collect())
    expected = {}
    for (key, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(text) // 2
        expected[key] = hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()
    assert {r["doc_id"]: r["edited_sha256"] for r in syncmers.compared(named).collect()} == expected


def test_anchors_are_closed_syncmers(ready, docs):
    """The smallest inner pair of an anchor is its first or last, and no other run has that."""
    frame = docs.where("n_chars < 3000").limit(40)
    pairs = frame.select("doc_id", syncmers.word_hashes(F.col("text")).alias("w")).select("doc_id", "w", syncmers.pair_hashes(F.col("w")).alias("p"))
    for r in pairs.select("w", "p", syncmers.anchors(F.col("w"), F.col("p")).alias("a")).collect():
        if len(r["p"]) >= syncmers.PAIRS:
            runs = [r["p"][i : i + syncmers.PAIRS] for i in range(len(r["p"]) - syncmers.PAIRS + 1)]
            assert [a["at"] for a in r["a"]] == [i for i, x in enumerate(runs) if min(x) in (x[0], x[-1])]


def test_moved_passage_keeps_its_anchors(ready):
    passage = prose(7, 60)
    frame = ready.createDataFrame([(1, passage), (2, f"{prose(8, 33)} {passage} {prose(9, 20)}"), (3, prose(10, 60))], "doc_id long, text string")
    found = syncmers.anchored(frame)
    shared = syncmers.aligned(found.where("doc_id = 1"), found.where("doc_id > 1")).collect()
    assert {(r["other_id"], r["shift"]) for r in shared} == {(2, 33)}
    assert shared[0]["shared"] == found.where("doc_id = 1").select(F.size("anchors")).first()[0]


def test_fingerprints_of_edges(ready, edges):
    got = syncmers.compared(edges).collect()
    assert len(got) == len(EDGES) and syncmers.compared(edges.limit(0)).count() == 0
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[5] == prints[6] == prints[None] and prints[0] == prints[1] == prints[2] == ""
    one = syncmers.compared(ready.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")).first()
    assert one["near_next"] == 1.0


def test_results_hold_every_anchor(ready):
    """Long texts that differ at the end only; likeness follows from what is returned."""
    common = prose(21, 1500)
    frame = ready.createDataFrame([(1, f"{common} {prose(22, 8)}"), (2, f"{common} {prose(23, 8)}")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in syncmers.compared(frame).collect()}
    whole = {r["doc_id"]: r["anchors"] for r in syncmers.anchored(frame).collect()}
    assert all(got[k]["anchors"] == whole[k] and len(whole[k]) > 300 for k in (1, 2))
    assert got[1]["fingerprint"] != got[2]["fingerprint"]
    one, two, new = ({a["hash"] for a in x} for x in (got[1]["anchors"], got[2]["anchors"], got[1]["edited_anchors"]))
    assert got[1]["near_next"] == pytest.approx(2 * len(one & two) / (len(one) + len(two)))
    assert got[1]["near_edited"] == pytest.approx(2 * len(one & new) / (len(one) + len(new)))


# --- archives -----------------------------------------------------------------------------------

PAGES = [(1, "http://a b/\n", "x\r\n\r\nWARC/1.0\n"), (2, None, None), (3, "", ""), (5, "u", "é"), (4, "u", "é"), (None, "u", "é"), (7, "u", "q"), (7, "u", "q"), (8, "v", "long " * 90_000)]


def test_archives(ready, tmp_path):
    pages = ready.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("payload", F.lit("own"))
    got = warc.round_trip(pages).collect()
    best = {}
    for key, _, html in PAGES:
        best[html or ""] = max(-1 if key is None else key, best.get(html or "", -1))
    expected = Counter()
    for key, _, html in PAGES:
        payload = (html or "").encode()
        kind = "response" if key == best[html or ""] else "revisit"
        expected[key, len(payload), warc.sha1(payload), kind, best[html or ""] if kind == "revisit" else None] += 1
    assert Counter(map(tuple, got)) == expected
    assert warc.round_trip(pages.limit(0)).count() == 0


def test_both_arc_versions_are_read(ready, tmp_path):
    pages = ready.createDataFrame([(i, f"http://h/{i}", f"page {i}\nend") for i in range(25)], "page_id long, url string, html string").coalesce(2)
    warc.write_arc(pages, f"{tmp_path}/arc", records=4)
    files = [warc.unpacked(p.read_bytes()) for p in (tmp_path / "arc").glob("part-*")]
    versions = {c.split(b"\n")[1].split(b" ")[0] for c in files}
    assert versions == {b"1", b"2"} and all(c.startswith(b"filedesc://") for c in files)
    blocks = [block for c in files for _, block in warc.parse_arc(c)]
    assert sorted(b.partition(b"\r\n\r\n")[2] for b in blocks) == sorted(f"page {i}\nend".encode() for i in range(25))
    warc.convert(ready, f"{tmp_path}/arc", f"{tmp_path}/warc", records=4)
    records = [x for p in (tmp_path / "warc").glob("part-*") for x in warc.parse_warc(warc.unpacked(p.read_bytes()))]
    assert Counter(f["WARC-Type"] for f, _ in records)["response"] == 25
    assert all(f["WARC-Date"] == "2024-01-01T00:00:00Z" and f["WARC-Record-ID"].startswith("<urn:uuid:") for f, _ in records)


_HTTP = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"


def _of(line, block):
    return line + b" %d\n" % len(block) + block + b"\n"


def test_archives_of_others():
    """Both versions as the format describes them, without headers of our own."""
    body = b"URL IP-address Archive-date Content-type Archive-length\n"
    first = _of(b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain", b"1 0 Crawler\n" + body)
    blocks = [_HTTP + b"<html>a</html>", b"HTTP/1.1 200 OK\nServer: x\n\nbare newlines", b"20010203040506\nexample.org. 10 IN A 1.2.3.4\n", b"no head at all", b"HTTP/1.0 404\r\n\r\n"]
    lines = [b"http://e.org/ 1.2.3.4 20010203040506 text/html; charset=utf-8", b"http://e.org/a b 1.2.3.4 20010203040506 text/html", b"dns:e.org 1.2.3.4 20010203040506 text/dns",
             b"ftp://e.org/x 1.2.3.4 200102030405 application/octet-stream", b"http://e.org/n 1.2.3.4 20010203 no-type"]
    content = first + b"".join(map(_of, lines, blocks))
    found = list(warc.parse_arc(content))
    assert [b for _, b in found] == blocks
    assert found[0][0]["Content-type"] == "text/html; charset=utf-8" and found[1][0]["URL"] == "http://e.org/a b"
    assert [warc.split_block(b)[1] for b in blocks] == [b"<html>a</html>", b"bare newlines", blocks[2], blocks[3], b""]
    assert [warc.warc_date(f["Archive-date"]) for f, _ in found][3:] == ["2001-02-03T04:05:00Z", "2001-02-03T00:00:00Z"]
    # version 2, and no record of the file itself
    second = _of(b"filedesc://b.arc 0.0.0.0 20010203040506 text/plain 200 - - 0 b.arc", b"2 0 Crawler\n" + warc.ARC_FIELDS[2].encode() + b"\n")
    line = b"http://e.org/ 1.2.3.4 20010203040506 text/html; charset=utf-8 301 c0ffee http://e.org/y 77 b.arc"
    (fields, block), = warc.parse_arc(second + _of(line, blocks[0]))
    assert block == blocks[0] and (fields["Content-type"], fields["Result-code"], fields["Filename"]) == ("text/html; charset=utf-8", "301", "b.arc")
    assert [b for _, b in warc.parse_arc(_of(lines[0], blocks[0]))] == blocks[:1]


def test_archives_of_others_are_converted(ready, tmp_path):
    import gzip

    (tmp_path / "arc").mkdir()
    body = b"1 0 Crawler\nURL IP-address Archive-date Content-type Archive-length\n"
    first = _of(b"filedesc://a.arc 0.0.0.0 20010203040506 text/plain", body)
    page = _HTTP + b"same"
    records = [_of(b"http://e.org/1 1.2.3.4 20010203040506 text/html", page), _of(b"http://e.org/2 1.2.3.4 20020203040506 text/html", page),
               _of(b"dns:e.org 1.2.3.4 20010203040506 text/dns", b"answer")]
    # one gzip member for each record, as crawlers write them; and a file cut in the middle of a record
    (tmp_path / "arc" / "a.arc.gz").write_bytes(b"".join(map(gzip.compress, [first, *records])))
    (tmp_path / "arc" / "b.arc").write_bytes(first + records[0].replace(b"/1", b"/3") + records[1][:-20])
    (tmp_path / "arc" / "c.arc.gz").write_bytes(gzip.compress(first + records[2].replace(b"e.org", b"f.org"))[:-12])
    damaged = {(r["file"].rsplit("/", 1)[1], r["reason"]) for r in warc.damaged_arc(ready, f"{tmp_path}/arc").collect()}
    assert {f for f, _ in damaged} == {"b.arc", "c.arc.gz"} and any("declared" in r for _, r in damaged) and ("c.arc.gz", "gzip ends early") in damaged
    warc.convert(ready, f"{tmp_path}/arc", f"{tmp_path}/warc")
    got = {}
    for p in (tmp_path / "warc").glob("part-*"):
        for fields, block in warc.parse_warc(warc.unpacked(p.read_bytes())):
            got[fields.get("WARC-Target-URI")] = (fields, block)
    kinds = {url: f["WARC-Type"] for url, (f, _) in got.items() if url}
    assert kinds["http://e.org/2"] == "response" and kinds["http://e.org/1"] == kinds["http://e.org/3"] == "revisit" and kinds["dns:e.org"] == "resource"
    assert got["http://e.org/1"][0]["WARC-Refers-To"] == got["http://e.org/2"][0]["WARC-Record-ID"]
    assert got["dns:e.org"][0]["Content-Type"] == "text/dns" and got["dns:e.org"][1] == b"answer"
    assert got["http://e.org/2"][1] == page and got["http://e.org/1"][1] == _HTTP
    read = {r["record_type"] for r in warc.read_warc(ready, f"{tmp_path}/warc").collect()}
    assert read == {"response", "revisit", "resource"}


def test_files_are_bounded_by_bytes(ready, tmp_path, monkeypatch):
    rows = iter([{"html": b"x" * n} for n in (10, 600, 50, 1500, 20, 30)])
    monkeypatch.setattr(warc, "FILE_BYTES", 700)
    files = [b.column(0)[0].as_py() for b in warc._files(rows, lambda r: len(r["html"]), lambda k: b"head%d" % k, lambda r, k: r["html"], "\n", 1000)]
    assert [len(f) for f in files] == [10 + 600 + 50 + 5 + 3, 1500 + 6, 20 + 30 + 5 + 2]
    rows = iter([{"html": b"x"} for _ in range(5)])
    assert len(list(warc._files(rows, lambda r: 1, lambda k: b"h", lambda r, k: b"r", "\n", 2))) == 3


def test_archives_take_less_time_to_compress(ready, tmp_path):
    """Lower than the default level of the same writer, with the same bytes."""
    text = prose(5, 60_000)
    warc._write(ready.createDataFrame([(text,)], "value string").coalesce(1), "\n", f"{tmp_path}/own")
    ready.createDataFrame([(text,)], "value string").coalesce(1).write.option("compression", "gzip").text(f"{tmp_path}/default")
    own, default = (next((tmp_path / n).glob("part-*")).read_bytes() for n in ("own", "default"))
    assert warc.unpacked(own) == warc.unpacked(default) == text.encode() + b"\n"
    assert len(default) < len(own) < 1.1 * len(default)


def test_few_revisits_do_not_move_archives(ready, tmp_path, monkeypatch):
    pages = ready.createDataFrame([(i, f"http://h/{i}", f"page {i // 3}") for i in range(30)], "page_id long, url string, html string")
    warc.write_arc(pages, f"{tmp_path}/arc", records=4)

    def converted(most):
        monkeypatch.setattr(warc, "BROADCAST_ROWS", most)
        files = warc._marked(ready, f"{tmp_path}/arc")
        plan, columns = files._jdf.queryExecution().executedPlan().toString(), files.columns
        warc.convert(ready, f"{tmp_path}/arc", f"{tmp_path}/warc{most}")
        rows = warc.read_warc(ready, f"{tmp_path}/warc{most}").collect()
        number = {r["record_id"]: r["page_id"] for r in rows}
        # files move as they are, never their records
        assert columns == ["path", "content", "revisits"]
        return "SortMergeJoin" in plan, sorted((r["page_id"], r["record_type"], number.get(r["refers_to_record"])) for r in rows)

    # else the small table is sent anyhow
    before = ready.conf.get("spark.sql.autoBroadcastJoinThreshold")
    ready.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        few, many = converted(20), converted(19)
    finally:
        ready.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert (few[0], many[0]) == (False, True)
    assert sorted((r["page_id"], r["payload"]) for r in warc.read_arc(ready, f"{tmp_path}/arc").collect()) == [(i, b"page %d" % (i // 3)) for i in range(30)]
    assert few[1] == many[1] == [(i, "response", None) if i % 3 == 2 else (i, "revisit", i // 3 * 3 + 2) for i in range(30)]


def test_damaged_archives_are_refused():
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://x 0.0.0.0 20240101000000 text/html 3 4 5\nabc\n"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"http://x 0.0.0.0 20240101000000 text/html 30\nabc\n"))
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"nonsense\n"))
