"""SimHash near-duplicates: documents whose 64-bit fingerprints differ in few bits, linked into groups.

Every document gets a fingerprint of its word shingles. Documents with equal fingerprints are one
node. Links between nodes are found by the generalised pigeonhole principle: correlated bits are
grouped into partitions; each partition ``i`` gets a threshold ``t_i``, chosen by dynamic programming
on estimated costs so that the sum of ``t_i + 1`` is one more than the distance allowed; then any linked
pair differs in at most ``t_i`` bits in some partition. Nodes are joined on partition values and on values within the
threshold (probe), the whole fingerprints are compared (verify), and groups are the connected components.

Defined results: a null, empty or blank text has no words and fingerprint zero; all such documents are
equal. Repeated rows and repeated ids are kept. A null id takes part in its group and can only
name the group if all its ids are null. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm import texts as tx
from searchtide.llm.shared import BROADCAST_ROWS, counted, in_sieve, released, shuffled, sieve, staged

SHINGLE_WORDS = 4
SEED = 42
DISTANCE = 4
BITS = 64


def _shingled(texts: pa.Array, size: int) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """Number, words (lower-case, one blank between) and hashes of all shingles of each text that has words."""
    data, offsets = tx.encoded(texts)
    words = tx.words_of(tx.lowered(data), offsets)
    # all words with one blank after each: a shingle is a slice of this
    bounds = np.frombuffer(words.strings.buffers()[1], np.int64)[: len(words.strings) + 1]
    if len(words.strings) == 0:
        return
    begin = bounds[:-1] + np.arange(len(bounds) - 1)
    end = bounds[1:] + np.arange(len(bounds) - 1)
    joined = np.full(end[-1] + 1, 32, np.uint8)
    place = np.arange(bounds[-1]) + np.repeat(np.arange(len(begin)), end - begin)
    joined[place] = np.frombuffer(words.strings.buffers()[2], np.uint8)[: bounds[-1]]
    joined, digest = joined.tobytes(), xxhash.xxh64_intdigest
    for i, (f, t) in enumerate(zip(words.first[:-1], words.first[1:])):
        if t == f:
            continue
        last = max(f, t - size)
        cuts = zip(begin[f : last + 1].tolist(), end[min(f + size, t) - 1 : t].tolist())
        yield i, joined[begin[f] : end[t - 1]], np.array([digest(joined[a:b], SEED) for a, b in cuts], np.uint64)


def text_fingerprints(texts: pa.Array, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A 64-bit fingerprint of each text: the majority of each bit over the hashes of its shingles."""
    out = np.zeros(len(texts), np.uint64)
    for i, _, hashes in _shingled(texts, size):
        out[i] = _majority(hashes)
    return out


def _majority(hashes: np.ndarray, rows: int = 1 << 16) -> np.uint64:
    total = np.zeros(BITS)
    for k in range(0, len(hashes), rows):
        part = hashes[k : k + rows]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += np.ones(len(part), np.float32) @ bits.astype(np.float32)
    return np.packbits(2 * total > len(hashes), bitorder="little").view(np.uint64)[0]


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Columns ``doc_id`` and ``bits`` (the fingerprint as a signed number)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                bits = text_fingerprints(part.column("text")).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(bits)], ["doc_id", "bits"])

    return rows.mapInArrow(hashed, f"doc_id {docs.schema[id_col].dataType.simpleString()}, bits long")


def _together(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of nodes, and for each two bits the nodes that have both (over all nodes, summed by Spark)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            values = batch.column("bits").to_numpy().view(np.uint8).reshape(-1, 8)
            for k in range(0, len(values), 4096):
                bits = np.unpackbits(values[k : k + 4096], axis=1, bitorder="little").astype(np.float32)
                both += (bits.T @ bits).astype(np.int64)
                n += len(bits)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([both.ravel()])], ["n", "both"])

    tables = nodes.select("bits").mapInArrow(counted, "n long, both array<long>")
    cells = tables.select("n", F.posexplode("both").alias("cell", "count"))
    out = np.zeros(BITS * BITS)
    total = 0
    for r in cells.groupBy("cell").agg(F.sum("count").alias("count"), F.sum("n").alias("n")).collect():
        out[r["cell"]], total = r["count"], r["n"]
    return total, out.reshape(BITS, BITS)


def grouped_bits(n: int, both: np.ndarray, parts: int) -> list[list[int]]:
    """Bits cut into ``parts`` groups of nearly equal size, correlated bits together."""
    share = both / max(1, n)
    mean = np.diag(share)
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
    related = np.abs((share - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(related, 0)
    left, groups = list(range(BITS)), []
    for k in range(parts):
        size = (BITS - sum(map(len, groups)) + parts - k - 1) // (parts - k)
        own = [max(left, key=lambda b: (related[b, left].sum(), -b))]
        while len(own) < size:
            own.append(max((b for b in left if b not in own), key=lambda b: (related[b, own].sum(), -b)))
        groups.append(sorted(own))
        left = [b for b in left if b not in own]
    return groups


def _within(same: np.ndarray, most: int) -> np.ndarray:
    """Probability that at most t of independent bits differ, for t = 0 to ``most``."""
    p = np.zeros(most + 2)
    p[0] = 1
    for s in same:
        p[1:] = p[1:] * s + p[:-1] * (1 - s)
        p[0] *= s
    return np.cumsum(p)[: most + 1]


#: estimated cost of one probe row, in units of one compared pair
PROBE_COST = 20.0
MOST_THRESHOLD = 2


def allocated(n: int, widths: list[int], pairs: list[list[float]], distance: int = DISTANCE) -> tuple[float, list[int]]:
    """Cheapest thresholds (-1: unused) with the sum of threshold + 1 equal to distance + 1, by dynamic programming.

    ``pairs[i][t]`` is the estimated number of pairs within ``t`` bits in partition ``i``.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for width, found in zip(widths, pairs):
        costs = [0.0] + [n * sum(comb(width, k) for k in range(t + 1)) * PROBE_COST + found[t] for t in range(len(found))]
        step: dict[int, tuple[float, list[int]]] = {}
        for used, (cost, chosen) in best.items():
            for units, extra in enumerate(costs):
                to = used + units
                if to <= distance + 1 and (to not in step or cost + extra < step[to][0]):
                    step[to] = (cost + extra, [*chosen, units - 1])
        best = step
    return best.get(distance + 1, (float("inf"), []))


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _mask(bits) -> int:
    return _signed(sum(1 << int(b) for b in bits))


def plan(nodes: DataFrame, distance: int = DISTANCE) -> list[tuple[int, list[int]]]:
    """(mask of a partition's bits, masks of bits to flip for its probes) of the cheapest allocation found."""
    n, both = _together(nodes)
    layouts = {m: grouped_bits(n, both, m) for m in range(3, distance + 2)}
    masks = [(m, i, _mask(bits)) for m, groups in layouts.items() for i, bits in enumerate(groups)]
    values = nodes.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("m"), F.lit(i).alias("i"), F.col("bits").bitwiseAND(F.lit(mask)).alias("value")) for m, i, mask in masks
    ])).alias("v")).select("v.*")
    sizes = values.groupBy("m", "i", "value").count()
    equal = {(r["m"], r["i"]): r["pairs"] for r in sizes.groupBy("m", "i").agg(
        F.sum(F.col("count").cast("double") * (F.col("count") - 1) / 2).alias("pairs")).collect()}
    one = np.diag(both) / max(1, n)
    same = one**2 + (1 - one) ** 2
    best: tuple[float, list] = (float("inf"), [])
    for m, groups in layouts.items():
        pairs = []
        for i, bits in enumerate(groups):
            chance = _within(same[bits], MOST_THRESHOLD)
            known = max(1.0, equal.get((m, i), 0.0))
            pairs.append([known * float(c / max(chance[0], 1e-300)) for c in chance])
        cost, thresholds = allocated(n, [len(g) for g in groups], pairs, distance)
        if cost < best[0]:
            best = (cost, [(_mask(bits), [_mask(c) for k in range(t + 1) for c in combinations(bits, k)])
                           for bits, t in zip(groups, thresholds) if t >= 0])
    return best[1]


#: leaders of each partition value that its nodes are compared with first, four times as many each round, at most so many
FIRST_DRAWN, MOST_DRAWN = 4, 64
#: nodes of a cell that are compared in one task; a larger cell is cut into chunks, and each two of them are a cell
CELL_NODES = 1 << 19
#: pairs that are held while they are compared
_PAIRS = 1 << 20


def _near(bits: np.ndarray, value: np.ndarray, label: np.ndarray, flips: list[int], distance: int, most: int | None) -> Iterator[tuple]:
    """Blocks of pairs of places with different labels, within the distance, whose values differ by a flip; and how many places the second's value has.

    Places are in order of their value; of each value only the first ``most`` places are taken as the second. Without ``most``
    all are, and a pair comes once.
    """
    begin = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
    values, size = value[begin], np.diff(np.append(begin, len(value)))
    low, high = np.minimum.reduceat(label, begin), np.maximum.reduceat(label, begin)
    own = np.repeat(np.arange(len(begin)), size)
    for flip in flips:
        wanted = values ^ np.uint64(flip)
        to = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
        asks = values[to] == wanted
        if most is None:
            asks &= to <= np.arange(len(to))
        to = to[own]
        # a node asks only where there are nodes of another group: the inside of a group is not gone through
        asked = np.flatnonzero(asks[own] & ((low[to] != label) | (high[to] != label)))
        to = to[asked]
        count = size[to] if most is None else np.minimum(size[to], most)
        total, k = np.cumsum(count), 0
        while k < len(asked):
            end = max(k + 1, int(np.searchsorted(total, (total[k - 1] if k else 0) + _PAIRS, "right")))
            n = count[k:end]
            i, place = np.repeat(asked[k:end], n), np.repeat(np.cumsum(n) - n, n)
            j = np.repeat(begin[to[k:end]], n) + np.arange(len(i)) - place
            found = (label[i] != label[j]) & (np.bitwise_count(bits[i] ^ bits[j]) <= distance)
            if most is None:
                found &= j < i
            yield i[found], j[found], np.repeat(size[to[k:end]], n)[found]
            k = end


def _hooked(least: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``least`` (for each label the smallest one it is joined with) after the labels ``a`` and ``b`` are joined."""
    while True:
        a, b = least[a], least[b]
        apart = a != b
        if not apart.any():
            return least
        a, b = a[apart], b[apart]
        np.minimum.at(least, np.maximum(a, b), np.minimum(a, b))
        while (least[least] != least).any():
            least = least[least]


def _forest(bits: np.ndarray, root: np.ndarray, mask: int, flips: list[int], distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links ``u > v`` of groups that join what all pairs of these nodes would join that differ by a flip in the partition: fewer than there are groups.

    All pairs of a dense group would grow with the square of its size. So nodes are first compared with a few leaders of each partition
    value, and groups joined by that, until leaders find so few links that those of all pairs are not expected to outnumber the nodes.
    Then all pairs of nodes that are still in different groups are looked at, so that no link is lost whatever was drawn.
    """
    names, label = np.unique(root, return_inverse=True)
    least, value = np.arange(len(names)), bits & np.uint64(mask)
    order = np.lexsort((bits * np.uint64(0x9E3779B97F4A7C15), value))
    bits, value, label = bits[order], value[order], label[order]
    most, expected = FIRST_DRAWN, np.inf if len(names) > 1 else 0
    while expected > len(bits):
        expected = 0
        for i, j, size in _near(bits, value, least[label], flips, distance, most):
            # the pairs if all nodes found what the leaders did; each would be found from both its sides
            expected += (np.maximum(size, most) / most).sum() / 2
            least = _hooked(least, label[i], label[j])
        most = min(4 * most, MOST_DRAWN)
    if len(names) > 1:
        for i, j, _ in _near(bits, value, least[label], flips, distance, None):
            least = _hooked(least, label[i], label[j])
    joined = np.flatnonzero(least != np.arange(len(least)))
    return names[joined], names[least[joined]]


def _cells(partitions: list[tuple[int, list[int]]]) -> list[tuple[int, int, list[int]]]:
    """(bits that are equal in a cell, bits of its partition, bits to flip for its probes), all unsigned.

    A partition is cut into one piece more than bits may differ in it, so that two nodes it links are equal in some piece.
    """
    out = []
    for mask, flips in partitions:
        mask, flips = mask % (1 << BITS), [f % (1 << BITS) for f in flips]
        places, pieces = [b for b in range(BITS) if mask >> b & 1], 1 + max(f.bit_count() for f in flips)
        for k in range(pieces):
            piece = sum(1 << b for b in places[k::pieces])
            out.append((piece, mask, [f for f in flips if not f & piece]))
    return out


def _links(nodes: DataFrame, partitions: list[tuple[int, list[int]]], distance: int) -> DataFrame:
    """Links ``u > v`` of groups that join all groups with nodes within the distance; a link may come several times.

    Probes are not shuffled: a node goes once to each of its cells (:func:`_cells`), and is compared with the others there.
    """
    cells = _cells(partitions)
    items = [F.struct(F.lit(k).alias("cell"), F.col("bits").bitwiseAND(F.lit(_signed(piece))).alias("piece")) for k, (piece, _, _) in enumerate(cells)]
    rows = nodes.select("bits", "root", F.explode(F.array(*items)).alias("at")).select("at.*", F.lit(0).alias("chunks"), "bits", "root")
    if nodes.count() > CELL_NODES:
        large = rows.groupBy("cell", "piece").agg(F.count("*").alias("n")).where(F.col("n") > CELL_NODES)
        large = large.select("cell", "piece", F.ceil(F.col("n") / CELL_NODES).cast("int").alias("n"))
        own = F.pmod(F.xxhash64("bits"), "n").cast("int")
        each = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda k: F.least(k, own) * F.col("n") + F.greatest(k, own))
        cut = rows.drop("chunks").join(counted(staged(large, "cells")), ["cell", "piece"], "left")
        rows = cut.select("cell", "piece", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(0))).otherwise(each)).alias("chunks"), "bits", "root")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[batch.column(c).to_numpy() for c in ("cell", "chunks", "bits", "root")] for batch in batches if batch.num_rows]
        if not parts:
            return
        cell, chunks, bits, root = map(np.concatenate, zip(*parts))
        order = np.lexsort((chunks, cell))
        ends = np.flatnonzero((np.diff(cell[order]) != 0) | (np.diff(chunks[order]) != 0)) + 1
        for own in np.split(order, ends):
            _, mask, flips = cells[cell[own[0]]]
            u, v = _forest(bits[own].view(np.uint64), root[own], mask, flips, distance)
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(tasks, "cell", "piece", "chunks").drop("piece").mapInArrow(linked, "u long, v long")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root`` (smallest node reachable) of all nodes that have links ``u > v``.

    Alternates the large-star and small-star steps: every node is linked to the smallest of its
    neighbourhood until only stars are left. A round is written before the next begins.
    """
    edges, before = staged(links.distinct(), "links"), None
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state["n"] == 0 or state == before:
            break
        before = state
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(shuffled(least), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = staged(large, "links")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(shuffled(least), "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(small.union(least).distinct(), "links")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)


def _rooted(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Nodes with their root replaced by the root of that root."""
    named = found.select(F.col("node").alias("root"), F.col("root").alias("new"))
    return nodes.join(shuffled(named), "root", "left").select("bits", "least", F.coalesce("new", "root").alias("root"))


def groups(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """``bits`` and ``component_id`` (smallest id of the group) of each distinct fingerprint of (doc_id, bits).

    Nodes one bit apart are linked first. The probe then only returns links of different groups, as few as join them
    (:func:`_forest`), so that a dense cluster of near copies does not return all its pairs.
    """
    nodes = prints.groupBy("bits").agg(F.min("doc_id").alias("least"))
    nodes = staged(nodes.select("bits", "least", F.col("bits").alias("root")), "nodes")
    halves = [(_mask(range(32)), [0]), (_mask(range(32, 64)), [0])]
    for distance, partitions in ((1, lambda: halves), (distance, lambda: plan(nodes, distance))):
        before, nodes = nodes, staged(_rooted(nodes, components(_links(nodes, partitions(), distance))), "nodes")
        released(before)
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    return nodes.join(shuffled(least), "root").select("bits", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row."""
    prints = staged(fingerprints(docs, id_col, text_col), "prints")
    found = prints.join(shuffled(groups(prints, distance)), "bits")
    digits = F.lower(F.lpad(F.hex("bits"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


#: shingles, distance and similarity (shared over all shingles) by which one of several near copies stays
KEEP_WORDS, KEEP_DISTANCE, KEEP_SIMILARITY = 5, 7, 0.8
#: documents of a group that are compared with the rest of it in one round: one at first, four times as many each round, at most this many
MOST_LEADERS = 64


def _contents(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``bits`` (fingerprint of the words, each once) and ``content`` (128-bit hash of all words) of rows ``doc_id, text``; staged."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                bits, content = np.zeros(part.num_rows, np.uint64), [b""] * part.num_rows
                for i, words, hashes in _shingled(part.column("text"), 1):
                    bits[i], content[i] = _majority(np.unique(hashes)), xxhash.xxh3_128_digest(words)
                columns = [part.column("doc_id"), pa.array(bits.view(np.int64)), pa.array(content, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "bits", "content"])

    return staged(docs.mapInArrow(hashed, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, bits long, content binary"), "contents")


def _shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """``content`` and ``shingles`` (hashes, each once) of rows ``text``."""

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                content, sets = [], []
                for _, words, hashes in _shingled(part.column("text"), size):
                    content.append(xxhash.xxh3_128_digest(words))
                    sets.append(np.unique(hashes).view(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array(content, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], ["content", "shingles"])

    return docs.select("text").mapInArrow(listed, "content binary, shingles array<long>")


def copied(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = KEEP_WORDS,
           distance: int = KEEP_DISTANCE, similarity: float = KEEP_SIMILARITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Contents that the document ``kept_id`` stands for; the contents of all rows with an id; and the contents with their ``least`` ids.

    Texts with equal words are one content. Candidates are contents linked within ``distance`` bits of the fingerprint of their words, each
    taken once: an edited word changes one of these but ``size`` shingles, so that near copies stay close and unlike texts do not. Whether
    they are near copies is decided on the shingles themselves. In each group the smallest ids are compared with all larger ones. Those
    that have no smaller one alike among them stay, and all that share ``similarity`` of their shingles with one of these go; what is left
    over goes on among itself. So the documents that stay are those of taking ids in ascending order and keeping each that is not similar
    to one kept before, and nothing goes that is not similar to a document that stays, however groups are chained.
    """
    rows = docs.where(docs[id_col].isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    prints = _contents(rows)
    nodes = staged(prints.groupBy("content").agg(F.min("doc_id").alias("least"), F.first("bits").alias("bits")), "contents")
    found = groups(nodes.select(F.col("least").alias("doc_id"), "bits"), distance)
    grouped = nodes.join(shuffled(found), "bits").select("content", "least", F.col("component_id").alias("component"))
    several = grouped.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
    members = staged(grouped.join(shuffled(several), "component"), "members")
    # a few texts of others pass the sieve, and find no member below; texts are not shuffled
    sifted = sieve(members, "least")
    sets = _shingle_sets(rows.join(sifted, in_sieve(rows["doc_id"], sifted), "left_semi"), size)
    sets = sets.groupBy("content").agg(F.first("shingles").alias("shingles"))
    left = staged(members.join(shuffled(sets), "content"), "open")
    released(members)
    gone = nodes.limit(0).select("content", F.col("least").alias("kept_id"))
    leaders, order = 1, Window.partitionBy("component").orderBy("least", "content")
    while True:
        several = left.groupBy("component").agg(F.count("*").alias("n")).where("n > 1").select("component")
        first = left.join(shuffled(several), "component", "left_semi").withColumn("place", F.row_number().over(order)).where(F.col("place") <= leaders)
        first = staged(first.select("component", F.col("least").alias("kept_id"), F.col("content").alias("leading"), F.col("shingles").alias("held")), "leaders")
        if first.isEmpty():
            break
        own, held = F.size("shingles"), F.size("held")
        shared = F.size(F.array_intersect("shingles", "held"))
        # the first condition follows from the second and needs no intersection
        alike = (F.least(own, held) >= similarity * F.greatest(own, held)) & (shared >= similarity * (own + held - shared))
        later = F.struct("least", "content") > F.struct("kept_id", "leading")
        pairs = staged(left.join(counted(first, items="held"), "component").where(later & alike).select("content", "leading", "kept_id"), "alike")
        stay = first.select("leading").join(shuffled(pairs.select(F.col("content").alias("leading"))), "leading", "left_anti")
        go = staged(pairs.join(shuffled(stay), "leading").groupBy("content").agg(F.min("kept_id").alias("kept_id")), "gone")
        gone = gone.unionByName(go)
        decided = go.select("content").union(stay.select("leading"))
        before, left = left, staged(left.join(shuffled(decided), "content", "left_anti"), "open")
        released(before, first, pairs)
        leaders = min(4 * leaders, MOST_LEADERS)
    return gone, prints, nodes


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = KEEP_DISTANCE) -> DataFrame:
    """The documents that stay of each group of near copies (:func:`copied`), with all their columns.

    Rows that share an id are one document and stay or go together. A row without an id always stays. Null, empty and blank texts are
    equal. An empty table gives an empty result. Other columns are not looked at, whatever their names.
    """
    gone, prints, nodes = copied(docs, id_col, text_col, distance=distance)
    smaller = nodes.select("content", "least").join(shuffled(gone), "content", "left")
    goes = prints.join(shuffled(smaller), "content").where(F.col("kept_id").isNotNull() | (F.col("doc_id") != F.col("least")))
    goes = staged(goes.select(F.col("doc_id").alias("gone_id")).distinct(), "gone")
    released(prints, nodes)
    return _without(docs, id_col, goes)


def _without(docs: DataFrame, id_col: str, goes: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """Rows whose id is not a ``gone_id``. Rows are not shuffled unless very many stay whose ids pass the sieve of those that go."""
    if goes.count() <= most:
        return docs.join(F.broadcast(goes), docs[id_col] == goes["gone_id"], "left_anti")
    sifted = sieve(goes, "gone_id")
    ids = docs.select(F.col(id_col).alias("stays"))
    stays = ids.join(sifted, in_sieve(ids["stays"], sifted), "left_semi").distinct()
    stays = counted(staged(stays.join(shuffled(goes), stays["stays"] == goes["gone_id"], "left_anti"), "stays"), most)
    passed = docs.join(sifted, in_sieve(docs[id_col], sifted), "left_semi")
    outside = docs.join(sifted, in_sieve(docs[id_col], sifted), "left_anti")
    return outside.union(passed.join(stays, passed[id_col] == stays["stays"], "left_semi"))
