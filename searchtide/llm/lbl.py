"""Scoring texts with a log-bilinear language model.

Tokens are lower-case words and one end per text. The most frequent words and the end are classes of
their own; every other word belongs to the class of its last three bytes. The model predicts a token's class from the
two before it: a class vector is predicted as the weighted sum of the context's vectors, and its
product with each class vector plus a bias gives that class's log score. The word within its class follows smoothed counts.

Counts are over all training tokens. The vectors are trained with noise-contrastive estimation in numpy. The texts, as sequences of
classes, are dealt into *shards* of about ``SHARD_TOKENS`` tokens by a hash of the text's id and content, and lie in a shard in the order of that hash. In
each of ``ROUNDS`` rounds every shard is passed over from the same starting point, and what the shards learned is averaged by their numbers of
positions. The rounds share the positions out among themselves, so that each position of each text is trained on once. So the model
depends on the texts alone: not on how the input is cut, on the number of tasks, or on a task that runs again; and as a shard has one
size, more data bring more shards, not weaker ones. What is trained on grows with the input; the parameters do not.

Scores of a batch are lookups in tables of products: with E1 and E2 the exponentials of the scores that each of the two context
classes gives each class, the normaliser of every context pair is one entry of the product of E1 and E2.

Counts of the commonest ``HEAD`` words are sent to all tasks. Other words are joined with their counts by shuffle,
so the vocabulary may have any size.

Defined results: a null text is an empty text, one end. Without training texts all counts are 0, each
token has the probability of an unseen one, and so has the model's. Repeated rows are scored one by one (each counts in training);
an empty table gives an empty result. Only the named columns are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.llm import texts as tx
from searchtide.llm.shared import staged

#: classes of one word, and classes of word endings
SINGLE = 512
ENDINGS = 509
CLASSES = SINGLE + ENDINGS
DIMENSIONS = 24
ROUNDS = 2
#: training tokens of a shard (4 MB), and of the pieces that very long texts are cut into
SHARD_TOKENS = 2_000_000
PIECE_TOKENS = 65_536
#: most tasks that shards are dealt to; beyond that a task has several
SHARD_TASKS = 20_000
BATCH = 512
NOISE = 128
RATE = 0.1
#: words whose counts are sent to every task, and the longest of them in bytes
HEAD = 1 << 19
HEAD_BYTES = 64
COUNT_BYTES = 8 * 1024 * 1024
#: the end of a text; no word is empty
END = ""


class Counts(NamedTuple):
    """Totals, single-word classes, commonest words with counts, and tokens and distinct words of each class."""

    tokens: int
    distinct: int
    single: pa.Array
    head: pa.Array
    head_counts: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray


class Vectors(NamedTuple):
    context: np.ndarray
    target: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def _ending(token: Column) -> Column:
    """Class of a word by its last three bytes read as a number."""
    return F.conv(F.hex(F.substring(F.encode(token, "utf-8"), -3, 3)), 16, 10).cast("long") % ENDINGS


def _endings(strings: pa.Array) -> np.ndarray:
    data, offsets = tx.encoded(strings)
    value = np.zeros(len(offsets) - 1, np.int64)
    for k in (3, 2, 1):
        at = offsets[1:] - k
        value = value * 256 + np.where(at >= offsets[:-1], data[np.maximum(at, 0)] if len(data) else 0, 0)
    return value % ENDINGS


def token_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``token`` and ``n`` over all texts; staged."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text", COUNT_BYTES):
                data, offsets = tx.encoded(part.column("text"))
                found = pc.value_counts(tx.words_of(tx.lowered(data), offsets).strings)
                token = pa.concat_arrays([found.field("values").cast(pa.string()), pa.array([END])])
                yield pa.RecordBatch.from_arrays([token, pa.concat_arrays([found.field("counts"), pa.array([part.num_rows], pa.int64())])], ["token", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(counted, "token string, n long")
    return staged(rows.groupBy("token").agg(F.sum("n").alias("n")), "counts")


def _level(n: Column) -> Column:
    """Logarithmic steps of a count; there are a few hundred at most."""
    return F.floor(F.log2(n.cast("double")) * 8).cast("int")


def _is_head(level: int) -> Column:
    return (_level(F.col("n")) >= level) & (F.octet_length("token") <= HEAD_BYTES)


def summed(counts: DataFrame) -> tuple[Counts, int]:
    """What tasks need of the counts, all of bounded size; and the level from which words belong to the head."""
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("distinct")).first()
    single = [r["token"] for r in counts.orderBy(F.desc("n"), "token").limit(SINGLE).collect()]
    single = [END, *[t for t in single if t != END]][:SINGLE]
    levels = counts.where(F.octet_length("token") <= HEAD_BYTES).groupBy(_level(F.col("n")).alias("level")).count().collect()
    level, room = 1 << 30, HEAD
    for r in sorted(levels, key=lambda r: -r["level"]):
        room -= r["count"]
        if room < 0:
            break
        level = r["level"]
    chosen = counts.where(_is_head(level) | F.col("token").isin(single)).toArrow()
    head = chosen["token"].combine_chunks().cast(pa.large_string())
    own = pc.index_in(pa.array(single, pa.large_string()), head).to_numpy(zero_copy_only=False)
    head_counts = chosen["n"].to_numpy().astype(np.int64)
    tokens, words = np.zeros(CLASSES), np.zeros(CLASSES)
    for k, at in enumerate(own):
        if at == at and at is not None:
            tokens[k], words[k] = head_counts[int(at)], 1
    rest = counts.where(~F.col("token").isin(single)).groupBy(_ending(F.col("token")).alias("ending")).agg(F.sum("n").alias("n"), F.count("*").alias("words"))
    for r in rest.collect():
        tokens[SINGLE + r["ending"]], words[SINGLE + r["ending"]] = r["n"], r["words"]
    return Counts(total["tokens"], total["distinct"], pa.array(single, pa.large_string()), head, head_counts, tokens, words), level


def _classes(strings: pa.Array, counts: Counts) -> np.ndarray:
    single = pc.fill_null(pc.index_in(strings, counts.single), -1).to_numpy()
    return np.where(single >= 0, single, SINGLE + _endings(strings))


def _sequence(classes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two ends, the classes of a text's words and one end, for all texts; and the places of the targets."""
    texts = len(first) - 1
    owner = tx.owners(first)
    out = np.zeros(len(classes) + 3 * texts, np.int64)
    out[np.arange(len(classes)) + 3 * owner + 2] = classes
    target = np.ones(len(out), bool)
    begin = first[:-1] + 3 * np.arange(texts)
    target[begin] = target[begin + 1] = False
    return out, np.flatnonzero(target)


def start(counts: Counts) -> Vectors:
    rng = np.random.default_rng(7)
    share = (counts.class_tokens + 0.5) / (counts.class_tokens + 0.5).sum()
    return Vectors(rng.normal(0, 0.3, (CLASSES, DIMENSIONS)), np.zeros((CLASSES, DIMENSIONS)), np.ones((2, DIMENSIONS)), np.log(share))


def _scattered(at: np.ndarray, grad: np.ndarray) -> np.ndarray:
    place = (at[:, None] * DIMENSIONS + np.arange(DIMENSIONS)).ravel()
    return np.bincount(place, grad.ravel(), CLASSES * DIMENSIONS).reshape(CLASSES, DIMENSIONS).astype(np.float32)


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def trained(vectors: Vectors, one: np.ndarray, two: np.ndarray, target: np.ndarray, share: np.ndarray) -> Vectors:
    """One pass of noise-contrastive estimation over positions: ``one`` and ``two`` are the classes one and two before.

    In single precision: the steps are far coarser than its rounding, and it takes half the time.
    """
    r, q, c, b = (x.astype(np.float32) for x in vectors)
    squares = [np.full_like(x, 1e-2) for x in (r, q, c, b)]
    rng = np.random.default_rng(len(target))
    cumulated = np.cumsum(share)
    offset = np.log(NOISE * share).astype(np.float32)
    rate = np.float32(RATE)
    for k in range(0, len(target), BATCH):
        h1, h2, w = one[k : k + BATCH], two[k : k + BATCH], target[k : k + BATCH]
        noise = np.minimum(np.searchsorted(cumulated, rng.random(NOISE)), CLASSES - 1)
        r1, r2, wanted, against = r[h1], r[h2], q[w], q[noise]
        predicted = c[0] * r1 + c[1] * r2
        # probability of each to be data and not noise
        true = _logistic(b[w] - offset[w] + np.einsum("ij,ij->i", predicted, wanted))
        false = predicted @ against.T
        false += b[noise] - offset[noise]
        down = _logistic(false)
        down /= len(w)
        up = (1 - true) / np.float32(len(w))
        grad = up[:, None] * wanted - down @ against
        both = np.concatenate([h1, h2])
        on_target = np.concatenate([up[:, None] * predicted, -(down.T @ predicted)])
        steps = (
            _scattered(both, np.concatenate([grad * c[0], grad * c[1]])),
            _scattered(np.concatenate([w, noise]), on_target),
            np.stack([np.einsum("ij,ij->j", grad, r1), np.einsum("ij,ij->j", grad, r2)]),
            (np.bincount(w, up, CLASSES) - np.bincount(noise, down.sum(axis=0), CLASSES)).astype(np.float32),
        )
        for x, g, s in zip((r, q, c, b), steps, squares):
            s += g * g
            g *= rate
            g /= np.sqrt(s)
            x += g
    return Vectors(r, q, c, b)


def _flat(vectors: Vectors) -> np.ndarray:
    return np.concatenate([x.ravel() for x in vectors]).astype(np.float64)


def _shaped(values: np.ndarray) -> Vectors:
    cuts = np.cumsum([CLASSES * DIMENSIONS, CLASSES * DIMENSIONS, 2 * DIMENSIONS])
    r, q, c, b = np.split(values, cuts)
    return Vectors(r.reshape(CLASSES, DIMENSIONS), q.reshape(CLASSES, DIMENSIONS), c.reshape(2, DIMENSIONS), b)


def shards(docs: DataFrame, counts: Counts, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per shard: ``shard``, ``lines`` (16-bit classes of its pieces, each with the two classes before it) and their ``lengths``; staged."""
    small = Counts(counts.tokens, counts.distinct, counts.single, counts.head[:0], counts.head_counts[:0], counts.class_tokens, counts.class_words)
    sent = docs.sparkSession.sparkContext.broadcast(small)

    def sequenced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                data, offsets = tx.encoded(part.column("text"))
                words = tx.words_of(tx.lowered(data), offsets)
                ids, vocabulary = tx.numbered(words.strings)
                line, _ = _sequence(_classes(vocabulary, sent.value)[ids] if len(ids) else ids, words.first)
                line = line.astype(np.int16)
                begin = words.first + 3 * np.arange(len(words.first))
                owner, piece, lines = [], [], []
                for i, (f, t) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
                    for k, at in enumerate(range(f, t - 2, PIECE_TOKENS)):
                        owner.append(i)
                        piece.append(k)
                        lines.append(line[at : min(t, at + PIECE_TOKENS + 2)].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(owner, pa.int64())), pa.array(piece, pa.int32()), pa.array(lines, pa.binary())], ["id", "piece", "line"])

    def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, lines = None, []

        def row() -> pa.RecordBatch:
            lengths = pa.array([[len(x) // 2 for x in lines]], pa.list_(pa.int32()))
            return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), pa.array([b"".join(lines)], pa.binary()), lengths], ["shard", "lines", "lengths"])

        for batch in batches:
            for key, line in zip(batch.column("shard").to_pylist(), batch.column("line").to_pylist()):
                if key != shard and lines:
                    yield row()
                    lines = []
                shard = key
                lines.append(line)
        if lines:
            yield row()

    number = max(1, -(-counts.tokens // SHARD_TOKENS))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    pieces = rows.mapInArrow(sequenced, f"id {docs.schema[id_col].dataType.simpleString()}, piece int, line binary")
    dealt = pieces.select(F.xxhash64("id", "piece", "line").alias("h"), "line").withColumn("shard", F.pmod("h", F.lit(number)))
    dealt = dealt.repartition(min(number, SHARD_TASKS), "shard").sortWithinPartitions("shard", "h", "line")
    return staged(dealt.select("shard", "line").mapInArrow(gathered, "shard long, lines binary, lengths array<int>"), "shards")


def _positions(line: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places of the targets: all but the first two classes of each piece."""
    target = np.ones(len(line), bool)
    begin = np.cumsum(lengths) - lengths
    target[begin] = target[begin + 1] = False
    return np.flatnonzero(target)


def fit(dealt: DataFrame, counts: Counts, rounds: int = ROUNDS) -> Vectors:
    """Train on every position of the shards, in one of the rounds; each round averages what the shards learned."""
    vectors = start(counts)
    spark = dealt.sparkSession
    share = (counts.class_tokens + 0.5) / (counts.class_tokens + 0.5).sum()
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(vectors)

        def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, total = 0, np.zeros(len(_flat(sent.value)))
            for batch in batches:
                for shard, lines, lengths in zip(*(batch.column(c) for c in ("shard", "lines", "lengths"))):
                    line = np.frombuffer(lines.as_buffer(), np.int16).astype(np.int64)
                    places = _positions(line, lengths.values.to_numpy())[turn::rounds]
                    places = places[np.random.default_rng([shard.as_py(), turn]).permutation(len(places))]
                    if len(places):
                        total += _flat(trained(sent.value, line[places - 1], line[places - 2], line[places], share)) * len(places)
                        seen += len(places)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total])], ["seen", "sums"])

        def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seen, total = 0, 0.0
            for batch in batches:
                seen += int(batch.column("seen").to_numpy().sum())
                total = total + batch.column("sums").flatten().to_numpy().reshape(batch.num_rows, -1).sum(axis=0)
            if seen:
                yield pa.RecordBatch.from_arrays([pa.array([seen], pa.int64()), pa.array([total])], ["seen", "sums"])

        # one array per task becomes one per shuffle partition, then one row per parameter
        few = int(spark.conf.get("spark.sql.shuffle.partitions"))
        by_task = dealt.mapInArrow(learned, "seen long, sums array<double>").repartition(few).mapInArrow(added, "seen long, sums array<double>")
        cells = by_task.select("seen", F.posexplode("sums").alias("cell", "value")).groupBy("cell").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen")).toArrow()
        if cells.num_rows:
            mean = np.zeros(len(_flat(vectors)))
            mean[cells["cell"].to_numpy()] = cells["value"].to_numpy() / cells["seen"].to_numpy()
            vectors = _shaped(mean)
    return vectors


def tables(vectors: Vectors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log scores of each class (columns) by the class one before and two before, and the log normaliser by both."""
    one = (vectors.context * vectors.weights[0]) @ vectors.target.T + vectors.bias
    two = (vectors.context * vectors.weights[1]) @ vectors.target.T
    top1, top2 = one.max(axis=1, keepdims=True), two.max(axis=1, keepdims=True)
    whole = np.log(np.exp(one - top1) @ np.exp(two - top2).T) + top1 + top2.T
    return one.astype(np.float32), two.astype(np.float32), whole.astype(np.float32)


class Head:
    """Places of the commonest words, by sorted hashes and compared as strings; made once, as it takes longer than to look up a batch."""

    def __init__(self, words: pa.Array):
        hashes = tx.strong_hashes(words, 0)
        self.words, self.order = words, np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]

    def places(self, strings: pa.Array) -> np.ndarray:
        """Where each string stands among the words; -1 if it does not."""
        out = np.full(len(strings), -1, np.int64)
        if not len(self.words):
            return out
        hashes = tx.strong_hashes(strings, 0)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        met = np.flatnonzero(self.hashes[at] == hashes)
        place = self.order[at[met]]
        same = pc.equal(self.words.take(pa.array(place)), strings.take(pa.array(met))).to_numpy(zero_copy_only=False).astype(bool)
        out[met[same]] = place[same]
        # equal hashes of different words
        for i in met[~same].tolist():
            out[i] = pc.index(self.words, strings[i]).as_py()
        return out


def _sums_of(strings: pa.Array, ids: np.ndarray, first: np.ndarray, counts: Counts, products: tuple, common: Head) -> dict[str, np.ndarray]:
    one, two, whole = products
    classes = _classes(strings, counts)
    place = common.places(strings)
    count = np.where(place >= 0, counts.head_counts[np.maximum(place, 0)] if len(counts.head_counts) else 0, -1)
    line, places = _sequence(classes[ids], first)
    h1, h2, w = line[places - 1], line[places - 2], line[places]
    logp = (one[h1, w].astype(np.float64) + two[h2, w] - whole[h1, h2]) / np.log(10)
    # a word within its class; single words are sure of theirs
    smooth = np.where(count >= 0, np.log10(np.maximum(count, 0) + 0.5), 0.0)
    inside = np.where(classes >= SINGLE, smooth - np.log10(counts.class_tokens + 0.5 * (counts.class_words + 1))[classes], 0.0)
    texts = len(first) - 1
    ends = first[1:] + np.arange(1, texts + 1)
    at_end = int(common.places(pa.array([END], pa.large_string()))[0])
    end = np.log10((counts.head_counts[at_end] if at_end >= 0 else 0) + 0.5)
    n = np.diff(first) + 1
    return {
        "n_tokens": n,
        "known": tx.sums((count > 0)[ids], first) + (at_end >= 0),
        "base": tx.sums(smooth[ids], first) + end - n * np.log10(counts.tokens + 0.5 * (counts.distinct + 1)),
        "model": tx.sums(logp, np.concatenate([[0], ends])) + tx.sums(inside[ids], first),
        "open": count < 0,
    }


def score(docs: DataFrame, training: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (smoothed word counts) and ``score`` of every row of ``docs``."""
    counted = token_counts(training, text_col)
    counts, level = summed(counted)
    products = tables(fit(shards(training, counts, id_col, text_col), counts))
    sent = docs.sparkSession.sparkContext.broadcast((counts, products))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = sent.value
        common = Head(known.head)
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                data, offsets = tx.encoded(part.column("text"))
                words = tx.words_of(tx.lowered(data), offsets)
                ids, vocabulary = tx.numbered(words.strings)
                out = _sums_of(vocabulary, ids, words.first, known, held, common)
                # words outside the head, each text's own ones once
                places = np.flatnonzero(out["open"][ids])
                keys, number = np.unique(tx.owners(words.first)[places] * (len(vocabulary) + 1) + ids[places], return_counts=True)
                bounds = np.searchsorted(keys, np.arange(part.num_rows + 1) * (len(vocabulary) + 1))
                token = vocabulary.take(pa.array(keys % (len(vocabulary) + 1))).cast(pa.string())
                rare = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.StructArray.from_arrays([token, pa.array(number)], ["token", "n"]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(out[c]) for c in ("n_tokens", "known", "base", "model")), rare],
                                                 ["doc_id", "n_tokens", "known", "base", "model", "rare"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        scored, f"doc_id {kind}, n_tokens long, known long, base double, model double, rare array<struct<token:string,n:long>>")
    rows = staged(rows.withColumn("row", F.monotonically_increasing_id()), "scores")
    rare = rows.select("row", F.explode("rare").alias("r")).select("row", "r.token", F.col("r.n").alias("times"))
    tail = counted.where(~_is_head(level))
    found = rare.join(tail, "token", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"))
    whole = rows.drop("rare").join(found, "row", "left")
    more = F.coalesce("more", F.lit(0.0))
    return whole.select("doc_id", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(counts.tokens).cast("long").alias("train_tokens"),
                        (F.col("base") + more).alias("base_score"), (F.col("model") + more).alias("score"))
