"""Quality rules: hashed n-gram logistic regression with calibrated probabilities.

A text is the relative frequencies of its hashed words, word pairs and character n-grams. A logistic
regression on these is trained with numpy, in a task, on a bounded sample of labelled rows, its margins are
turned into probabilities on rows left out of the training (a two-parameter logistic fit), and
texts are scored in Arrow batches against a fixed threshold. Simple counts of words, symbols,
repeated lines and repeated three-word windows come from the same pass.

Defined results: a null or empty text has no words, zero counts and is not kept. Rows without a
label, labels without a document and null labels are not learned from; of repeated labels of one document
the lowest counts. Without examples of both kinds the model keeps what the base rules keep. Repeated rows are
scored one by one. Other columns of the input are passed on untouched by ``keep_good``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from searchtide.llm import texts as tx
from searchtide.llm.shared import shuffled

BUCKETS = 1 << 14
#: labelled rows of each kind that the model is fitted on, at most
LABELLED_ROWS = 1500
#: lowest probability of good quality that is kept
THRESHOLD = 0.5
LEAST_WORDS = 50
CHARACTER_GRAMS = (3, 5)
_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


class Model(NamedTuple):
    """Weights by bucket, intercept, and slope and shift of the calibration."""

    weights: np.ndarray
    intercept: float
    slope: float
    shift: float


def _hashed(data: np.ndarray, offsets: np.ndarray, words: tx.Parts, ids: np.ndarray, vocabulary) -> list[tuple]:
    """(bucket of each feature, where each text's features begin, number in each text) by kind of feature."""
    name = tx.string_hashes(vocabulary)[ids]
    kinds = [(name, words.first)]
    owner = tx.owners(words.first)
    pair, inside = tx.rolled(name, 2), tx.whole(owner, 2)
    kinds.append((tx.mixed(pair[inside]), np.searchsorted(owner[:-1][inside] if len(owner) else owner, np.arange(len(offsets)))))
    characters, first = tx.characters(data, offsets)
    letters = tx.owners(first)
    for n in CHARACTER_GRAMS:
        gram, inside = tx.rolled(characters, n), tx.whole(letters, n)
        at = letters[: len(inside)][inside]
        kinds.append((tx.mixed(gram[inside] + np.uint64(n)), np.searchsorted(at, np.arange(len(offsets)))))
    return [((h & np.uint64(BUCKETS - 1)).astype(np.int32), first) for h, first in kinds]


def _margins(model: Model, features: list[tuple], texts: int) -> np.ndarray:
    total = np.full(texts, model.intercept)
    for bucket, first in features:
        total += tx.sums(model.weights[bucket], first) / np.maximum(1, np.diff(first))
    return total


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _counts(data: np.ndarray, offsets: np.ndarray, words: tx.Parts, ids: np.ndarray) -> dict[str, np.ndarray]:
    owner = tx.owners(words.first)
    blank = tx._BLANK[data]
    letters = ((data & 0xC0) != 0x80) & ~blank
    lines = tx.lines_of(data, offsets)
    line_ids, _ = tx.numbered(lines.strings)
    with_word = np.searchsorted(words.starts, lines.stops) > np.searchsorted(words.starts, lines.starts)
    line_owner = tx.owners(lines.first)[with_word]
    key = line_owner * (len(lines.strings) + 1) + line_ids[with_word]
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    repeated = np.zeros(len(ids), bool)
    if len(ids) >= 3:
        # numbers of pairs, then of triples: exact, no hashes
        _, pair = np.unique(ids[:-1] * (int(ids.max()) + 1) + ids[1:], return_inverse=True)
        triple = pair[:-1] * (int(ids.max()) + 1) + ids[2:]
        inside = np.flatnonzero(tx.whole(owner, 3))
        _, triple = np.unique(triple[inside], return_inverse=True)
        _, number, count = np.unique(owner[inside] * (len(ids) + 1) + triple, return_inverse=True, return_counts=True)
        found = inside[count[number] > 1]
        for k in range(3):
            repeated[found + k] = True
    return {
        "n_words": np.diff(words.first),
        "word_chars": tx.sums(letters, offsets),
        "n_symbols": tx.sums(_SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_owner[again], minlength=len(offsets) - 1),
        "n_repeat_words": tx.sums(repeated, words.first),
    }


def judged(texts: pa.Array, model: Model | None, threshold: float = THRESHOLD) -> dict[str, np.ndarray]:
    """Counts, probability of good quality and verdict of each text."""
    data, offsets = tx.encoded(texts)
    words = tx.words_of(data, offsets)
    ids, vocabulary = tx.numbered(words.strings)
    out = _counts(data, offsets, words, ids)
    out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > 50 * out["n_words"])
    if model is None:
        out["p_good"] = np.ones(len(offsets) - 1)
    else:
        margin = _margins(model, _hashed(data, offsets, words, ids, vocabulary), len(offsets) - 1)
        out["p_good"] = _logistic(model.slope * margin + model.shift)
    out["kept"] = ~out["base_failed"] & (out["p_good"] >= threshold)
    return out


def _known(labels: DataFrame, id_col: str, label_col: str) -> DataFrame:
    """``id`` and ``good`` of the labels that can be learned from."""
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("good"))
    return shuffled(known.where("id is not null and good in (0, 1)").groupBy("id").agg(F.min("good").alias("good")))


def _sample(docs: DataFrame, labels: DataFrame, id_col: str, label_col: str, most: int) -> list[tuple]:
    """At most ``most`` ids of each kind that have a label and a document, in the order of a hash of the id."""
    known = _known(labels, id_col, label_col).join(docs.select(F.col(id_col).alias("id")), "id", "left_semi")
    return [tuple(r) for good in (0, 1) for r in known.where(F.col("good") == good).orderBy(F.xxhash64("id"), "id").limit(most).collect()]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", rows_of_each: int = LABELLED_ROWS) -> Model | None:
    """Fit on at most ``rows_of_each`` labelled documents of each kind, every fourth held back for calibration.

    The calibration weighs both kinds by their numbers among all labelled documents.
    """
    chosen = _sample(docs, labels, id_col, label_col, rows_of_each)
    if len({good for _, good in chosen}) < 2:
        return None
    kind = docs.schema[id_col].dataType.simpleString()
    listed = docs.sparkSession.createDataFrame(chosen, f"id {kind}, good int")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(listed), "id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                data, offsets = tx.encoded(part.column("text"))
                words = tx.words_of(data, offsets)
                kinds = _hashed(data, offsets, words, *tx.numbered(words.strings))
                buckets, values = [], []
                for i in range(part.num_rows):
                    total = np.zeros(BUCKETS, np.float32)
                    for bucket, first in kinds:
                        own = bucket[first[i] : first[i + 1]]
                        total += np.bincount(own, minlength=BUCKETS) / np.float32(max(1, len(own)))
                    buckets.append(np.flatnonzero(total).astype(np.int16))
                    values.append(total[buckets[-1]])
                yield pa.RecordBatch.from_arrays(
                    [part.column("good"), pa.array(buckets, pa.list_(pa.int16())), pa.array(values, pa.list_(pa.float32())),
                     part.column("id").cast(pa.string())], ["good", "buckets", "values", "id"])

    def learned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, size, col, value = [], [], [], []
        for batch in batches:
            good.append(batch.column("good").to_numpy())
            size.append(batch.column("buckets").value_lengths().to_numpy())
            # copies of 6 bytes per feature, so that no batch is held; everything else is worked out block by block
            col.append(batch.column("buckets").flatten().to_numpy().copy())
            value.append(batch.column("values").flatten().to_numpy().copy())
        if len(set(np.concatenate(good or [[]]).tolist())) < 2:
            return
        first = np.concatenate([[0], np.cumsum(np.concatenate(size))])
        weights, intercept, margin, kind = _trained(first, np.concatenate(col), np.concatenate(value), np.concatenate(good).astype(float))
        yield pa.RecordBatch.from_arrays([pa.array([weights]), pa.array([intercept]), pa.array([margin]), pa.array([kind])],
                                         ["weights", "intercept", "margins", "kinds"])

    # the sample is trained on in one task; the driver gets the weights, and the margins to calibrate on
    found = rows.mapInArrow(featured, "good int, buckets array<smallint>, values array<float>, id string")
    gathered = found.repartition(1).sortWithinPartitions("id", "good").drop("id")
    trained = gathered.mapInArrow(learned, "weights array<double>, intercept double, margins array<double>, kinds array<double>").toArrow()
    if not trained.num_rows:
        return None
    weights, margin, kind = (trained[c].combine_chunks().flatten().to_numpy() for c in ("weights", "margins", "kinds"))
    every = docs.select(F.col(id_col).alias("id")).join(_known(labels, id_col, label_col), "id").groupBy("good").count().collect()
    slope, shift = _calibrated(margin, kind, {r["good"]: r["count"] for r in every})
    return Model(weights.astype(np.float32), trained["intercept"][0].as_py(), slope, shift)


#: rows whose features are worked on at a time while training
_BLOCK = 64


def _trained(first: np.ndarray, col: np.ndarray, value: np.ndarray, good: np.ndarray, steps: int = 120) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """Weights and intercept fitted to rows whose features are ``first[i]:first[i + 1]`` of ``col`` and ``value``; margins and kinds of the rows to calibrate on."""
    held = np.arange(len(good)) % 4 == 3
    if len(set(good[held])) < 2 or len(set(good[~held])) < 2:
        held = np.zeros(len(good), bool)
    weights, intercept = np.zeros(BUCKETS), 0.0
    # both kinds weigh the same in the fit; the calibration restores the shares among all labels
    weight = np.where(good == 1, 0.5 / max(1, (good[~held] == 1).sum()), 0.5 / max(1, (good[~held] == 0).sum())) * ~held
    blocks = [(k, min(k + _BLOCK, len(good))) for k in range(0, len(good), _BLOCK)]

    def margins(start: int, stop: int) -> np.ndarray:
        part = slice(first[start], first[stop])
        return tx.sums(value[part] * weights[col[part]], first[start : stop + 1] - first[start]) + intercept

    mean, square, b1, b2 = np.zeros(BUCKETS), np.zeros(BUCKETS), 0.0, 0.0
    for step in range(1, steps + 1):
        grad, shift = 1e-7 * weights, 0.0
        for start, stop in blocks:
            error = (_logistic(margins(start, stop)) - good[start:stop]) * weight[start:stop]
            part = slice(first[start], first[stop])
            grad += np.bincount(col[part], value[part] * np.repeat(error, np.diff(first[start : stop + 1])), minlength=BUCKETS)
            shift += error.sum()
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad**2
        weights -= 2.0 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.99**step)) + 1e-8)
        b1, b2 = 0.9 * b1 + 0.1 * shift, 0.99 * b2 + 0.01 * shift**2
        intercept -= 0.1 * (b1 / (1 - 0.9**step)) / (np.sqrt(b2 / (1 - 0.99**step)) + 1e-8)
    margin = np.concatenate([margins(start, stop) for start, stop in blocks])
    left = held if held.any() else np.ones(len(good), bool)
    return weights, float(intercept), margin[left], good[left]


def _calibrated(margin: np.ndarray, good: np.ndarray, totals: dict[int, int] | None = None) -> tuple[float, float]:
    """Slope and shift of the logistic curve through the margins, with softened targets, by Newton's method.

    With ``totals`` each kind has the weight of its number there, however many rows of it are given.
    """
    n1, n0 = (good == 1).sum(), (good == 0).sum()
    weight = np.ones(len(good))
    if totals:
        weight = np.where(good == 1, totals[1] / max(1, n1), totals[0] / max(1, n0))
        weight *= len(good) / weight.sum()
    target = np.where(good == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    scale = max(1e-6, float(np.abs(margin).mean()))
    x = np.column_stack([margin / scale, np.ones(len(margin))])
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = _logistic(x @ w)
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-4 * w)
        w -= np.clip(step, -2, 2)
    return float(w[0] / scale), float(w[1])


SCORES = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, p_good double")


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD) -> DataFrame:
    """Id, counts, verdict and probability of each row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)
    order = [x.split()[0] for x in SCORES.split(", ")]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "text"):
                out = judged(part.column("text"), sent.value, threshold)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(out[c]) for c in order)], ["doc_id", *order])

    return rows.mapInArrow(scored, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {SCORES}")


def keep_good(docs: DataFrame, model: Model | None, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose text is kept, with all their columns."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def filtered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, at):
                yield part.filter(pa.array(judged(part.column(at), sent.value, threshold)["kept"]))

    return docs.mapInArrow(filtered, docs.schema)
