"""Language of a text by a string kernel.

The kernel of two texts is the number of byte n-grams (all lengths of ``GRAMS``) that both contain, each counted once,
divided by the geometric mean of the texts' own numbers. N-grams are hashed to ``BUCKETS``. Of each language a bounded number
of training texts is taken; the first of them are landmarks. By Nyström's method a text becomes its kernel values with the landmarks
times the inverse square root of the landmarks' kernel matrix, and one ridge regression per language against the
rest is solved on that. A batch of texts is scored by two matrix products.

Defined results: a text that is null or has no letter gets ``und`` and score 0, as does every text if nothing was
learned. Rows without a language are not learned from. Repeated rows are predicted one by one; repeated training rows
count once per id. Only the named columns are looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.llm import texts as tx

GRAMS = (2, 3)
BUCKETS = 1 << 14
#: training texts of each language, and how many of these are landmarks
TEXTS_OF_EACH = 160
LANDMARKS_OF_EACH = 32
RIDGE = 1e-2
#: texts in one matrix product
ROWS = 128
UNKNOWN = "und"


class Model(NamedTuple):
    languages: list[str]
    landmarks: np.ndarray
    weights: np.ndarray
    shift: np.ndarray


def presence(texts: pa.Array) -> np.ndarray:
    """One row per text with 1 for each n-gram bucket that occurs in it."""
    data, offsets = tx.encoded(texts)
    data = tx.lowered(data)
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    out = np.zeros((len(offsets) - 1, BUCKETS), np.float32)
    flat = out.ravel()
    for n in GRAMS:
        inside = tx.whole(owner, n)
        bucket = (tx.rolled(data, n) + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - 14)
        flat[(owner[: len(inside)] * BUCKETS + bucket.astype(np.int64))[inside]] = 1
    return out


def _kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    size = np.sqrt(np.maximum(1, rows.sum(axis=1)))
    own = np.sqrt(np.maximum(1, landmarks.sum(axis=1)))
    return (rows @ landmarks.T) / size[:, None] / own[None, :]


def trained(languages: list[str], labels: np.ndarray, rows: np.ndarray, landmark: np.ndarray) -> Model:
    """Landmarks are the rows so marked; labels are places in ``languages``."""
    landmarks = rows[landmark]
    values, vectors = np.linalg.eigh(_kernel(landmarks, landmarks).astype(np.float64))
    kept = values > 1e-6 * max(values.max(), 1e-12)
    root = vectors[:, kept] / np.sqrt(values[kept])
    features = _kernel(rows, landmarks) @ root
    mean = features.mean(axis=0)
    centred = features - mean
    wanted = np.where(labels[:, None] == np.arange(len(languages))[None, :], 1.0, -1.0)
    level = wanted.mean(axis=0)
    solved = np.linalg.solve(centred.T @ centred + RIDGE * np.eye(centred.shape[1]), centred.T @ (wanted - level))
    return Model(languages, landmarks, (root @ solved).astype(np.float32), (level - mean @ solved).astype(np.float32))


def held_out(key: Column, parts: int, part: int) -> Column:
    """Whether the CRC-32 of the id as text leaves the given remainder."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % parts == part


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        texts_of_each: int = TEXTS_OF_EACH, landmarks_of_each: int = LANDMARKS_OF_EACH) -> Model | None:
    """Learn from at most ``texts_of_each`` rows per language, in the order of a hash of the id."""
    known = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).where("id is not null and lang is not null").groupBy("id").agg(F.min("lang").alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id")
    chosen = known.withColumn("place", F.row_number().over(order)).where(F.col("place") <= texts_of_each)
    kind = docs.schema[id_col].dataType.simpleString()
    listed = docs.sparkSession.createDataFrame([tuple(r) for r in chosen.collect()], f"id {kind}, lang string, place int")
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}")).select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(listed), "id")

    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                bits = np.packbits(presence(part.column("text")).astype(bool), axis=1)
                yield pa.RecordBatch.from_arrays([part.column("lang"), part.column("place"), pa.array([b.tobytes() for b in bits], pa.binary())], ["lang", "place", "bits"])

    found = rows.mapInArrow(featured, "lang string, place int, bits binary").dropDuplicates(["lang", "place"]).toArrow().sort_by([("lang", "ascending"), ("place", "ascending")])
    if found.num_rows == 0:
        return None
    names = found["lang"].to_pylist()
    languages = sorted(set(names))
    bits = np.unpackbits(np.frombuffer(b"".join(found["bits"].to_pylist()), np.uint8).reshape(len(names), -1), axis=1).astype(np.float32)
    place = np.array([languages.index(n) for n in names])
    rank = np.arange(len(names)) - np.searchsorted(place, place)
    return trained(languages, place, bits, rank < landmarks_of_each)


def predicted(texts: pa.Array, model: Model | None) -> tuple[list[str], np.ndarray]:
    """Language and score (0 to 1, a softmax over the regressions) of each text."""
    has_letter = pc.match_substring_regex(tx.filled(texts), r"\p{L}").to_numpy(zero_copy_only=False)
    if model is None:
        return [UNKNOWN] * len(texts), np.zeros(len(texts))
    margins = _kernel(presence(texts), model.landmarks) @ model.weights + model.shift
    best = margins.argmax(axis=1)
    share = np.exp(4.0 * (margins - margins.max(axis=1, keepdims=True)).astype(np.float64))
    score = 1 / share.sum(axis=1)
    return [model.languages[b] if ok else UNKNOWN for b, ok in zip(best, has_letter)], np.where(has_letter, score, 0.0)


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``lang_pred`` and ``score`` of every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in tx.chunks(batch, "text"):
                for start in range(0, chunk.num_rows, ROWS):
                    part = chunk.slice(start, ROWS)
                    names, score = predicted(part.column("text"), sent.value)
                    yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(names), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return rows.mapInArrow(scored, f"doc_id {docs.schema[id_col].dataType.simpleString()}, lang_pred string, score double")
