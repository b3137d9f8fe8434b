"""One refresh of the keyword table."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.operators import lut as ops
from searchtide.operators.classify import Patterns
from searchtide.sources import folders, lut_store
from searchtide.vocab import GENRE_PATTERNS

#: given the cleaned keywords of a batch, the text the classifier replied with
Classifier = Callable[[Sequence[str]], str]


@dataclass(frozen=True)
class OfflineClassifier:
    """Stand-in that needs no service: answers with the genre of the first pattern found."""

    patterns: Patterns = GENRE_PATTERNS

    def __call__(self, keywords: Sequence[str]) -> str:
        compiled = [(g, re.compile(rf"(?<!\w)(?:{p})(?!\w)", re.IGNORECASE)) for g, p in self.patterns]
        answers = {k: next((g for g, p in compiled if p.search(k)), "UNKNOWN") for k in keywords}
        return json.dumps(answers, ensure_ascii=False)


#: tasks that call the classifier side by side; a lost one repeats only its own batches
CALLERS = 32


def replies(batched: DataFrame, classifier: Classifier, callers: int = CALLERS) -> DataFrame:
    """``(batch_id, reply)``: one call per batch, in ``callers`` tasks; an exception leaves the reply empty."""
    def ask(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            answers = []
            for words in frame["words"]:
                try:
                    answers.append(classifier(list(words)))
                except Exception:  # noqa: BLE001  the batch is tried again in the next run
                    answers.append(None)
            yield pd.DataFrame({"batch_id": frame["batch_id"], "reply": answers})

    # a batch is at most a few dozen keywords
    in_order = F.array_sort(F.collect_list(F.struct("rank", "clean")))
    grouped = ops.sanitized(batched).groupBy("batch_id").agg(in_order["clean"].alias("words"))
    # an explicit number of tasks, which adaptive execution does not merge however small the batches are
    return grouped.repartition(callers).mapInPandas(ask, "batch_id int, reply string")


@dataclass(frozen=True)
class RefreshLimits:
    max_new: int = ops.MAX_NEW
    batch_size: int = ops.BATCH_SIZE
    callers: int = CALLERS


def refresh_lut(
    spark: SparkSession,
    curated: DataFrame,
    store: str,
    classifier: Classifier = OfflineClassifier(),
    limits: RefreshLimits = RefreshLimits(),
    work: str | None = None,
) -> DataFrame:
    """Ask about the most searched unknown keywords and save the new table; one summary row.

    Batches and replies are written down before they are used: the classifier is asked once, and
    what was asked stays the same however often later steps run. They lie in ``work``, by default a folder of this
    run's own, which is removed at the end. If another refresh saves in between, this one fails and saves nothing.
    """
    own = f"{store}/work-{uuid.uuid4().hex}" if work is None else None
    try:
        return _refreshed(spark, curated, store, classifier, limits, work or own)
    finally:
        if own:
            folders.remove(spark, own)


def _refreshed(spark: SparkSession, curated: DataFrame, store: str, classifier: Classifier, limits: RefreshLimits, work: str) -> DataFrame:
    base = lut_store.current(spark, store)
    lut, resolved = lut_store.load(spark, store, base)

    def written(table: DataFrame, name: str) -> DataFrame:
        table.write.mode("overwrite").parquet(f"{work}/{name}")
        return spark.read.schema(table.schema).parquet(f"{work}/{name}")

    asked = written(ops.candidates(ops.unknown_keywords(curated), lut, resolved), "candidates")
    skipped = asked.where(~ops.is_classifiable(F.col("keyword_norm"))).select(F.col("keyword_norm").alias("keyword"))
    batched = written(ops.batches(asked, limits.max_new, limits.batch_size), "batches")
    if batched.isEmpty():
        known = ops.merged_resolved(resolved, skipped)
        if not skipped.isEmpty():
            lut_store.save(spark, store, lut, known, base)
            lut, known = lut_store.load(spark, store)
        return _summary(spark, 0, lut, known, 0, "up-to-date")

    replied = written(replies(batched, classifier, limits.callers), "replies")
    parsed = ops.reply_entries(replied)
    # a batch whose keywords are all empty once cleaned was not asked about; it has no reply
    silent = batched.select("batch_id").distinct().join(replied.select("batch_id"), "batch_id", "left_anti")
    failed = parsed.where("failed").select("batch_id").unionByName(silent)
    verdicts = written(ops.applied_verdicts(ops.verdict_pairs(parsed), batched), "verdicts")
    new_lut = ops.merged_lut(lut, verdicts)
    new_resolved = ops.merged_resolved(resolved, skipped, ops.unresolved(batched, verdicts, failed))
    lut_store.save(spark, store, new_lut, new_resolved, base)
    saved_lut, saved_resolved = lut_store.load(spark, store)
    return _summary(spark, verdicts.count(), saved_lut, saved_resolved, failed.count(), "refreshed")


def _summary(
    spark: SparkSession, classified: int, lut: DataFrame, resolved: DataFrame, errors: int, message: str
) -> DataFrame:
    return spark.createDataFrame(
        [(classified, lut.count(), resolved.count(), errors, message)],
        "classified bigint, lut_size bigint, resolved bigint, errors bigint, message string",
    )
