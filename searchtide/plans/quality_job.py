"""The quality job: recommend rules unless there are some, evaluate them, store the results, and say whether to go on."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.operators import quality
from searchtide.schemas import DQ_RESULTS
from searchtide.sources import folders, quality_results

SUMMARY = "run_id string, recommended boolean, rules bigint, passed bigint, score double, proceed boolean, message string"


def stored_rules(spark: SparkSession, path: str) -> list[quality.Rule]:
    """The rule set kept below ``path``; empty if there is none."""
    if not folders.exists(spark, path):
        return []
    # one row per rule
    rows = spark.read.schema(quality.RULES).parquet(path).orderBy("position").collect()
    return [quality.Rule(r["kind"], r["column"], tuple(r["values"]), r["threshold"], r["limit"]) for r in rows]


def store_rules(spark: SparkSession, rules: Sequence[quality.Rule], path: str) -> None:
    quality.rules_table(spark, rules).coalesce(1).write.mode("overwrite").parquet(path)


def run_quality(
    curated: DataFrame,
    rules_path: str,
    results_path: str,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    run_id: str = "unknown",
    min_score: float | None = None,
    fallback: Sequence[quality.Rule] = (),
    table: str = "curated",
) -> DataFrame:
    """One row saying what was evaluated and whether the jobs after it may run.

    Rules are recommended only where none are stored. If that fails, the evaluation runs all the same, on the
    ``fallback`` rules, and the ``message`` says why. A failing evaluation is a failure of the job.
    """
    spark = curated.sparkSession
    rules, recommended, message = stored_rules(spark, rules_path), False, None
    if not rules:
        try:
            rules = quality.recommend(curated, columns, keys)
            store_rules(spark, rules, rules_path)
            recommended = True
        except Exception as error:  # noqa: BLE001  told in the summary
            rules, message = list(fallback), f"{type(error).__name__}: {str(error).strip().splitlines()[0] if str(error).strip() else ''}"
    started = datetime.now(timezone.utc)
    # one row per rule, measured before the time of completion is known
    measured = quality.evaluate(curated, rules, table=table, run_id=run_id, started=_text(started), run_date=started.date()).collect() if rules else []
    results = spark.createDataFrame(measured, DQ_RESULTS).withColumn("evaluation_completed_on", F.lit(_text(datetime.now(timezone.utc))))
    results = results.select(*DQ_RESULTS.names)
    quality_results.write_results(results, results_path)
    verdict = quality.gate(results, min_score).first()
    return spark.createDataFrame([(run_id, recommended, verdict["rules"], verdict["passed"], verdict["score"], verdict["proceed"], message)], SUMMARY)


def _text(moment: datetime) -> str:
    return moment.strftime("%Y-%m-%dT%H:%M:%S.%fZ")
