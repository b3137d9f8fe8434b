"""All jobs of a night in order: curate new files, check quality, then reports, rollup and keyword table.

    python -m searchtide.plans.nightly --raw /lake/raw --lake /lake/search --run-id 2024-01-27
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from searchtide.plans import report_pack, rollup
from searchtide.plans.curate import CurationRules
from searchtide.plans.curation_job import run_new_files
from searchtide.plans.lut_refresh import Classifier, OfflineClassifier, refresh_lut
from searchtide.plans.quality_job import run_quality
from searchtide.plans.trending import TrendRules
from searchtide.session import build_session
from searchtide.sources import lut_store
from searchtide.sources.curated import newest_day, read_curated

#: columns that rules are recommended for, and columns whose values should be unique
PROFILED = ("derived_genre", "platform_group", "network_type_norm", "subscription_count", "is_search_abandoned")
KEYS = ("event_id",)
STEPS = "step string, ok boolean, detail string"


def run_night(
    spark: SparkSession,
    raw: str,
    lake: str,
    run_id: str,
    rules: CurationRules = CurationRules(),
    trend: TrendRules = TrendRules(),
    classifier: Classifier = OfflineClassifier(),
    min_score: float | None = None,
    reach_days: int = 1,
    day: date | None = None,
    columns: Sequence[str] = PROFILED,
) -> DataFrame:
    """One row per step: whether it went well, and its summary or error.

    The tables lie below ``lake``: ``curated``, ``rules``, ``results``, ``rollup``, ``reports`` and ``lut``. Curation and
    evaluation must succeed, and the quality gate must be passed, for the rest to run; of the rest, one failing step does not stop the others.
    """
    steps: list[tuple[str, bool, str]] = []

    def step(name: str, run: Callable[[], str]) -> bool:
        try:
            steps.append((name, True, run()))
        except Exception as error:  # noqa: BLE001  told in the row of the step
            text = str(error).strip()
            steps.append((name, False, f"{type(error).__name__}: {text.splitlines()[0] if text else ''}"))
        return steps[-1][1]

    def row(frame: DataFrame) -> dict:
        return frame.first().asDict()

    table = f"{lake}/curated"

    def curation() -> str:
        lut, _ = lut_store.load(spark, f"{lake}/lut")
        return str(row(run_new_files(spark, raw, table, lut=lut, rules=rules, run_id=run_id, reach_days=reach_days)))

    def evaluation() -> str:
        found = row(run_quality(read_curated(spark, table), f"{lake}/rules", f"{lake}/results", columns, KEYS, run_id, min_score))
        passed.append(found["proceed"])
        return str(found)

    def refreshed() -> str:
        newest = day or newest_day(spark, table)
        found = row(report_pack.refresh(read_curated(spark, table), f"{lake}/reports/run={run_id}", run_id, newest, trend))
        if found["errors"]:
            raise RuntimeError(found["messages"])
        return str(found)

    passed: list[bool] = []
    if step("curation", curation) and step("quality", evaluation) and passed[-1]:
        step("rollup", lambda: ", ".join(rollup.refresh_rollup(spark, table, f"{lake}/rollup")) or "up to date")
        step("reports", refreshed)
        step("keyword table", lambda: str(row(refresh_lut(spark, read_curated(spark, table), f"{lake}/lut", classifier))))
    elif passed and not passed[-1]:
        steps.append(("gate", False, "the quality score is too low for the jobs after it"))
    return spark.createDataFrame(steps, STEPS)


def main(arguments: Sequence[str] | None = None) -> int:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("--raw", required=True)
    parser.add_argument("--lake", required=True)
    parser.add_argument("--run-id", required=True)
    parser.add_argument("--min-score", type=float)
    parser.add_argument("--reach-days", type=int, default=1)
    given = parser.parse_args(arguments)
    done = run_night(build_session("searchtide nightly"), given.raw, given.lake, given.run_id, min_score=given.min_score, reach_days=given.reach_days).collect()
    for step in done:
        print(f"{'ok    ' if step['ok'] else 'FAILED'} {step['step']}: {step['detail']}")
    return 0 if all(step["ok"] for step in done) else 1


if __name__ == "__main__":
    raise SystemExit(main())
