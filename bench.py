"""Times the jobs and reports on one scale factor and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads.
Each entry is the median of three runs after one warm-up, from plan building to the last row.
"""

from __future__ import annotations

import json
import os
import shutil
import statistics
import sys
import tempfile
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from searchtide.operators import lut as lut_ops, quality  # noqa: E402
from searchtide.plans import report_pack, reports, trending  # noqa: E402
from searchtide.plans.curation_job import run_curation  # noqa: E402
from searchtide.plans.lut_refresh import OfflineClassifier, refresh_lut  # noqa: E402
from searchtide.registry.settings import QUALITY_RULES, TREND  # noqa: E402
from searchtide.session import build_session  # noqa: E402
from searchtide.sources.curated import partition, read_curated  # noqa: E402
from searchtide.sources.raw import write_raw  # noqa: E402
from searchtide.sources.testtables import TEST_RULES, raw_events  # noqa: E402

RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    base = tempfile.mkdtemp(prefix="run-bench-")
    try:
        landing, target = f"{base}/landing", f"{base}/curated"
        write_raw(raw_events(spark, folder), landing)
        lineage = run_curation(spark, landing, target, rules=TEST_RULES, run_id="bench").first()
        rows = read_curated(spark, target)

        def finish(frame) -> None:
            frame.write.format("noop").mode("overwrite").save()

        jobs = {
            "curation_job": lambda: run_curation(
                spark, landing, f"{base}/{uuid.uuid4().hex}", rules=TEST_RULES, run_id="bench").collect(),
            "incremental_curation": lambda: run_curation(
                spark, landing, f"{base}/{uuid.uuid4().hex}", since="dt >= 2024-01-24", rules=TEST_RULES,
                run_id="bench").collect(),
            "report_pack": lambda: report_pack.report_pack(rows, f"{base}/pack", uuid.uuid4().hex),
            "trending": lambda: finish(trending.trending(rows, rules=TREND)[0]),
            "content_gaps": lambda: finish(reports.content_gaps(rows)),
            "totals": lambda: finish(reports.totals(rows)),
            "top_keywords": lambda: finish(reports.top_keywords(rows)),
            "platform": lambda: finish(reports.by_platform(rows)),
            "repeat_share": lambda: finish(reports.repeat_share(rows)),
            "hour_genre": lambda: finish(reports.hour_genre(rows)),
            "hour_matrix": lambda: finish(reports.hour_matrix(rows)),
            "window_caption": lambda: finish(reports.window_caption(rows)),
            "partition_lookup": lambda: finish(partition(rows, "2024-01-12", "PHIM_HAN").agg(F.count(F.lit(1)))),
            "keyword_rollup": lambda: finish(reports.keyword_rollup(rows)),
            "unknown_keywords": lambda: finish(lut_ops.unknown_keywords(rows)),
            "lut_refresh": lambda: refresh_lut(
                spark, rows, f"{base}/{uuid.uuid4().hex}", OfflineClassifier((("PHIM_HAN", "gizmo"),))).collect(),
            "quality_rules": lambda: finish(quality.evaluate(rows, QUALITY_RULES)),
        }
        times = {}
        for name, job in jobs.items():
            job()
            taken = []
            for _ in range(RUNS):
                started = time.perf_counter()
                job()
                taken.append(time.perf_counter() - started)
            times[name] = round(statistics.median(taken), 3)
        print(json.dumps({
            "metric": "sum of median job and report times", "value": round(sum(times.values()), 3), "unit": "sec",
            "queries": times, "sf": folder.rsplit("sf", 1)[-1], "raw_rows": lineage["raw_rows"],
            "curation_rows_per_sec": round(lineage["raw_rows"] / times["curation_job"]),
        }))
    finally:
        shutil.rmtree(base, ignore_errors=True)
        spark.stop()


if __name__ == "__main__":
    main()
