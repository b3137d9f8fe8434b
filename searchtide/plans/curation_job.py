"""The batch job: raw folder in, curated table out, one lineage row back."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.operators.lineage import lineage_counts, with_alarm
from searchtide.plans.curate import CurationRules, prepared_events, usable_events
from searchtide.session import require_settings, sized
from searchtide.sources import bookmark, versions
from searchtide.sources.curated import commit_curated, day_part, read_curated
from searchtide.sources.raw import parse_since, raw_bytes, read_folders, read_raw


def run_curation(
    spark: SparkSession,
    source: str,
    target: str,
    since: str | None = None,
    lut: DataFrame | None = None,
    rules: CurationRules = CurationRules(),
    run_id: str = "unknown",
    quarantine: str | None = None,
    clear_days: bool = True,
    one_file_per_group: bool = False,
) -> DataFrame:
    """Curate the raw events of ``source`` into ``target``.

    ``since`` limits the day folders. ``quarantine`` receives rows from files outside any day
    folder; without it they stay in the table under an unnamed day. ``clear_days`` also removes
    genre folders that earlier runs left on the rewritten days, so that no event stays in two.

    The result is published as one version of the table when all of it is written
    (:func:`searchtide.sources.curated.commit_curated`). A run that meets a newer version of the same folders fails with
    ``Conflict`` and changes nothing.
    """
    first_day = parse_since(since)
    spark = require_settings(sized(spark, raw_bytes(spark, source, first_day)))
    everything = read_raw(spark, source, first_day)
    raw = everything
    if quarantine is not None:
        # a condition on the file path: only the stray files are read
        everything.where(F.col("dt") == "").write.mode("overwrite").parquet(quarantine)
        raw = everything.where(F.col("dt") != "")

    # known from the file footers
    raw_rows = raw.count()
    seen, usable, kept = Observation("raw"), Observation("usable"), Observation("kept")
    count = F.count(F.lit(1)).alias("rows")
    events = usable_events(raw, seen).observe(usable, count)
    prepared = prepared_events(events, lut, rules).observe(kept, count)
    commit_curated(prepared, target, run_id, rules, one_file_per_group, clear_days)
    days = None if first_day is None else F.col("dt") >= first_day.isoformat()
    counters = [_counter(o) for o in (seen, usable, kept)]
    written = read_curated(spark, target)
    total = raw_rows if everything is raw else everything.count()
    return _lineage(raw, raw_rows, total, counters, written if days is None else written.where(days), run_id)


def run_new_files(
    spark: SparkSession,
    source: str,
    target: str,
    lut: DataFrame | None = None,
    rules: CurationRules = CurationRules(),
    run_id: str = "unknown",
    reach_days: int = 1,
) -> DataFrame:
    """Curate what has changed below ``source`` since the last such run: no day limit is needed, a late file in an old day is found.

    The days with a new, changed or vanished file are curated again from all their files, with ``reach_days`` on both sides, which is
    how far apart the day folders of two copies of an event may be. The ledger of files changes in the same step as the rows. Files
    outside any day folder form the unnamed day. One row says what was done.
    """
    spark = require_settings(spark)
    base = versions.current(spark, target)
    files, known = bookmark.listed(spark, source), bookmark.curated_files(spark, target, base)
    new, gone = bookmark.changed(files, known)
    touched = bookmark.with_day(new.withColumn("is_new", F.lit(True)).unionByName(gone.withColumn("is_new", F.lit(False))))
    # one row per day
    dirty = touched.groupBy("day").agg(F.count_if("is_new").alias("new"), F.count_if(~F.col("is_new")).alias("gone")).collect()
    count, vanished = sum(d["new"] for d in dirty), sum(d["gone"] for d in dirty)
    rows = 0
    if dirty:
        rewritten = bookmark.days_around([d["day"] for d in dirty], reach_days)
        context = bookmark.days_around([d["day"] for d in dirty], 2 * reach_days)
        around = bookmark.with_day(files).where(F.col("day").isin(context))
        read = around.groupBy("folder").agg(F.sum("length").alias("bytes")).collect()
        spark = sized(spark, sum(r["bytes"] for r in read))
        events = read_folders(spark, [r["folder"] for r in read])
        prepared = prepared_events(usable_events(events), lut, rules).where(F.col("dt").isin([_iso(d) for d in rewritten]))
        version = commit_curated(
            prepared, target, run_id, rules, base=base, days=[_iso(d) for d in rewritten],
            also=lambda commit: bookmark.record(spark, base, commit, new, files, whole=vanished > 0))
        rows = versions.read(spark, target, T.StructType([]), version, [p for p in version.parts if p.split("/")[0] in {day_part(_iso(d)) for d in rewritten}]).count()
    return spark.createDataFrame(
        [(run_id, count, vanished, len(dirty), rows)], "run_id string, new_files bigint, vanished_files bigint, dirty_days bigint, output_rows bigint")


def _iso(day: str) -> str:
    return f"{day[:4]}-{day[4:6]}-{day[6:]}" if len(day) == 8 else day


def _counter(observation: Observation) -> int | None:
    """The count, or none where the counter went away together with an empty part of the plan."""
    try:
        return observation.get.get("rows")
    except Py4JJavaError as error:
        # what Spark says of a metric that its plan no longer has; anything else is a failure
        if "toPyRow" not in str(error):
            raise
        return None


def _lineage(
    raw: DataFrame, raw_rows: int, total: int, counters: list[int | None], written: DataFrame, run_id: str
) -> DataFrame:
    """Counts of the run.

    The counters ride along with the write and cost nothing, but a task that ran twice after a
    lost executor counts twice. The raw rows and, with a run id, the written rows are known
    exactly from the files; if a counter differs from them, the counts are worked out again.
    """
    _, post_year, post_dedup = counters
    output = post_dedup
    if run_id != "unknown":
        output = written.where(F.col("_pipeline_run_id") == run_id).count()
    if counters[0] != raw_rows or output != post_dedup:
        again = lineage_counts(raw).first()
        post_year, post_dedup = again["post_year_rows"], again["post_dedup_rows"]
        output = output if run_id != "unknown" else post_dedup
    counts = raw.sparkSession.createDataFrame(
        [(run_id, total, post_year, post_dedup, output)],
        "run_id string, raw_rows bigint, post_year_rows bigint, post_dedup_rows bigint, output_rows bigint")
    return with_alarm(counts)
