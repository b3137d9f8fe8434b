"""All reports of a refresh, written as one table each."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.plans import reports
from searchtide.plans.trending import TrendRules, TrendWindows, reference_day, trending
from searchtide.session import shared_folder

Section = Callable[[DataFrame, DataFrame], DataFrame]

#: section -> report over (cells, keywords): the two summaries every section is regrouped from
SECTIONS: dict[str, Section] = {
    "dt_window": lambda cells, keywords: reports.dt_window(cells),
    "totals": lambda cells, keywords: reports.totals(cells, by_keyword=keywords),
    "platform": lambda cells, keywords: reports.by_platform(cells),
    "genre": lambda cells, keywords: reports.by_genre(cells),
    "keywords": lambda cells, keywords: reports.top_keywords(keywords),
    "content_gaps": lambda cells, keywords: reports.content_gaps(keywords),
    "premium": lambda cells, keywords: reports.premium_share(cells),
    "repeat": lambda cells, keywords: reports.repeat_share(cells),
    "guest": lambda cells, keywords: reports.guest_share(cells),
    "hour_genre": lambda cells, keywords: reports.hour_genre(cells),
}


def summaries(curated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two groupings behind all sections.

    ``cells`` has a row per day, hour, platform and genre: its size does not depend on the number
    of searches. ``keywords`` has a row per keyword and genre.
    """
    cells = reports.tally(curated, "dt", "hour_of_day_vn", "platform_group", "derived_genre")
    keywords = reports.tally(curated, "keyword_norm", "derived_genre", measures=("searches", "abandoned"))
    return cells, keywords


def staged(table: DataFrame, name: str, run_id: str) -> DataFrame:
    """The table written to the shared folder and read back, so that many readers share one computation."""
    spark = table.sparkSession
    path = f"{shared_folder(spark)}/staged/{run_id}/{name}"
    table.write.mode("overwrite").parquet(path)
    return spark.read.schema(table.schema).parquet(path)


def report_pack(curated: DataFrame, out: str, run_id: str, workers: int = 4) -> dict[str, str | None]:
    """Write each section below ``out`` with the coverage caption on every row.

    Returns the error of each section, or none. A failing section does not stop the others.
    """
    cells, keywords = (staged(t, n, run_id) for t, n in zip(summaries(curated), ("cells", "keywords")))
    caption = reports.window_caption(cells).first()["label"]

    def write(name: str) -> str | None:
        try:
            section = SECTIONS[name](cells, keywords).withColumn("coverage", F.lit(caption))
            section.coalesce(1).write.mode("overwrite").parquet(f"{out}/section={name}")
        except Exception as error:  # noqa: BLE001  the error is reported, the other sections go on
            return _told(error)
        return None

    with ThreadPoolExecutor(workers) as pool:
        return dict(zip(SECTIONS, pool.map(write, SECTIONS)))


def refresh(
    curated: DataFrame, out: str, run_id: str, day: date | None = None, rules: TrendRules = TrendRules()
) -> DataFrame:
    """Trending report and report pack; one row saying how it went, with the ``messages`` of what failed (null: nothing).

    The trending section carries the days it compares and its mode as ``coverage``.
    """
    spark: SparkSession = curated.sparkSession
    day = day or reference_day(curated)
    failed: dict[str, str] = {}
    rows, mode = 0, "failed"
    try:
        report, mode = trending(curated, day, rules)
        report = report.withColumn("coverage", F.lit(TrendWindows.before(day, rules).caption(mode)))
        report.coalesce(1).write.mode("overwrite").parquet(f"{out}/section=trending")
        rows = spark.read.schema(report.schema).parquet(f"{out}/section=trending").count()
    except Exception as error:  # noqa: BLE001  told in the summary; the pack is made all the same
        failed["trending"] = _told(error)
    try:
        failed |= {name: error for name, error in report_pack(curated, out, run_id).items() if error is not None}
    except Exception as error:  # noqa: BLE001
        failed["report pack"] = _told(error)
    messages = "; ".join(f"{name}: {error}" for name, error in failed.items()) or None
    return spark.createDataFrame(
        [(day.isoformat(), mode, rows, len(failed), messages)], "dt string, mode string, trending_rows bigint, errors bigint, messages string")


def _told(error: Exception) -> str:
    """The error in one line."""
    text = str(error).strip()
    return f"{type(error).__name__}: {text.splitlines()[0] if text else ''}"
