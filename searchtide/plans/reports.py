"""Reports over the curated table.

Every count-like report is a regrouping of the same few sums, so each one accepts either curated
rows or a table already summed up by :func:`tally`. The report pack reads the curated table twice
(once per summary), not once per report.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.functions.shares import percent
from searchtide.functions.text import keyword_present
from searchtide.vocab import UNCLASSIFIED

#: what is summed for each group of searches; null flags count as 0
_FLAGS = {
    "abandoned": "is_search_abandoned",
    "premium": "has_premium",
    "repeated": "is_repeat_search",
    "signed_in": "user_is_authenticated",
}
MEASURES = ("searches", *_FLAGS)


def known_genre(column: str = "derived_genre") -> Column:
    return ~F.col(column).isin(*UNCLASSIFIED)


def tally(rows: DataFrame, *by: str | Column, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """Sums of ``measures`` per group. Takes curated rows, or an earlier tally to group it further."""
    if "searches" in rows.columns:
        sums = [F.sum(m).alias(m) for m in measures]
    else:
        sums = [F.count(F.lit(1)).alias(m) if m == "searches" else F.count_if(_FLAGS[m]).alias(m) for m in measures]
    return rows.groupBy(*by).agg(*sums)


def _share(part: str, whole: str = "searches") -> Column:
    return percent(F.col(part), F.col(whole))


def abandon_by(rows: DataFrame, *by: str) -> DataFrame:
    """Searches and abandon rate per group, largest group first."""
    sums = tally(rows, *by, measures=("searches", "abandoned"))
    return sums.select(*by, F.col("searches").alias("c"), _share("abandoned").alias("a")).orderBy(F.desc("c"), *by)


# --- coverage -------------------------------------------------------------------------------


def day_counts(rows: DataFrame) -> DataFrame:
    return tally(rows, "dt", measures=("searches",))


def dt_window(rows: DataFrame) -> DataFrame:
    """One row: first and last day, number of days, rows, and the list of days.

    Rows are counted per day first, so the list is built from one row per day.
    """
    return day_counts(rows).agg(
        F.min("dt").alias("min_dt"),
        F.max("dt").alias("max_dt"),
        F.count("dt").alias("n_days"),
        F.coalesce(F.sum("searches"), F.lit(0)).alias("total_rows"),
        F.array_join(F.array_sort(F.collect_list("dt")), ",").alias("dts"),
    )


def calendar(rows: DataFrame) -> DataFrame:
    """``(dt, searches)`` for every day from the first to the last; null searches on days without rows.

    Days that are no dates have no neighbours and appear as they are.
    """
    days = day_counts(rows)
    span = F.sequence(F.min("dt").try_cast("date"), F.max("dt").try_cast("date")).cast("array<string>")
    every = days.agg(span.alias("span")).select(F.explode("span").alias("dt"))
    return every.join(days, "dt", "full")


def missing_days(rows: DataFrame) -> DataFrame:
    """Days between the first and the last one that have no rows."""
    return calendar(rows).where(F.col("searches").isNull()).select("dt").orderBy("dt")


def window_caption(rows: DataFrame) -> DataFrame:
    """One row: the coverage sentence shown with each report."""
    present, absent = F.col("searches").isNotNull(), F.col("searches").isNull()
    window = calendar(rows).agg(
        F.min(F.when(present, F.col("dt"))).alias("min_dt"),
        F.max(F.when(present, F.col("dt"))).alias("max_dt"),
        F.count_if(present).alias("n_days"),
        F.coalesce(F.sum("searches"), F.lit(0)).alias("total_rows"),
        F.count_if(absent).alias("missing"),
        F.array_sort(F.collect_list(F.when(absent, F.col("dt")))).alias("missing_days"),
    )
    more = F.when(F.col("missing") > 3, F.format_string(" (+%d more)", F.col("missing") - 3)).otherwise("")
    named = F.concat(F.array_join(F.slice("missing_days", 1, 3), "; "), more)
    parts = F.concat_ws(
        " • ",
        F.concat("min_dt", F.lit(" → "), "max_dt"),
        F.format_string("%d days", "n_days"),
        F.when(F.col("missing") > 0, F.concat(F.format_string("%d missing (", "missing"), named, F.lit(")"))),
        F.concat(F.format_number("total_rows", 0), F.lit(" rows")),
    )
    label = F.when(F.col("n_days") == 0, "no data").otherwise(parts)
    return window.select(label.alias("label"), "min_dt", "max_dt", "n_days", "total_rows", "missing")


def latest_day(rows: DataFrame) -> DataFrame:
    return rows.agg(F.max("dt").alias("max_dt"))


# --- totals and mixes -----------------------------------------------------------------------


def totals(rows: DataFrame, approximate: bool = False, by_keyword: DataFrame | None = None) -> DataFrame:
    """Rows, distinct keywords (an empty keyword counts) and abandon rate of the whole table.

    Keywords are counted exactly from one row per keyword; ``approximate`` uses a sketch instead.
    """
    if approximate and by_keyword is None:
        distinct = F.approx_count_distinct("keyword_norm").alias("kw")
        sums = rows.agg(F.count(F.lit(1)).alias("searches"), F.count_if("is_search_abandoned").alias("abandoned"), distinct)
    else:
        per_keyword = tally(rows if by_keyword is None else by_keyword, "keyword_norm", measures=("searches", "abandoned"))
        sums = per_keyword.agg(
            F.coalesce(F.sum("searches"), F.lit(0)).alias("searches"),
            F.sum("abandoned").alias("abandoned"),
            F.count("keyword_norm").alias("kw"),
        )
    return sums.select(F.col("searches").alias("total"), "kw", _share("abandoned").alias("abandon"))


def by_platform(rows: DataFrame) -> DataFrame:
    return abandon_by(rows, "platform_group")


def by_genre(rows: DataFrame) -> DataFrame:
    return abandon_by(rows, "derived_genre")


def top_keywords(rows: DataFrame, limit: int = 20) -> DataFrame:
    return abandon_by(rows.where(keyword_present()), "keyword_norm", "derived_genre").limit(limit)


def top_known_keywords(rows: DataFrame, limit: int = 10) -> DataFrame:
    asked = rows.where(keyword_present() & known_genre())
    counted = tally(asked, "keyword_norm", "derived_genre", measures=("searches",))
    return counted.orderBy(F.desc("searches"), "keyword_norm", "derived_genre").limit(limit)


def by_hour(rows: DataFrame) -> DataFrame:
    counted = tally(rows.where(F.col("hour_of_day_vn").isNotNull()), "hour_of_day_vn", measures=("searches",))
    return counted.select(F.col("hour_of_day_vn").cast("string").alias("hour"), "searches").orderBy(
        F.col("hour").cast("int"))


def sign_in_mix(rows: DataFrame) -> DataFrame:
    return tally(rows, "user_is_authenticated", measures=("searches",))


# --- content --------------------------------------------------------------------------------


def content_gaps(rows: DataFrame, min_abandoned: int = 5, limit: int = 500) -> DataFrame:
    """Keywords of a known genre that users often give up on."""
    asked = rows.where(known_genre() & keyword_present())
    sums = tally(asked, "keyword_norm", "derived_genre", measures=("searches", "abandoned"))
    rated = sums.where(F.col("abandoned") >= min_abandoned).withColumn("abandon_rate_pct", _share("abandoned"))
    return rated.orderBy(F.desc("abandon_rate_pct"), F.desc("abandoned"), "keyword_norm", "derived_genre").limit(limit)


def _genre_share(rows: DataFrame, flag: str, count_name: str, share_name: str) -> DataFrame:
    sums = tally(rows, "derived_genre", measures=("searches", flag))
    return sums.select(
        "derived_genre",
        F.col("searches").alias("total_searches"),
        F.col(flag).alias(count_name),
        _share(flag).alias(share_name),
    ).orderBy(F.desc(share_name), "derived_genre")


def premium_share(rows: DataFrame) -> DataFrame:
    return _genre_share(rows, "premium", "premium_searches", "premium_share_pct")


def repeat_share(rows: DataFrame) -> DataFrame:
    return _genre_share(rows, "repeated", "repeat_searches", "repeat_pct")


def guest_share(rows: DataFrame) -> DataFrame:
    sums = tally(rows.where(known_genre()), "derived_genre", measures=("searches", "signed_in"))
    return sums.withColumn("guests", F.col("searches") - F.col("signed_in")).select(
        "derived_genre",
        F.col("searches").alias("total_searches"),
        F.col("guests").alias("guest_searches"),
        _share("guests").alias("guest_share_pct"),
    ).orderBy(F.desc("guest_share_pct"), "derived_genre")


def abandon_by_genre(rows: DataFrame) -> DataFrame:
    sums = tally(rows.where(known_genre()), "derived_genre", measures=("searches", "abandoned"))
    return sums.select(
        "derived_genre", F.col("searches").alias("total"), "abandoned", _share("abandoned").alias("abandon_pct"),
    ).orderBy(F.desc("total"), "derived_genre")


def premium_of_known(rows: DataFrame) -> DataFrame:
    sums = tally(rows.where(known_genre()), "derived_genre", measures=("searches", "premium"))
    return sums.select(
        "derived_genre", F.col("searches").alias("total"), _share("premium").alias("premium_pct"),
    ).orderBy(F.desc("premium_pct"), "derived_genre")


# --- hours ----------------------------------------------------------------------------------


def hour_genre(rows: DataFrame) -> DataFrame:
    """Searches per hour and genre with the share of the genre's searches (a few hundred rows)."""
    timed = rows.where(F.col("hour_of_day_vn").isNotNull())
    counted = tally(timed, "hour_of_day_vn", "derived_genre", measures=("searches",))
    genre_total = F.sum("searches").over(Window.partitionBy("derived_genre"))
    return counted.withColumn("genre_total", genre_total).select(
        "hour_of_day_vn", "derived_genre", "searches", _share("searches", "genre_total").alias("pct_of_genre"),
    ).orderBy("derived_genre", "hour_of_day_vn")


ALL_GENRES = "All genres"


def hour_matrix(rows: DataFrame) -> DataFrame:
    """One row per genre with 24 hourly counts, largest genre first, then a row for all genres."""
    columns = {
        f"h{hour:02d}": F.coalesce(F.sum(F.when(F.col("hour_of_day_vn") == hour, F.col("searches"))), F.lit(0))
        for hour in range(24)
    }
    per_hour = tally(rows, "derived_genre", "hour_of_day_vn", measures=("searches",))
    is_total = F.grouping("derived_genre")
    genres = per_hour.rollup("derived_genre").agg(
        *[count.alias(name) for name, count in columns.items()], F.sum("searches").alias("searches"),
        is_total.alias("is_total"))
    return genres.orderBy("is_total", F.desc("searches"), "derived_genre").select(
        F.when(F.col("is_total") == 1, ALL_GENRES).otherwise(F.col("derived_genre")).alias("derived_genre"), *columns)


# --- coverage of the classifier -------------------------------------------------------------


def classifier_coverage(rows: DataFrame) -> DataFrame:
    """Rows per genre and their share of all rows."""
    per_genre = tally(rows, "derived_genre", measures=("searches",))
    # one group, but it holds one row per genre
    whole = F.sum("searches").over(Window.partitionBy(F.lit(0)))
    return per_genre.withColumn("whole", whole).select(
        "derived_genre", F.col("searches").alias("rows"), _share("searches", "whole").alias("pct"),
    ).orderBy(F.desc("rows"), "derived_genre")


def genre_distribution(rows: DataFrame) -> DataFrame:
    """Classifier coverage with a final row for the total."""
    shares = classifier_coverage(rows)
    total = shares.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).select(
        F.lit("Total").alias("derived_genre"), "rows", F.when(F.col("rows") > 0, 100.0).otherwise(0.0).alias("pct"),
        F.lit(1).alias("last"))
    return (
        shares.withColumn("last", F.lit(0)).unionByName(total)
        .orderBy("last", F.desc("rows"), "derived_genre").drop("last")
    )


# --- stored rollup and filters --------------------------------------------------------------


def keyword_rollup(rows: DataFrame) -> DataFrame:
    """Searches and abandoned searches per keyword, genre and platform."""
    sums = tally(rows, "keyword_norm", "derived_genre", "platform_group", measures=("searches", "abandoned"))
    return sums.withColumnRenamed("searches", "search_count").withColumnRenamed("abandoned", "abandoned_count")


def merged_rollups(*rollups: DataFrame) -> DataFrame:
    """Rollups of separate days as one; the counts simply add up."""
    together = rollups[0]
    for other in rollups[1:]:
        together = together.unionByName(other)
    return together.groupBy("keyword_norm", "derived_genre", "platform_group").agg(
        F.sum("search_count").alias("search_count"), F.sum("abandoned_count").alias("abandoned_count"))


def rollup_as_tally(rollup: DataFrame) -> DataFrame:
    """A stored rollup in the shape the platform, genre and keyword reports read."""
    return rollup.withColumnRenamed("search_count", "searches").withColumnRenamed("abandoned_count", "abandoned")


def filter_report(report: DataFrame, text: str = "", genre: str = "") -> DataFrame:
    """Rows of a keyword report whose keyword contains ``text`` and whose genre is ``genre``; blank means any."""
    if text:
        report = report.where(F.contains("keyword_norm", F.lit(text.lower())))
    if genre:
        report = report.where(F.col("derived_genre") == genre)
    return report
