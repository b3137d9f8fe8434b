"""Reports: windows, trends, ties, totals."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from searchtide.plans import report_pack, reports, trending


def searches(spark, rows):
    """Rows of (dt, keyword, genre, abandoned)."""
    return spark.createDataFrame(
        rows, "dt string, keyword_norm string, derived_genre string, is_search_abandoned boolean")


def repeated(dt, keyword, n, genre="NHAC"):
    return [(dt, keyword, genre, False)] * n


DAY = date(2022, 7, 10)
RULES = trending.TrendRules()
CURRENT, BASELINE = "2022-07-05", "2022-06-06"


def test_windows_are_half_open():
    windows = trending.TrendWindows.before(DAY)
    assert windows.current == (date(2022, 7, 3), date(2022, 7, 10))
    assert windows.baseline == (date(2022, 6, 5), date(2022, 6, 12))


def test_growth(spark):
    rows = searches(spark, [
        *repeated(CURRENT, "new", 10), *repeated(CURRENT, "rare", 9),
        *repeated(CURRENT, "slow", 10), *repeated(BASELINE, "slow", 4),
        *repeated(CURRENT, "fast", 13), *repeated(BASELINE, "fast", 4),
        # 11/4 shows as 2.75 and 3 is 12/4: the limit is applied to the exact ratio
        *repeated(CURRENT, "exact", 12), *repeated(BASELINE, "exact", 4),
        *repeated("2022-07-10", "today", 50), *repeated("2022-07-02", "before", 50),
        *repeated(BASELINE, "gone", 50), *repeated(CURRENT, "", 50), *repeated(CURRENT, None, 50),
        # the same keyword with another genre has no baseline
        *repeated(CURRENT, "fast", 11, "ANIME"),
    ])
    report, mode = trending.trending(rows, DAY)
    assert mode == "growth ≥ 3.0x"
    assert [tuple(r) for r in report.collect()] == [
        ("fast", "NHAC", 13, 4, 3.25, False), ("exact", "NHAC", 12, 4, 3.0, False),
        ("fast", "ANIME", 11, 0, None, True), ("new", "NHAC", 10, 0, None, True)]
    assert trending.growth(rows, trending.TrendWindows.before(DAY), trending.TrendRules(limit=1)).count() == 1


def test_without_baseline_volume_counts(spark):
    rows = searches(spark, [*repeated(CURRENT, "a", 10), *repeated(CURRENT, "b", 9)])
    report, mode = trending.trending(rows, DAY)
    assert mode == "fallback / volume-only"
    assert [tuple(r) for r in report.collect()] == [("a", "NHAC", 10, 0, None, True)]


def test_reference_day(spark):
    assert trending.reference_day(searches(spark, repeated("2022-07-09", "a", 1))) == date(2022, 7, 9)
    with pytest.raises(ValueError):
        trending.reference_day(searches(spark, []))


@pytest.mark.parametrize("days,missing,label", [
    ([1, 2, 5], ["2022-06-03", "2022-06-04"], "2022-06-01 → 2022-06-05 • 3 days • 2 missing (2022-06-03; 2022-06-04) • 3 rows"),
    ([1, 7], ["2022-06-02", "2022-06-03", "2022-06-04", "2022-06-05", "2022-06-06"],
     "2022-06-01 → 2022-06-07 • 2 days • 5 missing (2022-06-02; 2022-06-03; 2022-06-04 (+2 more)) • 2 rows"),
    ([1], [], "2022-06-01 → 2022-06-01 • 1 days • 1 rows"),
    ([], [], "no data"),
])
def test_window_caption(spark, days, missing, label):
    rows = searches(spark, [(f"2022-06-0{d}", "a", "NHAC", None) for d in days])
    assert [r["dt"] for r in reports.missing_days(rows).collect()] == missing
    assert reports.window_caption(rows).first()["label"] == label


def test_content_gaps_order_and_limit(spark):
    rows = searches(spark, [
        *[("2022-06-01", "b", "NHAC", True)] * 5, *[("2022-06-01", "a", "NHAC", True)] * 5,
        *[("2022-06-01", "c", "NHAC", True)] * 4, *[("2022-06-01", "u", "UNKNOWN", True)] * 9,
        *[("2022-06-01", "d", "ANIME", True)] * 6, *[("2022-06-01", "d", "ANIME", None)] * 2])
    got = [tuple(r) for r in reports.content_gaps(rows).collect()]
    assert got == [("a", "NHAC", 5, 5, 100.0), ("b", "NHAC", 5, 5, 100.0), ("d", "ANIME", 8, 6, 75.0)]
    assert reports.content_gaps(rows, limit=1).count() == 1
    assert [r["keyword_norm"] for r in reports.filter_report(reports.content_gaps(rows), "D").collect()] == ["d"]
    assert reports.filter_report(reports.content_gaps(rows), "", "NHAC").count() == 2
    # a percent sign is a letter like any other
    assert reports.filter_report(reports.content_gaps(rows), "%").count() == 0


def test_totals_count_the_empty_keyword(spark):
    rows = searches(spark, [("2022-06-01", k, "NHAC", k == "a") for k in ["a", "a", "", None]])
    assert tuple(reports.totals(rows).first()) == (4, 2, 50.0)
    assert tuple(reports.totals(rows, approximate=True).first()) == (4, 2, 50.0)
    assert tuple(reports.totals(searches(spark, [])).first()) == (0, 0, None)


def test_sums_over_groups_equal_the_total(curated_rows):
    total = curated_rows.count()
    for report, column in [(reports.by_genre, "c"), (reports.by_platform, "c"), (reports.sign_in_mix, "searches"),
                           (reports.by_hour, "searches"), (reports.classifier_coverage, "rows")]:
        assert report(curated_rows).agg(F.sum(column)).first()[0] == total
    shares = reports.hour_genre(curated_rows).groupBy("derived_genre").agg(F.sum("pct_of_genre").alias("p")).collect()
    assert all(abs(r["p"] - 100) < 2 for r in shares)
    last = reports.hour_matrix(curated_rows).collect()[-1]
    assert last["derived_genre"] == reports.ALL_GENRES and sum(last[1:]) == total


def test_reports_from_summaries_equal_reports_from_rows(curated_rows):
    cells, keywords = report_pack.summaries(curated_rows)
    direct = {
        "dt_window": reports.dt_window, "totals": reports.totals, "platform": reports.by_platform,
        "genre": reports.by_genre, "keywords": reports.top_keywords, "content_gaps": reports.content_gaps,
        "premium": reports.premium_share, "repeat": reports.repeat_share, "guest": reports.guest_share,
        "hour_genre": reports.hour_genre,
    }
    assert set(direct) == set(report_pack.SECTIONS)
    for name, report in direct.items():
        assert report_pack.SECTIONS[name](cells, keywords).collect() == report(curated_rows).collect(), name


def test_rollups_add_up(curated_rows):
    early, late = (curated_rows.where(c) for c in (F.col("dt") < "2024-01-15", F.col("dt") >= "2024-01-15"))
    merged = reports.merged_rollups(reports.keyword_rollup(early), reports.keyword_rollup(late))
    assert sorted(map(str, merged.collect())) == sorted(map(str, reports.keyword_rollup(curated_rows).collect()))


def test_pack_goes_on_after_a_failing_section(spark, curated_rows, tmp_path, monkeypatch):
    monkeypatch.setitem(report_pack.SECTIONS, "premium", lambda cells, keywords: cells.select("no_such_column"))
    summary = report_pack.refresh(curated_rows, str(tmp_path), "failing", date(2024, 1, 30)).first()
    assert (summary["dt"], summary["errors"]) == ("2024-01-30", 1)
    assert summary["messages"].startswith("premium: AnalysisException") and "no_such_column" in summary["messages"]
    written = {p.name for p in tmp_path.iterdir()}
    assert "section=premium" not in written and len(written) == len(report_pack.SECTIONS)
    assert "•" in spark.read.parquet(f"{tmp_path}/section=genre").first()["coverage"]
    caption = trending.TrendWindows.before(date(2024, 1, 30)).caption(summary["mode"])
    assert caption.startswith("2024-01-23 → 2024-01-29 vs 2023-12-26 → 2024-01-01 • ")
    assert {r["coverage"] for r in spark.read.parquet(f"{tmp_path}/section=trending").collect()} <= {caption}
