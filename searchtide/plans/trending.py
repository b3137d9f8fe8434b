"""Keywords searched much more often than some weeks ago."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions.shares import multiple
from searchtide.functions.text import keyword_present
from searchtide.plans.reports import latest_day


@dataclass(frozen=True)
class TrendRules:
    current_days: int = 7
    baseline_age: int = 35
    baseline_days: int = 7
    min_growth: float = 3.0
    min_volume: int = 10
    limit: int = 500


@dataclass(frozen=True)
class TrendWindows:
    """Half-open day ranges; the reference day itself belongs to neither."""

    current: tuple[date, date]
    baseline: tuple[date, date]

    @classmethod
    def before(cls, day: date, rules: TrendRules = TrendRules()) -> "TrendWindows":
        start = day - timedelta(days=rules.baseline_age)
        return cls(
            (day - timedelta(days=rules.current_days), day),
            (start, start + timedelta(days=rules.baseline_days)),
        )

    def caption(self, mode: str) -> str:
        """The days compared, both ends included, and how."""
        (a, b), (c, d) = self.current, self.baseline
        one = timedelta(days=1)
        return f"{a} → {b - one} vs {c} → {d - one} • {mode}"


def _within(days: tuple[date, date]) -> Column:
    return (F.col("dt") >= days[0].isoformat()) & (F.col("dt") < days[1].isoformat())


def _searches(rows: DataFrame, condition: Column) -> Column:
    """How many searches meet the condition, in rows of one search each or in sums."""
    if "searches" in rows.columns:
        return F.sum(F.when(condition, F.col("searches")).otherwise(0))
    return F.count_if(condition)


def reference_day(rows: DataFrame) -> date:
    newest = latest_day(rows).first()["max_dt"]
    if not newest:
        raise ValueError("the curated table has no rows, so there is no reference day")
    return date.fromisoformat(newest)


def has_baseline(rows: DataFrame, windows: TrendWindows) -> bool:
    return not rows.where(_within(windows.baseline) & keyword_present()).limit(1).isEmpty()


def growth(rows: DataFrame, windows: TrendWindows, rules: TrendRules = TrendRules()) -> DataFrame:
    """Keywords of the current window against the baseline window.

    Both windows are counted in one pass over their days; a keyword without baseline rows is new. Takes curated rows or a
    tally by day.
    """
    in_current, in_baseline = _within(windows.current), _within(windows.baseline)
    counted = (
        rows.where((in_current | in_baseline) & keyword_present())
        .groupBy("keyword_norm", "derived_genre")
        .agg(_searches(rows, in_current).alias("current_cnt"), _searches(rows, in_baseline).alias("baseline_cnt"))
    )
    current, baseline = F.col("current_cnt"), F.col("baseline_cnt")
    grown = F.try_divide(current.cast("double"), baseline.cast("double")) >= rules.min_growth
    # a window that is wholly inside the filter but not current yields a count of 0
    kept = counted.where((current > 0) & (current >= rules.min_volume) & ((baseline == 0) | grown))
    return _ranked(
        kept.withColumn("growth_multiplier", multiple(current, baseline))
        .withColumn("is_new_keyword", baseline == 0), rules.limit)


def volume(rows: DataFrame, windows: TrendWindows, rules: TrendRules = TrendRules()) -> DataFrame:
    """The same columns from the current window alone, for tables without a baseline."""
    counted = (
        rows.where(_within(windows.current) & keyword_present())
        .groupBy("keyword_norm", "derived_genre")
        .agg(_searches(rows, F.lit(True)).alias("current_cnt"))
        .where(F.col("current_cnt") >= rules.min_volume)
    )
    return _ranked(
        counted.withColumn("baseline_cnt", F.lit(0).cast("bigint"))
        .withColumn("growth_multiplier", F.lit(None).cast("double"))
        .withColumn("is_new_keyword", F.lit(True)), rules.limit)


def _ranked(report: DataFrame, limit: int) -> DataFrame:
    return report.orderBy(F.desc("current_cnt"), "keyword_norm", "derived_genre").limit(limit)


def trending(
    rows: DataFrame, day: date | None = None, rules: TrendRules = TrendRules()
) -> tuple[DataFrame, str]:
    """The trending report and the label of the mode it was made in."""
    windows = TrendWindows.before(day or reference_day(rows), rules)
    if has_baseline(rows, windows):
        return growth(rows, windows, rules), f"growth ≥ {rules.min_growth}x"
    return volume(rows, windows, rules), "fallback / volume-only"
