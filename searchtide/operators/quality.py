"""Quality rules: recommend them from a profile, evaluate them, gate on the outcome."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from searchtide.functions.shares import half_up
from searchtide.schemas import DQ_RESULTS

#: a column with no more distinct values than this gets a rule listing them
MOST_LISTED = 20
#: share of the rows the values of a threshold rule must cover
COMMON_SHARE = 0.9


@dataclass(frozen=True)
class Rule:
    """One rule on one column.

    ``listed``: the values lie in ``values`` for at least ``threshold`` of the rows (null lies in no list).
    ``at_most``: no value exceeds ``limit``.
    ``unique``: the share of rows whose value occurs only once exceeds ``limit``.
    """

    kind: str
    column: str
    values: tuple[str, ...] = ()
    threshold: float = 1.0
    limit: float = 0.0

    @property
    def text(self) -> str:
        if self.kind == "unique":
            return f'Uniqueness "{self.column}" > {self.limit:g}'
        if self.kind == "at_most":
            return f'ColumnValues "{self.column}" <= {self.limit:g}'
        listed = f'ColumnValues "{self.column}" in {json.dumps(list(self.values), ensure_ascii=False, separators=(",", ":"))}'
        return listed if self.threshold >= 1 else f"{listed} with threshold >= {self.threshold:g}"


def listed(column: str, values: Sequence[str], threshold: float = 1.0) -> Rule:
    return Rule("listed", column, tuple(values), threshold)


def at_most(column: str, limit: float) -> Rule:
    return Rule("at_most", column, limit=limit)


def unique(column: str, share: float) -> Rule:
    return Rule("unique", column, limit=share)


# --- evaluation -----------------------------------------------------------------------------


def _share(part: Column, whole: Column) -> Column:
    """Share to four digits; 0 for an empty table."""
    return F.coalesce(half_up(part, whole, 1, 4), F.lit(0.0))


def _measures(rows: DataFrame, rules: Sequence[Rule]) -> list[tuple[DataFrame, dict[int, Rule]]]:
    """One-row tables with a column ``m<i>`` per rule, and the rules each table measures."""
    parts = []
    direct = {i: r for i, r in enumerate(rules) if r.kind != "unique"}
    if direct:
        whole = F.count(F.lit(1))
        parts.append((rows.agg(*[
            (_share(F.count_if(F.col(r.column).cast("string").isin(*r.values)), whole)
             if r.kind == "listed" else F.max(r.column).cast("double")).alias(f"m{i}")
            for i, r in direct.items()
        ]), direct))
    for column in dict.fromkeys(r.column for r in rules if r.kind == "unique"):
        mine = {i: r for i, r in enumerate(rules) if r.kind == "unique" and r.column == column}
        once = F.count_if((F.col("count") == 1) & F.col(column).isNotNull())
        share = _share(once, F.coalesce(F.sum("count"), F.lit(0)))
        parts.append((rows.groupBy(column).count().agg(*[share.alias(f"m{i}") for i in mine]), mine))
    return parts


def _verdict(i: int, rule: Rule) -> Column:
    measure = F.col(f"m{i}")
    if rule.kind == "listed":
        passed, metric, said = measure >= rule.threshold, "ColumnValues.Compliance", "Values of {} in the list: "
    elif rule.kind == "at_most":
        # a column without values breaks no limit
        passed, metric, said = F.coalesce(measure <= rule.limit, F.lit(True)), "Maximum", "Maximum of {}: "
    else:
        passed, metric, said = measure > rule.limit, "Uniqueness", "Uniqueness of {}: "
    shown = F.coalesce(measure.cast("string"), F.lit("null"))
    return F.struct(
        F.lit(i).alias("position"),
        F.lit(rule.text).alias("rule"),
        F.when(passed, "Passed").otherwise("Failed").alias("outcome"),
        F.when(~passed, F.concat(F.lit(said.format(rule.column)), shown)).alias("failure_reason"),
        F.concat(F.lit(f'{{"Column.{rule.column}.{metric}":'), shown, F.lit("}")).alias("evaluated_metrics"),
    )


def evaluate(
    rows: DataFrame,
    rules: Sequence[Rule],
    table: str = "curated",
    database: str = "",
    catalog: str = "",
    run_id: str = "unknown",
    started: str = "",
    completed: str = "",
    run_date: date | None = None,
) -> DataFrame:
    """One result row per rule. All rules on values share one pass; each uniqueness column adds one grouping."""
    verdicts = reduce(DataFrame.unionByName, [
        measured.select(F.inline(F.array(*[_verdict(i, rule) for i, rule in mine.items()])))
        for measured, mine in _measures(rows, rules)
    ])
    constants = {
        "catalog_id": catalog, "database_name": database, "table_name": table, "dq_run_id": run_id,
        "evaluation_started_on": started, "evaluation_completed_on": completed,
    }
    return (
        verdicts.orderBy("position")
        .withColumns({name: F.lit(value) for name, value in constants.items()})
        .withColumn("run_date", F.lit(run_date).cast("date"))
        .select(*DQ_RESULTS.names)
    )


def outcome_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("outcome").agg(F.count(F.lit(1)).alias("rules")).orderBy(F.desc("rules"), "outcome")


def failing_rules(results: DataFrame) -> DataFrame:
    failed = results.where(F.col("outcome") == "Failed")
    return failed.groupBy("rule").agg(F.count(F.lit(1)).alias("occurrences")).orderBy(F.desc("occurrences"), "rule")


def gate(results: DataFrame, min_score: float | None = None) -> DataFrame:
    """One row: rules, passed rules, score, and whether the following jobs may run.

    Without ``min_score`` a finished evaluation is enough, whatever its outcomes.
    """
    counted = results.agg(
        F.count(F.lit(1)).alias("rules"), F.count_if(F.col("outcome") == "Passed").alias("passed"))
    score = F.coalesce(half_up(F.col("passed"), F.col("rules"), 1, 4), F.lit(0.0))
    proceeds = F.lit(True) if min_score is None else F.col("score") >= min_score
    return counted.withColumn("score", score).withColumn("proceed", proceeds)


# --- recommendation -------------------------------------------------------------------------


#: distinct values are estimated to one part in a hundred
_ERROR = 0.01
#: combinations of values counted in one pass
MOST_CELLS = 100_000


def profile(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: rows, nulls, about how many distinct values, largest number. One pass, all columns at once."""
    numeric = {f.name for f in rows.schema.fields if f.dataType.typeName() in ("integer", "long", "double", "short")}
    measures = [F.count(F.lit(1)).alias("rows")]
    for c in columns:
        largest = F.max(c).cast("double") if c in numeric else F.lit(None).cast("double")
        measures += [
            F.count_if(F.col(c).isNull()).alias(f"{c}.nulls"),
            F.approx_count_distinct(c, _ERROR).alias(f"{c}.distinct"),
            largest.alias(f"{c}.largest"),
        ]
    described = [
        F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"`{c}.nulls`").alias("nulls"),
                 F.col(f"`{c}.distinct`").alias("distinct"), F.col(f"`{c}.largest`").alias("largest"))
        for c in columns
    ]
    return rows.agg(*measures).select(F.inline(F.array(*described)))


def recommend(
    rows: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str] = (),
    existing: Sequence[Rule] | None = None,
    most_listed: int = MOST_LISTED,
    common_share: float = COMMON_SHARE,
) -> list[Rule]:
    """Rules the table meets today. An existing rule set is returned as it is.

    Columns with few values get a list of them, and a shorter list with a threshold where some
    values make up ``common_share`` of the rows; numbers get a limit; ``keys`` get a uniqueness
    share just below the present one. Sketches decide which columns may have few values; only those are counted, exactly.
    """
    if existing:
        return list(existing)
    rules: list[Rule] = []
    described = profile(rows, columns).collect()
    # some room for the error of the estimate
    may_be_few = {p["column"]: p["distinct"] for p in described if 0 < p["distinct"] <= most_listed * (1 + 5 * _ERROR) + 1}
    values = {c: found for c, found in _value_counts(rows, may_be_few).items() if len(found) <= most_listed}
    for p in described:
        column, found = p["column"], values.get(p["column"], [])
        if found:
            covered = sum(n for _, n in found)
            rules.append(listed(column, sorted(v for v, _ in found), _below(covered, p["rows"])))
            common = _shortest_cover(found, common_share * p["rows"])
            if 0 < len(common) < len(found):
                share = sum(n for _, n in common)
                rules.append(listed(column, sorted(v for v, _ in common), _below(share, p["rows"])))
        if p["largest"] is not None:
            rules.append(at_most(column, p["largest"]))
    for key in keys:
        share = _measures(rows, [unique(key, 0.0)])[0][0].first()["m0"]
        rules.append(unique(key, max(0.0, int(share * 100 - 1) / 100)))
    return rules


def _below(part: int, whole: int) -> float:
    """The share cut to two digits; 1 only if nothing is missing."""
    return 1.0 if part == whole else (100 * part // whole) / 100


def _value_counts(rows: DataFrame, columns: Mapping[str, int]) -> dict[str, list[tuple[str, int]]]:
    """All values and counts of columns with few values (about how many is given), most frequent first.

    Columns are counted together: a pass has a row per combination of their values, as many columns at a time as have at most
    ``MOST_CELLS`` combinations. The table's rows are not multiplied.
    """
    groups: list[tuple[list[str], int]] = []
    for column, distinct in sorted(columns.items(), key=lambda c: c[1]):
        # null is a value here
        if groups and groups[-1][1] * (distinct + 1) <= MOST_CELLS:
            groups[-1] = ([*groups[-1][0], column], groups[-1][1] * (distinct + 1))
        else:
            groups.append(([column], distinct + 1))
    found: dict[str, list[tuple[str, int]]] = {}
    for together, _ in groups:
        cells = rows.groupBy(*together).agg(F.count(F.lit(1)).alias("n"))
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in together])).alias("p")
        counts = cells.select("n", pairs).select("p.*", "n").where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.sum("n").alias("n"))
        for r in sorted(counts.collect(), key=lambda r: (-r["n"], r["column"], r["value"])):
            found.setdefault(r["column"], []).append((r["value"], r["n"]))
    return found


def _shortest_cover(found: Sequence[tuple[str, int]], rows: float) -> list[tuple[str, int]]:
    cover, total = [], 0
    for value, n in found:
        if total >= rows:
            break
        cover.append((value, n))
        total += n
    return cover if total >= rows else []


#: a rule set as rows
RULES = "position int, kind string, column string, values array<string>, threshold double, limit double, rule string"


def rules_table(spark, rules: Sequence[Rule]) -> DataFrame:
    """Rules as rows, for storing and showing."""
    return spark.createDataFrame([(i, r.kind, r.column, list(r.values), float(r.threshold), float(r.limit), r.text) for i, r in enumerate(rules)], RULES)
