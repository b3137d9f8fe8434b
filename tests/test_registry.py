"""Every registered query gives the rows of its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from searchtide.registry import oracles, queries
from tests.conftest import SMALL
from tools.compare import compare, tables

#: results that depend on choices SQL does not make
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def db():
    return tables(SMALL)


def test_names_match():
    assert set(oracles.oracle_sql()) == set(queries.queries()) - ROWS_ONLY
    assert set(queries.queries()) <= set(entry.queries()) and set(oracles.oracle_sql()) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", list(queries.queries()))
def test_query(spark, db, name):
    verdict, _, rows = compare(spark, db, SMALL, name)
    assert verdict == ("rows only" if name in ROWS_ONLY else "ok")
    assert name in ("report_missing_days", "report_filter", "report_trending") or rows > 0


def test_rollup_curates_once(spark, monkeypatch):
    """Both curations read events that are marked already: neither derives, deduplicates or sorts them again."""
    seen, true = [], queries.commit_curated
    monkeypatch.setattr(queries, "commit_curated", lambda rows, *rest: seen.append(rows) or true(rows, *rest))
    assert queries.queries()["rollup_distinct_keywords"](spark, SMALL).count() == 2
    for rows in seen:
        plan = rows._jdf.queryExecution().optimizedPlan().toString()
        assert not any("events.parquet" in f for f in rows.inputFiles()) and "Window" not in plan
    assert len(seen) == 2


def test_entry(spark):
    assert entry.entry(spark).columns == ["keyword_norm", "derived_genre", "searches", "abandoned", "abandon_rate_pct"]
