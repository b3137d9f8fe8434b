"""Rollup, quality job and the jobs of a night."""

from __future__ import annotations

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from searchtide.operators import classify, quality
from searchtide.plans import nightly, report_pack, reports, rollup, trending
from searchtide.plans.curate import prepared_events, usable_events
from searchtide.plans.quality_job import run_quality, store_rules, stored_rules
from searchtide.registry.settings import TREND
from searchtide.sources import lut_store, quality_results, versions
from searchtide.sources.curated import commit_curated, read_curated
from searchtide.sources.raw import write_raw
from searchtide.sources.testtables import TEST_RULES


def rows_of(frame):
    return sorted(map(str, frame.collect()))


def test_rollup_reads_changed_days_only_and_answers_the_reports(spark, raw, tmp_path, monkeypatch):
    table, root = str(tmp_path / "curated"), str(tmp_path / "rollup")
    events = usable_events(raw)
    commit_curated(prepared_events(events, rules=TEST_RULES), table, "first", TEST_RULES)
    assert len(rollup.refresh_rollup(spark, table, root)) == read_curated(spark, table).select("dt").distinct().count()
    assert rollup.refresh_rollup(spark, table, root) == []
    before = versions.current(spark, root).parts

    lut = spark.createDataFrame([("small anvil", "PHIM_VIET")], "keyword string, genre string")
    commit_curated(prepared_events(events, lut, TEST_RULES).where("dt = '2024-01-12'"), table, "second", TEST_RULES)
    read = []
    original = versions.read
    monkeypatch.setattr(versions, "read", lambda *a, **k: read.append(a) or original(*a, **k))
    assert rollup.refresh_rollup(spark, table, root) == ["dt=2024-01-12"]
    assert all(p.startswith("dt=2024-01-12/") for p in read[0][4])
    monkeypatch.undo()
    after = versions.current(spark, root).parts
    assert {p for p in after if after[p] != before[p]} == {f"kind={k}/dt=2024-01-12" for k in rollup.KINDS}

    rows = read_curated(spark, table)
    cells, keywords = rollup.read_rollup(spark, root, "cells"), rollup.read_rollup(spark, root, "keywords")
    for name, section in report_pack.SECTIONS.items():
        assert rows_of(section(cells, keywords)) == rows_of(section(*report_pack.summaries(rows))), name
    assert rows_of(reports.by_hour(cells)) == rows_of(reports.by_hour(rows))
    loose = trending.TrendRules(baseline_age=TREND.baseline_age, min_growth=1.0, min_volume=1)
    assert rows_of(trending.trending(keywords, rules=loose)[0]) == rows_of(trending.trending(rows, rules=loose)[0])
    some = rollup.read_rollup(spark, root, "cells", date(2024, 1, 12), date(2024, 1, 13))
    assert {r["dt"] for r in some.collect()} == {"2024-01-12", "2024-01-13"}


def test_sketches_of_thirty_days_are_within_two_percent(spark):
    days = spark.range(300_000).select(
        F.format_string("2024-01-%02d", F.col("id") % 30 + 1).alias("dt"), F.concat(F.lit("k"), F.pmod(F.hash("id"), F.lit(90_000))).alias("keyword_norm"))
    sketches = days.groupBy("dt").agg(F.hll_sketch_agg("keyword_norm", rollup.SKETCH_BITS).alias("sketch"))
    exact = days.select("keyword_norm").distinct().count()
    assert abs(rollup.distinct_keywords(sketches).first()["kw"] - exact) <= 0.02 * exact
    assert rollup.distinct_keywords(sketches.limit(0)).first()["kw"] == 0


def test_quality_job(spark, curated_rows, tmp_path):
    where = [str(tmp_path / n) for n in ("rules", "results")]
    columns = ["derived_genre", "subscription_count"]
    first = run_quality(curated_rows, *where, columns, ["event_id"], "one", min_score=1.0).first()
    assert first["recommended"] and first["proceed"] and first["rules"] == first["passed"] == len(stored_rules(spark, where[0])) > 3
    # the rules stay, and rows that break them are seen
    odd = curated_rows.withColumn("derived_genre", F.lit("NEW"))
    second = run_quality(odd, *where, columns, ["event_id"], "two", min_score=1.0).first()
    assert not second["recommended"] and not second["proceed"] and second["passed"] < second["rules"]
    for r in quality_results.read_results(spark, where[1]).collect():
        assert "" < r["evaluation_started_on"] <= r["evaluation_completed_on"] and r["dq_run_id"] in ("one", "two")


def test_evaluation_goes_on_when_recommending_fails(spark, curated_rows, tmp_path):
    fallback = [quality.at_most("subscription_count", 15)]
    found = run_quality(curated_rows, str(tmp_path / "rules"), str(tmp_path / "results"), ["no_such_column"], fallback=fallback).first()
    assert (found["recommended"], found["rules"], found["passed"], found["proceed"]) == (False, 1, 1, True)
    assert found["message"].startswith("AnalysisException") and stored_rules(spark, str(tmp_path / "rules")) == []
    nothing = run_quality(curated_rows, str(tmp_path / "rules"), str(tmp_path / "results"), ["no_such_column"]).first()
    assert (nothing["rules"], nothing["score"]) == (0, 0.0)


def test_rules_are_stored_as_they_are(spark, tmp_path):
    rules = [quality.listed("s", ["a", 'b"'], 0.5), quality.at_most("n", 3.5), quality.unique("k", 0.25)]
    store_rules(spark, rules, str(tmp_path / "rules"))
    assert stored_rules(spark, str(tmp_path / "rules")) == rules


def test_profile_does_not_multiply_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("a"), (F.col("id") % 7).cast("string").alias("b"), "id")
    plan = quality.profile(rows, ["a", "b", "id"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan
    assert quality._value_counts(rows, {"a": 3, "b": 7})["a"] == [("0", 334), ("1", 333), ("2", 333)]
    kinds = {(r.kind, r.column) for r in quality.recommend(rows, ["a", "b", "id"])}
    assert ("listed", "a") in kinds and ("listed", "b") in kinds and ("listed", "id") not in kinds


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_near_spellings_by_brute_force(spark, edits):
    draw = random.Random(edits)
    # short alphabets and common beginnings, so that many words share a piece
    words = ["phim" + "".join(draw.choice("ab") for _ in range(draw.randrange(6))) for _ in range(40)]
    words += ["".join(draw.choice("abcé") for _ in range(draw.randrange(2, 9))) for _ in range(60)]
    asked, known = words[::2], words[1::2]
    got = {r["keyword_norm"]: r["near_keyword"] for r in classify.near_genre(
        spark.createDataFrame([(w,) for w in asked], "keyword_norm string"), spark.createDataFrame([(w, "NHAC") for w in known], "keyword string, genre string"),
        edits=edits).collect()}
    want = {}
    for w in asked:
        near = [(distance(w, k), k) for k in known if len(k) >= 4 and len(w) >= 4 and distance(w, k) <= edits]
        if near:
            want[w] = min(near)[1]
    assert got == want


def test_a_night(spark, raw, tmp_path):
    root, lake = str(tmp_path / "raw"), str(tmp_path / "lake")
    write_raw(raw, root)
    lut_store.save(spark, f"{lake}/lut", spark.createDataFrame([("small anvil", "PHIM_VIET")], "keyword string, genre string"))
    done = nightly.run_night(spark, root, lake, "n1", rules=TEST_RULES, trend=TREND).collect()
    assert [(r["step"], r["ok"]) for r in done] == [(s, True) for s in ("curation", "quality", "rollup", "reports", "keyword table")], done
    assert spark.read.parquet(f"{lake}/reports/run=n1/section=trending").count() >= 0
    # nothing new: the same tables, and a step that fails does not stop the others
    broken = nightly.run_night(spark, root, lake, "n2", rules=TEST_RULES, trend=TREND, day=date(2024, 1, 30), classifier=None, columns=["derived_genre"]).collect()
    assert {r["step"]: r["ok"] for r in broken}["reports"] and "'new_files': 0" in broken[0]["detail"]
    # a gate that is not passed stops what comes after it
    store_rules(spark, [quality.at_most("subscription_count", 0)], f"{lake}/rules")
    gated = nightly.run_night(spark, root, lake, "n3", rules=TEST_RULES, trend=TREND, min_score=0.5).collect()
    assert [r["step"] for r in gated] == ["curation", "quality", "gate"] and not gated[-1]["ok"]
    # and so does a failing curation
    assert [(r["step"], r["ok"]) for r in nightly.run_night(spark, f"{root}/nowhere", lake, "n4").collect()] == [("curation", False)]
