"""Deduplication, repeat searches, lookups and near spellings, also where one key dominates."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from searchtide.operators import classify, lookup, repeats
from searchtide.operators.dedup import keep_first_event
from searchtide.plans.curate import CurationRules, curated, usable_events
from searchtide.sources.testtables import TEST_RULES

EVENTS = "eventid string, event_ts timestamp_ntz, dt string, keyword string"


def plan_of(frame) -> str:
    # a new query, so the plan is the one before adaptive changes
    return frame.select("*")._jdf.queryExecution().executedPlan().toString()


def test_dedup_keeps_the_earliest_copy(spark):
    rows = [("1", "2022-06-01 00:00:02", "20220601", "late"), ("1", "2022-06-01 00:00:01", "20220602", "first"),
            ("1", "2022-06-01 00:00:01", "20220603", "copy"), (None, "2022-06-01 00:00:05", "20220601", "x"),
            (None, "2022-06-01 00:00:04", "20220601", "y"), ("2", "2022-06-01 00:00:01", "20220601", "z")]
    frame = spark.createDataFrame(rows, "eventid string, event_ts string, dt string, keyword string").withColumn(
        "event_ts", F.col("event_ts").cast("timestamp"))
    once = keep_first_event(frame)
    assert {r["keyword"] for r in once.collect()} == {"first", "y", "z"}
    assert {r["keyword"] for r in keep_first_event(frame, keep_null_ids=False).collect()} == {"first", "z"}
    assert keep_first_event(once).exceptAll(once).count() == 0
    # copies are dropped before the shuffle as well as after it
    assert plan_of(once).count("WindowGroupLimit") == 2


def test_dedup_survivor_does_not_depend_on_row_order(spark):
    rows = [("1", 5, "20220601", f"k{i}") for i in range(50)]
    picked = set()
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        frame = spark.createDataFrame(rows, "eventid string, event_ts int, dt string, keyword string").repartition(seed + 1)
        picked.add(keep_first_event(frame).first()["keyword"])
    assert len(picked) == 1


def session_rows(spark, rows):
    frame = spark.createDataFrame(rows, "session_key string, event_ts int, eventid string, keyword_norm string")
    return frame.withColumn("event_ts", F.timestamp_seconds("event_ts"))


def flags(frame):
    return {r["eventid"]: r["is_repeat_search"] for r in frame.collect()}


def test_repeat_search_passes_over_missing_keywords(spark):
    rows = [("s", i, str(i), k) for i, k in enumerate(["x", None, "x", "y", "y"])]
    assert flags(repeats.mark_repeats(session_rows(spark, rows))) == {
        "0": None, "1": None, "2": True, "3": False, "4": True}


def brute_force(rows):
    last, result = {}, {}
    for session, ts, event, keyword in sorted(rows, key=lambda r: (r[0] or "", r[1], r[2])):
        before = last.get(session)
        result[event] = None if keyword is None or before is None else keyword == before
        if keyword is not None:
            last[session] = keyword
    return result


@pytest.mark.parametrize("hot", ["busy", None])
def test_large_sessions_give_the_same_flags(spark, hot):
    chance = random.Random(7)
    rows = []
    for i in range(3000):
        session = hot if i % 3 == 0 else f"s{chance.randrange(300)}"
        # long runs without keyword, so some slices carry nothing; many equal times
        keyword = None if i % 3 == 0 and 600 < i < 2400 and i % 5 else chance.choice("abc")
        rows.append((session, i // 40 if i % 2 else i // 400, f"e{i:05d}", keyword))
    chance.shuffle(rows)
    frame = session_rows(spark, rows)
    expected = brute_force(rows)
    for hot_rows in (10**6, 200, 3, 0):
        assert flags(repeats.mark_repeats(frame, hot_rows=hot_rows)) == expected
    # a count from elsewhere only decides what is cut
    assert flags(repeats.mark_repeats(frame, counted=frame.union(frame), hot_rows=900)) == expected
    assert flags(repeats.mark_repeats(frame, counted=frame.limit(0), hot_rows=0)) == expected


def test_one_instant_and_one_session_is_still_cut(spark):
    rows = [("s", 0, f"e{i:04d}", "ab"[i % 7 == 0]) for i in range(600)]
    frame = session_rows(spark, rows)
    marked = repeats.mark_repeats(frame, hot_rows=50)
    assert flags(marked) == brute_force(rows)


def test_pieces_of_a_large_session_are_small(spark):
    """Equal times, ids without a common beginning, ids that are missing: no window holds the whole session."""
    rows = [(None, i // 500, f"{i:04d}-{i % 9}" if i % 50 else None, "ab"[i % 3 == 0] if i % 50 else None) for i in range(1500)]
    frame = session_rows(spark, rows)
    got = repeats.mark_repeats(frame, hot_rows=100).where("eventid is not null")
    want = repeats.mark_repeats(frame, hot_rows=10**6).where("eventid is not null")
    assert flags(got) == flags(want)


def test_planning_runs_no_job(spark):
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    rows = session_rows(spark, [("s", 1, "e", "k")])
    repeats.mark_repeats(rows).explain()
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == before


def test_equally_large_sessions_are_all_cut(spark):
    rows = [(f"s{i % 6}", i // 30, f"e{i:04d}", "abc"[i % 5 % 3] if i % 4 else None) for i in range(600)]
    frame = session_rows(spark, rows)
    marked = repeats.mark_repeats(frame, hot_rows=99)
    assert flags(marked) == brute_force(rows)


def test_missing_and_empty_session_keys_differ(spark):
    rows = [(None, i, f"n{i}", "x") for i in range(40)] + [("", i, f"m{i}", "y") for i in range(40)]
    frame = session_rows(spark, rows)
    got = flags(repeats.mark_repeats(frame, hot_rows=5))
    assert sum(v is None for v in got.values()) == 2 and all(v is not False for v in got.values())


def test_sessions_without_key_can_stand_alone(spark):
    rows = [(None, i, str(i), "x") for i in range(3)] + [("s", i, f"s{i}", "x") for i in range(2)]
    frame = session_rows(spark, rows)
    assert flags(repeats.mark_repeats(frame))["1"] is True
    assert flags(repeats.mark_repeats(frame, split_null_sessions=True)) == {
        "0": None, "1": None, "2": None, "s0": None, "s1": True}


def test_lookup_by_broadcast_and_by_shuffle_agree(spark):
    words = [None if i % 3 == 0 else "hot" if i % 3 == 1 else f"w{i}" for i in range(900)]
    rows = spark.createDataFrame(list(enumerate(words)), "id int, keyword_norm string")
    table = spark.createDataFrame([("hot", "A"), ("w2", "B"), ("w5", "C"), ("w5", "B"), (None, "N")], "keyword string, genre string")
    small, large = classify.lut_genre(rows, table), classify.lut_genre(rows, table, broadcast_bytes=0)
    assert "BroadcastHashJoin" in plan_of(small)
    assert small.count() == large.count() == 900
    assert small.exceptAll(large.select(*small.columns)).count() == 0
    found = {r["id"]: r["lut_genre"] for r in small.collect()}
    assert (found[1], found[2], found[5], found[0], found[8]) == ("A", "B", "C", None, None)


def test_missing_keys_are_spread(spark):
    rows = spark.range(4000).select(F.lit(None).cast("string").alias("keyword_norm"), "id")
    table = spark.createDataFrame([("hot", "A"), (None, "N")], "keyword string, genre string")
    joined = classify.lut_genre(rows, table, broadcast_bytes=0)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = [r["count"] for r in classify.lut_genre(rows, table, broadcast_bytes=0).hint("merge").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert len(tasks) > 1 and max(tasks) < 2000 and joined.where("lut_genre is not null").count() == 0


def edits(a: str, b: str) -> int:
    line = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, line[0] = line[0], i
        for j, y in enumerate(b, 1):
            previous, line[j] = line[j], min(line[j] + 1, line[j - 1] + 1, previous + (x != y))
    return line[-1]


def test_near_spellings_match_brute_force(spark):
    chance = random.Random(3)
    words = {"".join(chance.choice("abđ") for _ in range(chance.randrange(3, 7))) for _ in range(120)}
    known = sorted({"".join(chance.choice("abđ") for _ in range(chance.randrange(3, 7))) for _ in range(40)})
    expected = {}
    for word in words:
        close = [(edits(word, k), k) for k in known if len(k) >= 4 and len(word) >= 4 and edits(word, k) <= 1]
        if close:
            expected[word] = min(close)[1]
    got = classify.near_genre(
        spark.createDataFrame([(w,) for w in words], "keyword_norm string"),
        spark.createDataFrame([(k, "G") for k in known], "keyword string, genre string"))
    assert {r["keyword_norm"]: r["near_keyword"] for r in got.collect()} == expected


def test_waterfall_order(spark):
    rows = spark.createDataFrame([("naruto",), ("narutoo",), ("bong da",), ("bong dá x",), ("",), (None,), ("abcde",)], "keyword_norm string")
    lut = spark.createDataFrame([("bong da", "NHAC"), ("abcdf", "PHIM_HAN")], "keyword string, genre string")
    got = {r["keyword_norm"]: r["derived_genre"] for r in classify.classify(rows, lut).collect()}
    assert got == {"naruto": "ANIME", "narutoo": "UNKNOWN", "bong da": "NHAC", "bong dá x": "UNKNOWN",
                   "": "EMPTY_QUERY", None: "EMPTY_QUERY", "abcde": "UNKNOWN"}
    near = {r["keyword_norm"]: r["derived_genre"] for r in classify.classify(rows, lut, near=True).collect()}
    assert near == {**got, "abcde": "PHIM_HAN"}


def test_curated_plan_is_native_and_prunes(spark, raw):
    lut = spark.createDataFrame([("blue gear", "ANIME")], "keyword string, genre string")
    plan = plan_of(curated(raw, lut, TEST_RULES))
    assert "Python" not in plan and "BroadcastHashJoin" in plan and "CartesianProduct" not in plan
    # a reader of one column does not carry the others through the shuffle, and pays for no session window
    narrow = plan_of(curated(raw, rules=TEST_RULES, repeats=False).select("platform_group"))
    assert narrow.count("Exchange hashpartitioning") == 1 and "session_key" not in narrow


def test_curated_is_the_same_on_every_run(spark, raw):
    first = curated(raw, rules=TEST_RULES)
    again = curated(raw.repartition(5), rules=CurationRules(patterns=TEST_RULES.patterns, hot_session_rows=20))
    assert first.exceptAll(again).count() == 0 and again.exceptAll(first).count() == 0


def test_measured_size(spark):
    assert lookup.text_bytes(spark.createDataFrame([("ab", "c"), ("é", None)], "a string, b string")) == 2 * 32 + 5
    assert lookup.text_bytes(spark.createDataFrame([], "a string")) == 0


def test_published_counts_of_the_fixture(spark, raw):
    usable = usable_events(raw)
    rows = curated(raw, rules=TEST_RULES)
    assert (raw.count(), usable.count(), rows.count()) == (1020, 1015, 996)
    assert rows.where("search_session_id IS NULL").count() == 35
    assert rows.where("is_repeat_search").count() == 3
