"""Whole jobs: files in, tables out."""

from __future__ import annotations

import json
import random
import shutil
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from searchtide.operators import access, contracts, lut as ops, quality
from searchtide.operators.lineage import lineage_counts, with_alarm
from searchtide.plans.curate import CurationRules, curated
from searchtide.plans.curation_job import run_curation, run_new_files
from searchtide.plans.lut_refresh import OfflineClassifier, RefreshLimits, refresh_lut, replies
from searchtide.schemas import CURATED, RAW
from searchtide.session import shuffle_tasks, sized
from searchtide.sources import folders, lut_store, quality_results, versions
from searchtide.sources.curated import commit_curated, newest_day, partition, read_curated, remove_stale_partitions, write_curated
from searchtide.sources.raw import parse_since, raw_bytes, read_raw, write_raw
from searchtide.sources.testtables import TEST_RULES
from searchtide.streaming import dedup, ingest as stream_ingest, ledger
from searchtide.streaming.dedup import append_to, first_events
from searchtide.streaming.ingest import ingest, raw_stream, side_counts
from tests.conftest import SMALL

OUT = [c for c in CURATED.names if c != "_pipeline_run_id"]


def same(left, right, columns=OUT):
    left, right = left.select(*columns), right.select(*columns)
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def raw_row(event, moment="2022-06-01 05:00:00.000", keyword="naruto", dt="20220601", **other):
    row = dict(eventid=event, datetime=moment, keyword=keyword, category="quit", action="search", platform="web",
               networktype="WiFi", userplansmap=["VIP:1"], proxy_isp="isp", user_id="u", dt=dt)
    return tuple({**row, **other}[c] for c in RAW.names)


def raw_table(spark, *rows):
    return spark.createDataFrame(list(rows), RAW)


# --- raw files ------------------------------------------------------------------------------


@pytest.mark.parametrize("argument,day", [
    ("dt >= 2022-06-03", date(2022, 6, 3)), ("2022-06-03", date(2022, 6, 3)), ("all", None), ("None", None), ("", None), (None, None)])
def test_since_argument(argument, day):
    assert parse_since(argument) == day


def test_since_argument_must_be_a_day():
    with pytest.raises(ValueError):
        parse_since("dt > yesterday")


def test_raw_folder_round_trip(spark, tmp_path):
    root = str(tmp_path / "landing")
    rows = raw_table(spark, *[raw_row(str(i), dt=f"2022060{1 + i % 5}") for i in range(20)])
    write_raw(rows, root)
    assert {p.name for p in Path(root).iterdir() if p.is_dir()} == {f"2022060{d}" for d in range(1, 6)}
    assert "eventID" in spark.read.parquet(f"{root}/20220601").columns
    back = read_raw(spark, root)
    assert back.columns == RAW.names and back.exceptAll(rows).count() == 0 and back.count() == 20
    recent = read_raw(spark, root, date(2022, 6, 4))
    assert recent.count() == 8
    # older folders are left out before any file is opened
    assert all("/20220604/" in f or "/20220605/" in f for f in recent.inputFiles())
    assert read_raw(spark, root, date(2023, 1, 1)).count() == 0


def test_nested_day_folders_and_stray_files(spark, tmp_path):
    root = str(tmp_path / "landing")
    write_raw(raw_table(spark, raw_row("1")), f"{root}/north")
    write_raw(raw_table(spark, raw_row("2", dt="20220605")), f"{root}/north2")
    raw_table(spark, raw_row("3")).drop("dt").write.parquet(f"{root}/stray")
    assert {(r["eventid"], r["dt"]) for r in read_raw(spark, root).collect()} == {("1", "20220601"), ("2", "20220605"), ("3", "")}
    assert [r["eventid"] for r in read_raw(spark, root, date(2022, 6, 2)).collect()] == ["2"]

    lineage = run_curation(spark, root, str(tmp_path / "out"), run_id="r", quarantine=str(tmp_path / "bad")).first()
    assert (lineage["raw_rows"], lineage["output_rows"]) == (3, 2)
    assert [r["eventid"] for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["3"]


# --- curation -------------------------------------------------------------------------------


def test_job_writes_what_the_query_returns(spark, raw, curated_path, curated_rows):
    assert curated_rows.columns == CURATED.names
    assert same(curated_rows, curated(raw, rules=TEST_RULES))
    # one file per day and genre
    for folder in Path(curated_path).glob("data/commit=*/dt=*/derived_genre=*"):
        assert len(list(folder.glob("*.parquet"))) == 1
    one = partition(curated_rows, "2024-01-12", "PHIM_HAN")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "(dt#" in plan.split("PartitionFilters", 1)[1].split("PushedFilters")[0]
    assert one.count() > 0 and {r["dt"] for r in one.collect()} == {"2024-01-12"}


def test_large_partition_becomes_several_files(spark, tmp_path):
    text = {"eventid": F.sha2(F.col("id").cast("string"), 256), "keyword_norm": F.lit("k"), "session_key": F.lit("s"),
            "derived_genre": F.lit("NHAC"), "dt": F.lit("2022-06-01"), "platform": F.lit("web"), "networktype": F.lit("4g"),
            "proxy_isp": F.lit("isp"), "user_id": F.lit("u"), "category": F.lit("quit")}
    rows = spark.range(60_000).select(
        *[value.alias(name) for name, value in text.items()], F.array(F.lit("VIP:1")).alias("userplansmap"),
        F.lit(True).alias("is_repeat_search"), F.timestamp_seconds("id").alias("event_ts"))
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "300k",
                "spark.sql.adaptive.coalescePartitions.minPartitionSize": "10k"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        write_curated(rows, str(tmp_path / "split"))
        write_curated(rows, str(tmp_path / "single"), one_file_per_group=True)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    files = {n: len(list((tmp_path / n).glob("dt=*/derived_genre=*/*.parquet"))) for n in ("split", "single")}
    assert files["single"] == 1 and files["split"] > 1
    assert read_curated(spark, str(tmp_path / "split")).count() == 60_000


def test_untouched_days_survive_and_stale_genres_go(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")
    write_raw(raw_table(spark, raw_row("1"), raw_row("2", keyword="zzz", dt="20220602")), root)
    run_curation(spark, root, out, run_id="first")
    lut = spark.createDataFrame([("zzz", "NHAC")], "keyword string, genre string")
    run_curation(spark, root, out, since="dt >= 2022-06-02", lut=lut, run_id="second", clear_days=False)
    groups = {(r["dt"], r["derived_genre"]) for r in read_curated(spark, out).collect()}
    assert groups == {("2022-06-01", "ANIME"), ("2022-06-02", "UNKNOWN"), ("2022-06-02", "NHAC")}
    run_curation(spark, root, out, since="dt >= 2022-06-02", lut=lut, run_id="third", clear_days=True)
    groups = {(r["dt"], r["derived_genre"], r["_pipeline_run_id"]) for r in read_curated(spark, out).collect()}
    assert groups == {("2022-06-01", "ANIME", "first"), ("2022-06-02", "NHAC", "third")}
    with pytest.raises(ValueError):
        remove_stale_partitions(spark, out, "unknown")


def test_lineage(spark, raw, tmp_path):
    root = str(tmp_path / "landing")
    write_raw(raw, root)
    for run_id in ("unknown", "named"):
        row = run_curation(spark, root, str(tmp_path / run_id), rules=TEST_RULES, run_id=run_id).first()
        assert tuple(row)[1:5] == (1020, 1015, 996, 996) and row["retention_alarm"] is False
    assert tuple(lineage_counts(raw).first())[:4] == (1020, 1015, 996, 996)


def test_lineage_without_usable_rows(spark, tmp_path):
    root = str(tmp_path / "landing")
    write_raw(raw_table(spark, raw_row("1", "?"), raw_row("2", "?")), root)
    row = run_curation(spark, root, str(tmp_path / "a"), run_id="r").first()
    assert tuple(row) == ("r", 2, 0, 0, 0, 0.0, True)
    row = run_curation(spark, root, str(tmp_path / "b"), since="2030-01-01", clear_days=True, run_id="r").first()
    assert tuple(row) == ("r", 0, 0, 0, 0, 0.0, True)


def test_a_counter_that_counted_twice_is_corrected(spark, raw, tmp_path, monkeypatch):
    from searchtide.plans import curation_job

    root = str(tmp_path / "landing")
    write_raw(raw, root)
    honest = curation_job._counter
    monkeypatch.setattr(curation_job, "_counter", lambda observation: honest(observation) + 7)
    row = run_curation(spark, root, str(tmp_path / "out"), rules=TEST_RULES, run_id="r").first()
    assert tuple(row)[1:5] == (1020, 1015, 996, 996)


@pytest.mark.parametrize("output,total,alarm", [(69, 100, True), (70, 100, False), (0, 0, True)])
def test_retention_alarm(spark, output, total, alarm):
    counts = spark.createDataFrame([(total, total, output, output)],
                                   "raw_rows bigint, post_year_rows bigint, post_dedup_rows bigint, output_rows bigint")
    assert with_alarm(counts).first()["retention_alarm"] is alarm


def test_shuffles_are_sized_without_touching_the_session(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    assert shuffle_tasks(spark, 100 * 1000**4) < 50_000
    own = sized(spark, 1024**4)
    assert own.conf.get(setting) == "512" and spark.conf.get(setting) == before
    assert own.conf.get("spark.sql.session.timeZone") == "UTC"
    assert sized(spark, 1).conf.get(setting) == before


def test_only_selected_days_are_sized(spark, raw, tmp_path):
    root = str(tmp_path / "landing")
    write_raw(raw, root)
    days = sorted(p.name for p in Path(root).iterdir() if p.name.isdigit())
    last = f"{days[-1][:4]}-{days[-1][4:6]}-{days[-1][6:]}"
    chosen = raw_bytes(spark, root, parse_since(last))
    assert chosen == sum(p.stat().st_size for p in (Path(root) / days[-1]).iterdir() if not p.name.endswith(".crc"))
    assert raw_bytes(spark, root) > 5 * chosen


# --- streams --------------------------------------------------------------------------------


def test_ingest_in_steps_equals_one_batch_run(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")
    arrivals = [
        [raw_row("1"), raw_row("2", keyword="zzz")],
        [raw_row("1", dt="20220602"), raw_row("3", "2022-06-02 05:00:00.000", dt="20220602"), raw_row("bad", "?", dt="20220602")],
        [raw_row("4", "2022-06-01 05:00:01.000"), raw_row("2", "2022-06-01 04:59:59.000", keyword="zzz")],
    ]
    seen = []
    for number, rows in enumerate(arrivals):
        write_raw(raw_table(spark, *rows), f"{root}/{number}")
        seen += rows
        ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
        assert same(read_curated(spark, out), curated(raw_table(spark, *seen))), number
    assert not list(Path(out).glob("work/*"))
    before = {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}
    ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
    assert before == {p: p.stat().st_mtime_ns for p in Path(out).rglob("*.parquet")}


def random_arrivals(seed, parts, n):
    """Raw rows of a few users in few sessions, with copies on other days and at other times, dealt at random."""
    draw = random.Random(seed)
    arrivals = [[] for _ in range(parts)]
    for i in range(n):
        at = datetime(2022, 6, 1) + timedelta(days=draw.choice([0, 0, 0, 1, 12]), seconds=draw.randrange(4000))
        keyword = draw.choice(["naruto", "zzz", "nhac", None, ""])
        user = draw.choice(["u", "v", None])
        row = dict(keyword=keyword, user_id=user, proxy_isp=draw.choice(["isp", None]), category=draw.choice(["quit", None]))
        for _ in range(draw.choice([1, 1, 2, 3])):
            moment = at + timedelta(seconds=draw.choice([0, 0, -30, 900]))
            day = at + timedelta(days=draw.choice([0, 0, 1, 11]))
            key = draw.choice([f"e{i}"] * 9 + [None])
            draw.choice(arrivals).append(raw_row(key, moment.strftime("%Y-%m-%d %H:%M:%S.000"), dt=day.strftime("%Y%m%d"), **row))
    return arrivals


@pytest.mark.parametrize("split,hot", [(False, 10**6), (True, 5)])
def test_ingest_of_random_arrivals_equals_batch(spark, tmp_path, monkeypatch, split, hot):
    """Copies over any distance, out of order, displaced; tails and ledger merged on the way."""
    monkeypatch.setattr(ledger, "MOST_FILES", 2)
    monkeypatch.setattr(stream_ingest, "MOST_TAILS", 1)
    rules = CurationRules(split_null_sessions=split, hot_session_rows=hot)
    root, out, seen = str(tmp_path / "landing"), str(tmp_path / "out"), []
    for number, rows in enumerate(random_arrivals(3, 3, 70)):
        write_raw(raw_table(spark, *rows), f"{root}/{number}")
        seen += rows
        ingest(raw_stream(spark, root), out, str(tmp_path / "progress"), rules=rules)
        assert same(read_curated(spark, out), curated(raw_table(spark, *seen), rules=rules)), number


def test_flags_of_counted_sessions_take_one_pass(spark):
    """Who has counted the sessions goes through the rows once, and large sessions without a key are cut as well."""
    from searchtide.operators.repeats import mark_repeats

    draw = random.Random(2)
    at = datetime(2022, 6, 1)
    rows = spark.createDataFrame(
        [(draw.choice(["a", "b", None, ""]), at + timedelta(seconds=draw.randrange(9000)), str(i), draw.choice(["x", "y", "", None])) for i in range(300)],
        "session_key string, event_ts timestamp, eventid string, keyword_norm string")
    expected = mark_repeats(rows)
    counted = mark_repeats(rows, hot_keys=[])
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Join" not in plan and "Aggregate" not in plan
    flags = {r["eventid"]: r["is_repeat_search"] for r in expected.collect()}
    for got in (counted, mark_repeats(rows, hot_keys=["a", None])):
        assert {r["eventid"]: r["is_repeat_search"] for r in got.collect()} == flags


def test_a_batch_writes_only_where_its_sessions_are(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")

    def arrive(name, *rows):
        write_raw(raw_table(spark, *rows), f"{root}/{name}")
        before = versions.current(spark, out).parts
        ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
        after = versions.current(spark, out).parts
        rewritten = {p for p in after if p.startswith("dt=") and not set(before.get(p, ())) <= set(after[p])}
        return rewritten, {p for p in after if p.startswith("dt=") and before.get(p) != after[p]}

    arrive("a", raw_row("1"), raw_row("2", "2022-06-02 05:00:00.000", user_id="other", dt="20220602"))
    # later in the same session: the flag comes from the tail, a file is added, nothing is written anew
    assert arrive("b", raw_row("3", "2022-06-01 05:10:00.000")) == (set(), {"dt=2022-06-01/derived_genre=ANIME"})
    # earlier in it: its own folder is written anew, the other day is left alone
    assert arrive("c", raw_row("4", "2022-06-01 05:05:00.000", keyword="zzz"))[0] == {"dt=2022-06-01/derived_genre=ANIME"}
    # an earlier copy on another day takes the place of one
    assert arrive("d", raw_row("2", "2022-06-01 05:00:00.000", user_id="other", dt="20220601"))[0] == set()
    assert "dt=2022-06-02/derived_genre=ANIME" not in versions.current(spark, out).parts
    flags = {r["event_id"]: r["is_repeat_search"] for r in read_curated(spark, out).collect()}
    assert flags == {"1": None, "4": False, "3": False, "2": None}


def test_rows_outside_day_folders_are_counted(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")
    write_raw(raw_table(spark, raw_row("1")), f"{root}/a")
    raw_table(spark, raw_row("2"), raw_row("3")).drop("dt").write.parquet(f"{root}/stray")
    ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
    raw_table(spark, raw_row("4")).drop("dt").write.parquet(f"{root}/stray2")
    ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
    assert [r["event_id"] for r in read_curated(spark, out).collect()] == ["1"]
    assert [tuple(r) for r in side_counts(spark, out).collect()] == [("undated", 3)]


def test_a_batch_that_runs_again_is_published_once(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")
    write_raw(raw_table(spark, raw_row("1")), f"{root}/a")
    ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
    # as after a crash between publishing and noting the batch as done
    for note in Path(tmp_path / "progress" / "commits").glob("*0*"):
        note.unlink()
    ingest(raw_stream(spark, root), out, str(tmp_path / "progress"))
    assert versions.numbers(spark, out) == [1] and read_curated(spark, out).count() == 1


def test_ledger_opens_only_files_that_may_know(spark, tmp_path):
    root, work = str(tmp_path / "table"), str(tmp_path / "work")
    version = versions.Version()

    def entries(ids, day="20220601"):
        return spark.createDataFrame([(f"+{i}", datetime(2022, 6, 1), day, 1) for i in ids], ledger.ENTRY)

    for start in (0, 5000):
        commit = versions.new_commit(root)
        added = ledger.add(entries(range(start, start + 5000)), commit)
        version = versions.publish(spark, root, version, {p: (*version.parts.get(p, ()), *w) for p, w in added.items()})
    found, opened = ledger.known(spark, root, version, entries([7, 5007, 99_999]), f"{work}/1")
    assert {r["id_key"] for r in found.collect()} == {"+7", "+5007"} and len(opened) <= 3
    # all known ids pass the filters, of the unknown few do
    assert ledger.candidates(spark, root, version, entries(range(10_000))).select("id_key").distinct().count() == 10_000
    wrong = ledger.candidates(spark, root, version, entries(range(10_000, 20_000))).select("id_key").distinct().count()
    assert wrong < 200
    found, opened = ledger.known(spark, root, version, entries([]), f"{work}/2")
    assert found.count() == 0 and opened == []


def test_stream_dedup(spark, tmp_path):
    root = str(tmp_path / "landing")
    write_raw(raw_table(spark, raw_row("1"), raw_row("2"), raw_row("bad", "?")), f"{root}/a")
    for n in range(2):
        append_to(first_events(raw_stream(spark, root)), str(tmp_path / "once"), str(tmp_path / "progress"))
        write_raw(raw_table(spark, raw_row("1", dt="20220602"), raw_row("3", dt="20220602")), f"{root}/b")
    ids = sorted(r["eventid"] for r in spark.read.parquet(str(tmp_path / "once")).collect())
    assert ids == ["1", "2", "3"]


def test_stream_dedup_over_any_distance(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "events")
    arrivals = [
        [raw_row("1"), raw_row("2", "2022-06-10 05:00:00.000", dt="20220610"), raw_row("bad", "?")],
        # a copy ten days later, a late event and one that is not yet late
        [raw_row("1", dt="20220611"), raw_row("3"), raw_row("4", "2022-06-09 05:00:00.000", dt="20220610")],
        # the late event again
        [raw_row("3"), raw_row("4", dt="20220612"), raw_row("5", "2022-06-12 05:00:00.000", dt="20220612")],
    ]
    for number, rows in enumerate(arrivals):
        write_raw(raw_table(spark, *rows), f"{root}/{number}")
        raw_table(spark, raw_row(f"stray {number}")).drop("dt").write.parquet(f"{root}/stray-{number}")
        dedup.append_once(raw_stream(spark, root), out, str(tmp_path / "progress"))
    assert sorted(r["eventid"] for r in dedup.rows(spark, out).collect()) == ["1", "2", "4", "5"]
    aside = sorted((r["reason"], r["eventid"]) for r in dedup.side_rows(spark, out).collect())
    assert aside == [("late", "3"), ("undated", "stray 0"), ("undated", "stray 1"), ("undated", "stray 2")]


def test_stream_dedup_moves_rows_once(spark, tmp_path, monkeypatch):
    """A batch keeps no copies of its rows aside, whatever is in it."""
    root, out, kept_aside = str(tmp_path / "landing"), str(tmp_path / "events"), []
    remove = folders.remove

    def watched(session, path):
        if "/work/" in path:
            kept_aside.append(folders.subfolders(session, path))
        remove(session, path)

    monkeypatch.setattr(folders, "remove", watched)
    arrivals = [
        [raw_row("1", dt="20220603"), raw_row("1"), raw_row(None, "2022-06-01 06:00:00.000"), raw_row(None)],
        # only what is known; only times that cannot be read; nothing but a file outside the day folders
        [raw_row("1"), raw_row(None), raw_row("1", "2022-06-30 05:00:00.000", dt="20220630")],
        [raw_row("bad", "?")],
        [],
        # the known copy has moved the clock
        [raw_row("2"), raw_row("3", "2022-06-29 05:00:00.000", dt="20220629")],
    ]
    for number, rows in enumerate(arrivals):
        if rows:
            write_raw(raw_table(spark, *rows), f"{root}/{number}")
        else:
            raw_table(spark, raw_row("stray")).drop("dt").write.parquet(f"{root}/stray")
        dedup.append_once(raw_stream(spark, root), out, str(tmp_path / "progress"))
    rows = sorted((r["eventid"] or "", r["dt"], r["event_ts"].hour) for r in dedup.rows(spark, out).collect())
    assert rows == [("", "20220601", 5), ("1", "20220601", 5), ("3", "20220629", 5)]
    assert sorted((r["reason"], r["eventid"]) for r in dedup.side_rows(spark, out).collect()) == [("late", "2"), ("undated", "stray")]
    assert len(kept_aside) == len(arrivals) and {name for names in kept_aside for name in names} <= {"candidates"}


def test_arrivals_are_written_in_one_pass(spark, tmp_path, monkeypatch):
    from searchtide.registry import queries

    passes = []
    monkeypatch.setattr(queries, "write_raw", lambda rows, root: (passes.append(root), write_raw(rows, root)))
    monkeypatch.setattr(queries, "_scratch", lambda session, name: str(tmp_path / "base"))
    queries.stream_dedup(spark, SMALL)
    assert len(passes) == 1
    landed = read_raw(spark, str(tmp_path / "base" / "landing"))
    expected = queries.raw_events(spark, SMALL)
    stray = "cast(eventid as bigint) % 250 = 7"
    expected = expected.withColumn("dt", F.expr(f"if({stray}, '', dt)"))
    assert landed.exceptAll(expected).isEmpty() and expected.exceptAll(landed).isEmpty()


def test_ledger_answers_alike_however_its_filters_travel(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "table")
    known = spark.createDataFrame([(f"+{i}", datetime(2022, 6, 1), "20220601", 1) for i in range(3000)], ledger.ENTRY)
    added = ledger.add(known, versions.new_commit(root))
    version = versions.publish(spark, root, versions.Version(), added)
    # asked for more than once, as in a batch with copies
    asked = spark.range(2500, 6000).selectExpr("'+' || id as id_key").crossJoin(spark.range(2)).select("id_key")
    answers = []
    for sent in (ledger._SENT_BYTES, 0):
        monkeypatch.setattr(ledger, "_SENT_BYTES", sent)
        found = ledger.candidates(spark, root, version, asked)
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert ("strategy=broadcast" in plan) == (sent > 0)
        answers.append({r["id_key"] for r in found.collect()})
        entries, _ = ledger.known(spark, root, version, asked, str(tmp_path / f"work{sent}"))
        assert sorted(r["id_key"] for r in entries.collect()) == sorted(f"+{i}" for i in range(2500, 3000))
    assert answers[0] == answers[1] and {f"+{i}" for i in range(2500, 3000)} <= answers[0]


# --- versions and new files -----------------------------------------------------------------


def test_of_two_writers_one_wins(spark, tmp_path):
    """Both start from the same version: other folders go together, the same folder does not, and nothing is half visible."""
    out = str(tmp_path / "table")

    def prepared(*rows):
        from searchtide.plans.curate import prepared_events, usable_events

        return prepared_events(usable_events(raw_table(spark, *rows)))

    base = commit_curated(prepared(raw_row("1"), raw_row("2", dt="20220602")), out, "first")
    commit_curated(prepared(raw_row("3")), out, "second", base=base)
    commit_curated(prepared(raw_row("4", dt="20220602")), out, "third", base=base)
    assert {r["event_id"]: r["_pipeline_run_id"] for r in read_curated(spark, out).collect()} == {"3": "second", "4": "third"}
    with pytest.raises(versions.Conflict):
        commit_curated(prepared(raw_row("5"), raw_row("6", dt="20220609")), out, "loser", base=base)
    assert {r["event_id"] for r in read_curated(spark, out).collect()} == {"3", "4"}
    assert newest_day(spark, out) == date(2022, 6, 2) and newest_day(spark, str(tmp_path / "none")) is None
    # a reader at work on an older version still finds it
    assert versions.read(spark, out, CURATED, base).count() == 2
    gone = versions.vacuum(spark, out, keep=1)
    assert len(gone) == 1 and read_curated(spark, out).count() == 2


def test_versions_under_threads(spark, tmp_path):
    root = str(tmp_path)

    def write(k):
        base = versions.Version()
        return versions.publish(spark, root, base, {f"part={k}": (f"commit={k}",)}, f"run-{k}").number

    with ThreadPoolExecutor(8) as pool:
        assert sorted(pool.map(write, range(8))) == list(range(1, 9))
    newest = versions.current(spark, root)
    assert newest.number == 8 and set(newest.parts) == {f"part={k}" for k in range(8)}
    assert versions.runs(spark, root) == {f"run-{k}" for k in range(8)}

    def same_part(k):
        try:
            return versions.publish(spark, root, newest, {"part=x": (f"commit={k}",)}, str(k)).run
        except versions.Conflict:
            return None

    with ThreadPoolExecutor(8) as pool:
        winners = [w for w in pool.map(same_part, range(8)) if w]
    assert len(winners) == 1 and versions.current(spark, root).run == winners[0]
    assert not [p for p in Path(root, "versions").iterdir() if "json-" in p.name]


def test_late_files_are_found(spark, tmp_path):
    root, out = str(tmp_path / "landing"), str(tmp_path / "out")
    days = [raw_row(str(d), f"2022-06-0{d} 05:00:00.000", dt=f"2022060{d}") for d in range(1, 10)]
    write_raw(raw_table(spark, *days), f"{root}/a")
    assert tuple(run_new_files(spark, root, out, run_id="1").first())[1:] == (9, 0, 9, 9)
    assert tuple(run_new_files(spark, root, out, run_id="2").first())[1:] == (0, 0, 0, 0)
    late = raw_row("late", "2022-06-01 05:00:30.000", keyword="naruto", dt="20220601")
    write_raw(raw_table(spark, late), f"{root}/b")
    assert tuple(run_new_files(spark, root, out, run_id="3").first())[1:] == (1, 0, 1, 3)
    assert same(read_curated(spark, out), curated(raw_table(spark, *days, late)))
    # only days within reach were written again
    assert {r["dt"] for r in read_curated(spark, out).where("_pipeline_run_id = '3'").collect()} == {"2022-06-01", "2022-06-02"}
    shutil.rmtree(tmp_path / "landing" / "b")
    shutil.rmtree(tmp_path / "landing" / "a" / "20220609")
    raw_table(spark, raw_row("stray")).drop("dt").coalesce(1).write.parquet(f"{root}/stray")
    assert tuple(run_new_files(spark, root, out, run_id="4").first())[1:4] == (1, 2, 3)
    found = {(r["event_id"], r["dt"]) for r in read_curated(spark, out).collect()}
    assert found == {(str(d), f"2022-06-0{d}") for d in range(1, 9)} | {("stray", None)}


# --- keyword table --------------------------------------------------------------------------


def reply_pairs(spark, *texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "batch_id int, reply string")
    parsed = ops.reply_entries(frame)
    failed = {r["batch_id"] for r in parsed.where("failed").collect()}
    pairs = {(r["batch_id"], r["name"]): r["answer"] for r in ops.verdict_pairs(parsed).collect()}
    return failed, pairs


def test_replies(spark):
    failed, pairs = reply_pairs(
        spark, '```json\n{"a b": "NHAC"}\n```', '{"NHAC": "song", "ANIME": "film", "x": "NHAC"}', '{"a": "NHAC"} and more',
        "no json", None, "{}", "[1]", '{"a": "NHAC", "a": "ANIME"}', "{'a': 'NHAC'}", '{"NHAC": "s1", "nhac": "s2"}',
        '{"a": 1, "b": null}', '{"a": "NHAC"}, {"b": "NHAC"}')
    assert failed == {2, 3, 4, 6, 8, 11}
    assert pairs == {
        (0, "a b"): "NHAC", (1, "song"): "NHAC", (1, "film"): "ANIME", (1, "NHAC"): "x",
        (7, "a"): "ANIME", (9, "s1"): "NHAC", (9, "s2"): "nhac", (10, "a"): "1", (10, "b"): None}


def test_exactly_half_codes_is_not_inverted(spark):
    _, pairs = reply_pairs(spark, '{"NHAC": "NHAC", "song": "ANIME"}')
    assert pairs == {(0, "NHAC"): "NHAC", (0, "song"): "ANIME"}


def test_verdicts_reach_the_original_keyword(spark):
    batched = spark.createDataFrame(
        [(0, 1, "a\\b"), (0, 2, "a b"), (0, 3, "c"), (1, 4, "other")], "batch_id int, rank int, keyword string")
    assert {r["keyword"]: r["clean"] for r in ops.sanitized(batched).collect()} == {"a\\b": "a b", "c": "c", "other": "other"}
    pairs = spark.createDataFrame(
        [(0, 0, "a b", "NHAC"), (0, 1, "c", "nonsense"), (0, 2, "other", "NHAC"), (0, 3, "c", "KDRAMA"), (0, 4, "c", "UNKNOWN")],
        "batch_id int, pos int, name string, answer string")
    verdicts = ops.applied_verdicts(pairs, batched)
    assert {(r["keyword"], r["genre"]) for r in verdicts.collect()} == {("a\\b", "NHAC"), ("c", "PHIM_HAN")}
    failed = spark.createDataFrame([(1,)], "batch_id int")
    assert [r["keyword"] for r in ops.unresolved(batched, verdicts, failed).collect()] == ["a b"]


def unknown_rows(spark, counts):
    rows = [(k, "UNKNOWN") for k, n in counts.items() for _ in range(n)] + [("known", "NHAC"), (None, "UNKNOWN")]
    return spark.createDataFrame(rows, "keyword_norm string, derived_genre string")


class Scripted:
    """Answers by table; fails on batches with a marked keyword."""

    def __call__(self, keywords):
        if any(k.startswith("boom") for k in keywords):
            raise RuntimeError("throttled")
        return json.dumps({k: "NHAC" if k.startswith("song") else "UNKNOWN" for k in keywords})


def test_refresh(spark, tmp_path):
    store = str(tmp_path / "store")
    lut_store.save(spark, store, spark.createDataFrame([("old", "ANIME")], "keyword string, genre string"))
    rows = unknown_rows(spark, {"old": 9, "song 1": 8, "noise": 7, "boom": 6, "song 2": 5, "ab": 4, "": 3, "tìm kiếm bằng giọng nói": 2})
    summary = refresh_lut(spark, rows, store, Scripted(), RefreshLimits(batch_size=2)).first()
    assert tuple(summary) == (1, 2, 3, 1, "refreshed")
    lut, resolved = lut_store.load(spark, store)
    assert {tuple(r) for r in lut.collect()} == {("old", "ANIME"), ("song 1", "NHAC")}
    known = {r["keyword"] for r in resolved.collect()}
    assert known == {"noise", "ab", "tìm kiếm bằng giọng nói"}
    assert lut.join(resolved, "keyword").count() == 0
    # the failed batch is asked about again, the rest is not
    again = refresh_lut(spark, rows, store, OfflineClassifier((("NHAC", "boom|song"),))).first()
    assert tuple(again) == (2, 4, 3, 0, "refreshed")
    assert refresh_lut(spark, rows, store, Scripted()).first()["message"] == "up-to-date"


def test_refresh_limits(spark):
    rows = unknown_rows(spark, {f"keyword {i:02d}": i + 1 for i in range(10)})
    mined = ops.unknown_keywords(rows)
    assert [r["cnt"] for r in mined.orderBy(F.desc("cnt")).collect()] == [10, 9, 8, 7, 6, 5, 4, 3, 2, 1]
    batched = ops.batches(mined, max_new=3, size=2).orderBy("rank").collect()
    assert [(r["batch_id"], r["keyword"]) for r in batched] == [(0, "keyword 09"), (0, "keyword 08"), (1, "keyword 07")]


def test_known_keywords_do_not_use_up_the_budget(spark):
    rows = unknown_rows(spark, {f"keyword {i:02d}": i + 1 for i in range(10)})
    known = spark.createDataFrame([(f"keyword {i:02d}",) for i in range(3, 10)], "keyword string")
    left = ops.candidates(ops.unknown_keywords(rows), known.limit(4), known)
    assert [r["keyword"] for r in ops.batches(left, max_new=2).orderBy("rank").collect()] == ["keyword 02", "keyword 01"]


def test_batches_are_asked_in_several_tasks(spark):
    batched = spark.createDataFrame([(i, i, f"k{i}") for i in range(60)], "batch_id int, rank int, keyword string")
    asked = replies(batched, lambda words: words[0], callers=8)
    assert asked.select(F.spark_partition_id()).distinct().count() > 4 and asked.count() == 60


def test_classifier_sees_clean_words_in_order(spark):
    batched = spark.createDataFrame([(0, 2, "b\tb"), (0, 1, "a"), (1, 3, "c")], "batch_id int, rank int, keyword string")
    got = {r["batch_id"]: r["reply"] for r in replies(batched, lambda words: "/".join(words)).collect()}
    assert got == {0: "a/b b", 1: "c"}


def test_store_keeps_versions(spark, tmp_path):
    store = str(tmp_path)
    lut, resolved = lut_store.load(spark, store)
    assert lut.count() == resolved.count() == 0
    one = spark.createDataFrame([("a", "NHAC")], "keyword string, genre string")
    assert lut_store.save(spark, store, one) == 1
    lut, resolved = lut_store.load(spark, store)
    assert (lut.count(), resolved.count()) == (1, 0)
    # files that were never listed are not read
    one.write.parquet(f"{store}/data/commit=lost/lut")
    base = lut_store.current(spark, store)
    assert lut_store.load(spark, store)[0].count() == 1
    both = spark.createDataFrame([("a",), ("b",)], "keyword string")
    assert lut_store.save(spark, store, lut.unionByName(one), both) == 2
    lut, resolved = lut_store.load(spark, store)
    # what has a genre is not resolved as well
    assert lut.count() == 1 and [r["keyword"] for r in resolved.collect()] == ["b"]
    # a writer that started from version 1 has not seen version 2
    with pytest.raises(versions.Conflict):
        lut_store.save(spark, store, spark.createDataFrame([("b", "NHAC")], "keyword string, genre string"), base=base)
    assert lut_store.save(spark, store, spark.createDataFrame([("b", "NHAC")], "keyword string, genre string")) == 3
    assert lut_store.load(spark, store)[1].count() == 0


# --- quality and access ---------------------------------------------------------------------


def test_rules(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, None)], "s string, n int")
    rules = [quality.listed("s", ["a", "b"]), quality.listed("s", ["a", "b"], 0.75), quality.at_most("n", 3),
             quality.at_most("n", 2.5), quality.unique("s", 0.25), quality.unique("s", 0.2), quality.unique("n", 0.7)]
    results = quality.evaluate(rows, rules, run_date=date(2022, 6, 1))
    got = results.collect()
    assert [r["outcome"] for r in got] == ["Failed", "Passed", "Passed", "Failed", "Failed", "Passed", "Passed"]
    assert got[0]["rule"] == 'ColumnValues "s" in ["a","b"]' and got[1]["rule"].endswith("with threshold >= 0.75")
    assert got[0]["failure_reason"] == "Values of s in the list: 0.75" and got[1]["failure_reason"] is None
    assert json.loads(got[3]["evaluated_metrics"]) == {"Column.n.Maximum": 3.0}
    assert tuple(quality.gate(results).first()) == (7, 4, 0.5714, True)
    assert quality.gate(results, 0.6).first()["proceed"] is False
    assert quality.outcome_counts(results).first().asDict() == {"outcome": "Passed", "rules": 4}
    empty = quality.evaluate(rows.limit(0), rules).collect()
    assert [r["outcome"] for r in empty] == ["Failed", "Failed", "Passed", "Passed", "Failed", "Failed", "Failed"]


def test_recommended_rules_hold(curated_rows):
    columns = ["derived_genre", "platform_group", "subscription_count", "has_premium", "keyword_norm"]
    rules = quality.recommend(curated_rows, columns, ["event_id"])
    assert {r["outcome"] for r in quality.evaluate(curated_rows, rules).collect()} == {"Passed"}
    kinds = {(r.kind, r.column) for r in rules}
    assert {("listed", "derived_genre"), ("at_most", "subscription_count"), ("unique", "event_id")} <= kinds
    assert quality.recommend(curated_rows, columns, existing=rules[:1]) == rules[:1]


def test_results_on_disk(spark, tmp_path):
    rows = spark.createDataFrame([("a",)], "s string")
    for day in (date(2022, 6, 1), date(2022, 6, 2)):
        results = quality.evaluate(rows, [quality.listed("s", ["b"])], run_date=day, run_id=str(day))
        quality_results.write_results(results, str(tmp_path))
    assert "evaluatedMetrics" in next(tmp_path.rglob("run_date=2022-06-01/*.json")).read_text()
    back = quality_results.read_results(spark, str(tmp_path))
    assert {(r["dq_run_id"], r["run_date"]) for r in back.collect()} == {
        ("2022-06-01", date(2022, 6, 1)), ("2022-06-02", date(2022, 6, 2))}
    assert quality.failing_rules(back).first()["occurrences"] == 2


def test_roles(spark, curated_rows):
    view = spark.table(access.create_role_view(curated_rows, "lut_refresh"))
    assert set(curated_rows.columns) - set(view.columns) == {
        "user_id_hashed", "search_session_id", "has_premium", "subscription_count"}
    views = {role: access.create_role_view(curated_rows, role) for role in ("lut_refresh", "reports")}
    assert all(r["ok"] for r in contracts.access_checks(curated_rows, views).collect())
    assert not access.exclusion_matches(curated_rows, views["reports"], "lut_refresh")
    with pytest.raises(ValueError):
        access.visible_to(curated_rows, "stranger")
