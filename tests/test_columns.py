"""Edge rows of the column expressions."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from searchtide import vocab
from searchtide.functions import identity, moments, shares, subscriptions, text
from searchtide.operators.classify import pattern_genre
from searchtide.operators.lut import is_classifiable, normalized_genre


def values(spark, rows, schema, *columns):
    frame = spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema)
    return [tuple(r) if len(columns) > 1 else r[0] for r in frame.select(*columns).collect()]


def test_datetime_repair(spark):
    cases = {
        "2022-06-01 05:00:00.1": "2022-06-01 05:00:00.100",
        "2022-06-01 5:00:00": "2022-06-01 05:00:00.000",
        "  2022-06-01 \t 5:00:00.7\n": "2022-06-01 05:00:00.700",
        "2565-06-01 05:00:00.123456": "2022-06-01 05:00:00.123",
        "2566-06-01 05:00:00": "2566-06-01 05:00:00.000",
        "٢٠٢٢-٠٦-٠١ ٠٥:٠٠:٠٠": "2022-06-01 05:00:00.000",
        "۲۰۲۲-۰۶-۰۱ ۰۵:۰۰:۰۰": "2022-06-01 05:00:00.000",
        "٢٥٦٥-٠٦-٠١ ٠٥:٠٠:٠٠": "2022-06-01 05:00:00.000",
        "2022-06-01 05:00:00.5 +07": "2022-06-01 05:00:00.500",
        "2022-13-01 00:00:00": "2022-13-01 00:00:00.000",
        "0004-01-01 00:00:00.000": "0004-01-01 00:00:00.000",
        "2022-06-01 05:00:00.9999": "2022-06-01 05:00:00.999",
        "2022-06-01 005:00:00": None,
        "bad": None, "": None, None: None,
    }
    assert values(spark, list(cases), "s string", moments.repaired_datetime(F.col("s"))) == list(cases.values())


def test_event_moment_agrees_with_repaired_text(spark):
    texts = ["2022-06-01 05:00:00.100", "2022-06-01 05:00:00.1", "2565-06-01 05:00:00.123", "2022-13-01 00:00:00",
             "2022-06-01 24:00:00", "2022-02-30 01:00:00", "bad", None, "2022-06-01 05:00:00.999999"]
    shown = F.date_format(moments.event_moment(F.col("s")), "yyyy-MM-dd HH:mm:ss.SSS")
    assert values(spark, texts, "s string", shown) == [
        "2022-06-01 05:00:00.100", "2022-06-01 05:00:00.100", "2022-06-01 05:00:00.123", None, None, None, None, None,
        "2022-06-01 05:00:00.999"]


def test_local_hour_and_slot(spark):
    rows = ["2022-06-01 05:00:00", "2022-06-01 17:00:00", "2022-06-01 00:29:59", "2022-06-01 00:30:00"]
    moment = F.col("s").cast("timestamp")
    got = values(spark, rows, "s string", moments.local_hour(moment), moments.session_slot(moment))
    assert [h for h, _ in got] == [12, 0, 7, 7]
    assert int(got[3][1]) == int(got[2][1]) + 1


def test_iso_day(spark):
    assert values(spark, ["20220601", "", "2022-06-01", None], "s string", moments.iso_day(F.col("s"))) == [
        "2022-06-01", "", "2022-06-01", None]


def test_action_and_identity(spark):
    got = values(spark, ["quit", "enter", "click", None], "c string",
                 identity.session_action(F.col("c")), identity.is_abandoned(F.col("c")))
    assert got == [("ABANDON", True), ("SUBMIT", False), ("CLICK", False), (None, None)]
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert values(spark, [None, ""], "u string", identity.hashed(F.col("u"))) == [None, empty]


def test_keyword_and_genre(spark):
    cases = {
        None: (None, None), "  ": ("", None), " Naruto ": ("naruto", "ANIME"), "bong da": ("bong da", "THE_THAO"),
        "bóng đá": ("bóng đá", None), "zzz": ("zzz", None), "\ttab": ("\ttab", None),
        # an accented letter is part of the word, so "mv" does not stand alone here
        "mvà": ("mvà", None), "đmv": ("đmv", None), "mv-2": ("mv-2", "NHAC"), "mv_2": ("mv_2", None),
        "phim-han hay": ("phim-han hay", "PHIM_HAN"), "phim au my": ("phim au my", "PHIM_AU_MY"),
        # the first pattern in the list wins
        "karaoke anime": ("karaoke anime", "ANIME"),
    }
    keyword = text.normalize_keyword(F.col("k"))
    assert values(spark, list(cases), "k string", keyword, pattern_genre(keyword)) == list(cases.values())


def test_groups(spark):
    platform = text.grouped(F.col("p"), vocab.PLATFORM_GROUPS, vocab.OTHER_PLATFORM)
    assert values(spark, ["Samsung", " ios", None, ""], "p string", platform) == ["TV", "Other", "Other", "Other"]
    network = text.grouped(F.col("p"), vocab.NETWORK_GROUPS, vocab.OTHER_NETWORK)
    assert values(spark, ["5G", "ethernet", None], "p string", network) == ["mobile", "unknown", "unknown"]


def test_plans(spark):
    cases = [
        (None, (False, None, None)), ([], (False, 0, [])), (["VIP:30"], (True, 1, ["VIP"])),
        (["vip"], (False, 1, ["vip"])), ([" K+ :7"], (True, 1, ["K+"])), (["x", None], (False, 2, ["x", "None"])),
        ([" MAX\t"], (True, 1, ["MAX"])),
    ]
    plans = F.col("p")
    got = values(spark, [(p,) for p, _ in cases], "p array<string>",
                 subscriptions.has_premium(plans, vocab.PREMIUM_PLANS), subscriptions.plan_count(plans),
                 subscriptions.plan_names(plans))
    assert got == [expected for _, expected in cases]


def test_session_text(spark):
    rows = [("u", None, None), (None, "isp", "web"), (None, None, "web"), (None, "isp", None), ("", None, None)]
    key = identity.session_text(F.col("u"), F.col("i"), F.col("p"), F.timestamp_seconds(F.lit(1800)))
    assert values(spark, rows, "u string, i string, p string", key) == ["u|1", "isp|web|1", None, None, "|1"]


@pytest.mark.parametrize("part,whole,rate,growth", [(201, 200, 100.5, 1.01), (1, 3, 33.3, 0.33), (1, 0, None, None), (0, 7, 0.0, 0.0)])
def test_rounding(spark, part, whole, rate, growth):
    got = values(spark, [(part, whole)], "n bigint, d bigint",
                 shares.percent(F.col("n"), F.col("d")), shares.multiple(F.col("n"), F.col("d")))
    assert got == [(rate, growth)]


def test_classifiable_and_normalized(spark):
    words = ["ab", "", " ab ", "tìm kiếm bằng giọng nói", "abc", None]
    assert values(spark, words, "k string", is_classifiable(F.col("k"))) == [False, False, False, False, True, None]
    answers = ["kdrama", " NHAC ", "nonsense", None, "EMPTY_QUERY", "show"]
    assert values(spark, answers, "a string", normalized_genre(F.col("a"))) == [
        "PHIM_HAN", "NHAC", "UNKNOWN", "UNKNOWN", "UNKNOWN", "TRUYEN_HINH"]
