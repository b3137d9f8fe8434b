"""Registered queries: each operator run on the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from searchtide.functions.moments import event_moment, repaired_datetime
from searchtide.functions.text import normalize_keyword
from searchtide.operators import access, classify, contracts, lut as lut_ops, quality
from searchtide.operators.dedup import keep_first_event
from searchtide.operators.lineage import lineage_counts
from searchtide.plans import report_pack, reports, rollup, trending
from searchtide.plans.curate import curated, marked_events, prepared_events, usable_events, with_genre
from searchtide.plans.curation_job import run_new_files
from searchtide.plans.lut_refresh import OfflineClassifier, refresh_lut
from searchtide.plans.quality_job import run_quality
from searchtide.registry.settings import (
    ARRIVED_UNTIL, FILTER_GENRE, FILTER_TEXT, LOOKUP_DAY, LUT_WORDS, NEW_SINCE, PHRASES, QUALITY_RULES, RESOLVED_WORD, RUN_ID,
    SINCE, TREND, VERDICT_WORDS,
)
from searchtide.schemas import RAW
from searchtide.session import require_settings, shared_folder
from searchtide.sources import folders, lut_store, quality_results
from searchtide.sources.curated import commit_curated, partition, read_curated, write_curated
from searchtide.sources.raw import parse_since, read_raw, write_raw
from searchtide.sources.testtables import TEST_RULES, raw_events, table
from searchtide.streaming import dedup
from searchtide.streaming.ingest import ingest, raw_stream, side_counts

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(run: Query) -> Query:
    def prepared(spark: SparkSession, folder: str) -> DataFrame:
        return run(require_settings(spark), folder)

    _QUERIES[run.__name__] = prepared
    return prepared


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared inputs --------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A new folder of its own for a query that writes."""
    return f"{shared_folder(spark)}/searchtide/{name}-{uuid.uuid4().hex}"


def _curated(spark: SparkSession, folder: str, repeats: bool = False) -> DataFrame:
    """Curated rows; the repeat flag only where a query reads it."""
    return curated(raw_events(spark, folder), rules=TEST_RULES, run_id=RUN_ID, repeats=repeats)


def _stored(spark: SparkSession, folder: str, name: str, repeats: bool = True) -> DataFrame:
    """Curated rows from a table on disk, for jobs that read the curated table several times."""
    path = _scratch(spark, name)
    prepared = prepared_events(usable_events(raw_events(spark, folder)), rules=TEST_RULES, repeats=repeats)
    write_curated(prepared, path, RUN_ID, TEST_RULES)
    return read_curated(spark, path)


def _portable(rows: DataFrame) -> DataFrame:
    """Times and arrays as text, so that any engine's result can be compared."""
    shown = {"event_ts": F.date_format("event_ts", "yyyy-MM-dd HH:mm:ss.SSS")}
    for name, kind in rows.dtypes:
        if kind == "array<string>":
            shown[name] = F.array_join(name, ",")
    return rows.select(*[shown.get(c, F.col(c)).alias(c) for c in rows.columns])


def _by_last_word(name, pairs, otherwise=None):
    last = F.substring_index(name, " ", -1)
    return reduce(lambda chain, pair: chain.when(last == pair[0], pair[1]), pairs[1:], F.when(
        last == pairs[0][0], pairs[0][1])).otherwise(otherwise)


def _part_names(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(F.col("p_name").alias("keyword")).distinct()


def _lut(spark: SparkSession, folder: str) -> DataFrame:
    named = _part_names(spark, folder).withColumn("genre", _by_last_word(F.col("keyword"), LUT_WORDS))
    return named.where(F.col("genre").isNotNull())


def _resolved(spark: SparkSession, folder: str) -> DataFrame:
    return _part_names(spark, folder).where(F.substring_index("keyword", " ", -1) == RESOLVED_WORD)


# --- sources and sinks ----------------------------------------------------------------------


def _landing(spark: SparkSession, folder: str, name: str) -> str:
    root = _scratch(spark, name)
    write_raw(raw_events(spark, folder), root)
    return root


@_query
def src_raw_scan(spark, folder):
    rows = read_raw(spark, _landing(spark, folder, "scan"))
    return rows.withColumn("userplansmap", F.array_join("userplansmap", ","))


@_query
def src_path_dt(spark, folder):
    return read_raw(spark, _landing(spark, folder, "path")).groupBy("dt").agg(F.count(F.lit(1)).alias("rows"))


@_query
def src_incremental(spark, folder):
    return read_raw(spark, _landing(spark, folder, "since"), parse_since(f"dt >= {SINCE}")).select("eventid", "dt")


@_query
def raw_action_distinct(spark, folder):
    # every seventh event with an action of its own, some without one
    e = F.col("eventid").cast("long")
    action = F.when(e % 7 == 0, F.concat(F.lit("open "), F.col("platform"))).otherwise(F.col("action"))
    return contracts.raw_actions(raw_events(spark, folder).withColumn("action", action))


@_query
def sink_curated_roundtrip(spark, folder):
    return _portable(_stored(spark, folder, "curated"))


@_query
def curated_partition_lookup(spark, folder):
    rows = partition(_stored(spark, folder, "lookup", repeats=False), LOOKUP_DAY, "PHIM_HAN")
    return rows.groupBy("derived_genre").agg(F.count(F.lit(1)).alias("rows"))


@_query
def lut_roundtrip(spark, folder):
    store = _scratch(spark, "lut")
    lut_store.save(spark, store, _lut(spark, folder), _resolved(spark, folder))
    lut, resolved = lut_store.load(spark, store)
    return lut.unionByName(resolved.withColumn("genre", F.lit("resolved")))


# --- enrichment -----------------------------------------------------------------------------


@_query
def enrich_datetime(spark, folder):
    text = F.col("datetime")
    return _portable(raw_events(spark, folder).select(
        "eventid", "dt", repaired_datetime(text).alias("datetime_clean"), event_moment(text).alias("event_ts")))


@_query
def filter_corrupt_year(spark, folder):
    return usable_events(raw_events(spark, folder)).select("eventid", "dt")


@_query
def dedup_events(spark, folder):
    return _portable(keep_first_event(usable_events(raw_events(spark, folder))).select(
        "eventid", "dt", "event_ts", "keyword"))


def _columns_query(name: str, *columns: str, repeats: bool = False) -> None:
    def run(spark, folder):
        shown = _curated(spark, folder, repeats).select("event_id", *columns)
        return _portable(shown) if "plan_names" in columns else shown

    run.__name__ = name
    _query(run)


_columns_query("enrich_local_hour", "hour_of_day_vn")
_columns_query("enrich_action", "session_action", "is_search_abandoned")
_columns_query("enrich_identity", "user_is_authenticated", "user_id_hashed")
_columns_query("enrich_keyword", "keyword_norm")
_columns_query("enrich_genre", "keyword_norm", "derived_genre")
_columns_query("enrich_platform", "platform_group")
_columns_query("enrich_network", "network_type_norm", "isp_segment")
_columns_query("enrich_plans", "has_premium", "subscription_count", "plan_names")
_columns_query("enrich_session_id", "search_session_id")
_columns_query("enrich_repeat_search", "is_repeat_search", repeats=True)


def _curated_query(spark, folder):
    return _portable(_curated(spark, folder, repeats=True))


_curated_query.__name__ = "curated"
_query(_curated_query)


@_query
def genre_lut_lookup(spark, folder):
    rows = _curated(spark, folder).select("event_id", "keyword_norm")
    return classify.lut_genre(rows, _lut(spark, folder)).select("event_id", "keyword_norm", "lut_genre")


@_query
def genre_waterfall(spark, folder):
    rows = _curated(spark, folder).select("event_id", "keyword_norm")
    return classify.classify(rows, _lut(spark, folder), TEST_RULES.patterns).select("event_id", "derived_genre")


@_query
def genre_regex(spark, folder):
    """Part names with a phrase that a pattern knows, or nearly knows, before, behind or in place of them."""
    phrase = F.element_at(F.array(*map(F.lit, PHRASES)), (F.col("p_partkey") % len(PHRASES) + 1).cast("int"))
    keyword = F.when(F.col("p_size") % 3 == 0, phrase).when(F.col("p_size") % 3 == 1, F.concat(phrase, F.lit(" "), "p_name")).otherwise(
        F.concat("p_name", F.lit(" "), phrase))
    return table(spark, folder, "part").select("p_partkey", classify.pattern_genre(normalize_keyword(keyword)).alias("genre"))


@_query
def genre_fuzzy(spark, folder):
    # part names that lost their first letter
    near = _part_names(spark, folder).select(
        F.expr("substring(keyword, 2)").alias("keyword"), F.lit("PHIM_TRUNG").alias("genre"))
    return classify.near_genre(_curated(spark, folder), near)


def _misspelt(spark: SparkSession, folder: str) -> DataFrame:
    """Part names with one letter taken out and one other changed."""
    return _part_names(spark, folder).select(
        F.expr("'z' || substring(keyword, 2, 3) || substring(keyword, 6)").alias("keyword"), F.lit("PHIM_TRUNG").alias("genre"))


@_query
def genre_fuzzy_two_edits(spark, folder):
    return classify.near_genre(_curated(spark, folder), _misspelt(spark, folder), edits=2)


@_query
def genre_waterfall_near(spark, folder):
    """All stages: exact, patterns, near spellings of up to two edits."""
    rows = _curated(spark, folder).select("event_id", "keyword_norm")
    entries = _lut(spark, folder).unionByName(_misspelt(spark, folder))
    found = classify.classify(rows, entries, TEST_RULES.patterns, near=True, near_edits=2)
    return found.select("event_id", "derived_genre")


# --- reports --------------------------------------------------------------------------------


def _report(name: str, report: Callable[[DataFrame], DataFrame], repeats: bool = False) -> None:
    def run(spark, folder):
        return report(_curated(spark, folder, repeats))

    run.__name__ = name
    _query(run)


_report("report_dt_window", reports.dt_window)
_report("report_window_caption", reports.window_caption)
_report("report_totals", reports.totals)
_report("report_platform", reports.by_platform)
_report("report_genre", reports.by_genre)
_report("report_top_keywords", reports.top_keywords)
_report("report_content_gaps", reports.content_gaps)
_report("report_premium_share", reports.premium_share)
_report("report_repeat_share", reports.repeat_share, repeats=True)
_report("report_guest_share", reports.guest_share)
_report("report_hour_genre", reports.hour_genre)
_report("report_hour_matrix", reports.hour_matrix)
_report("report_latest_dt", reports.latest_day)
_report("report_by_hour", reports.by_hour)
_report("report_auth_mix", reports.sign_in_mix)
_report("report_abandon_by_genre", reports.abandon_by_genre)
_report("report_premium_known", reports.premium_of_known)
_report("report_top_known", reports.top_known_keywords)
_report("report_classifier_coverage", reports.classifier_coverage)
_report("report_genre_distribution", reports.genre_distribution)
_report("rollup_keyword", reports.keyword_rollup)


_report("report_missing_days", reports.missing_days)


@_query
def report_filter(spark, folder):
    return reports.filter_report(reports.content_gaps(_curated(spark, folder)), FILTER_TEXT, FILTER_GENRE)


@_query
def rollup_keyword_reports(spark, folder):
    """Top keywords served from rollups of separate days instead of from the events."""
    rows = _curated(spark, folder)
    early, late = rows.where(F.col("dt") < SINCE), rows.where(F.col("dt") >= SINCE)
    merged = reports.merged_rollups(reports.keyword_rollup(early), reports.keyword_rollup(late))
    return reports.top_keywords(reports.rollup_as_tally(merged))


def _windows(rows: DataFrame) -> trending.TrendWindows:
    return trending.TrendWindows.before(trending.reference_day(rows), TREND)


@_query
def report_trending(spark, folder):
    """Some searches of the last days ask for a keyword nobody asked for before."""
    rows = _stored(spark, folder, "trending", repeats=False)
    is_new = (F.col("dt") >= NEW_SINCE) & (F.col("event_id").cast("long") % 3 == 0) & (F.col("keyword_norm") != "")
    word = F.when(is_new, F.concat("keyword_norm", F.lit(" again"))).otherwise(F.col("keyword_norm"))
    report, _ = trending.trending(rows.withColumn("keyword_norm", word), rules=TREND)
    return report


@_query
def report_trending_fallback(spark, folder):
    rows = _stored(spark, folder, "volume", repeats=False)
    return trending.volume(rows, _windows(rows), TREND)


def _as_text(rows: DataFrame, section: str) -> DataFrame:
    """Rows of a section, each as one text."""
    def shown(name: str, kind: str) -> Column:
        text = F.col(name).cast("decimal(20,2)") if kind == "double" else F.col(name)
        return F.coalesce(text.cast("string"), F.lit("-"))

    return rows.select(F.lit(section).alias("section"), F.concat_ws("|", *[shown(c, k) for c, k in rows.dtypes]).alias("row"))


@_query
def report_pack_sections(spark, folder):
    """The contents of all sections."""
    out = _scratch(spark, "pack")
    outcome = report_pack.report_pack(_stored(spark, folder, "pack-input"), out, uuid.uuid4().hex)
    written = []
    for name, error in outcome.items():
        rows = spark.read.parquet(f"{out}/section={name}")
        caption = rows.select("coverage").first()["coverage"]
        written.append(_as_text(rows.drop("coverage"), name).withColumns(
            {"coverage": F.lit(caption), "status": F.lit("complete" if error is None else error)}))
    return reduce(DataFrame.unionByName, written)


_QUERIES["report_pack"] = _QUERIES.pop("report_pack_sections")


@_query
def report_refresh_summary(spark, folder):
    rows = _stored(spark, folder, "refresh-input")
    return report_pack.refresh(rows, _scratch(spark, "refresh"), uuid.uuid4().hex, rules=TREND)


@_query
def report_trending_section(spark, folder):
    """The trending section of a refresh as it is written, with its own caption."""
    out = _scratch(spark, "refresh-section")
    report_pack.refresh(_stored(spark, folder, "refresh-rows", repeats=False), out, uuid.uuid4().hex, rules=TREND)
    return spark.read.parquet(f"{out}/section=trending")


# --- rollup ---------------------------------------------------------------------------------


def _rolled_up(spark: SparkSession, folder: str, name: str) -> tuple[str, list[str]]:
    """A rollup brought up to date after one day was curated again with a keyword table; and the days read for that."""
    base = _scratch(spark, name)
    table, root = f"{base}/curated", f"{base}/rollup"
    # what does not depend on the keyword table is worked out once, for both curations
    raw_events(spark, folder).write.parquet(f"{base}/raw")
    marked = marked_events(usable_events(spark.read.schema(RAW).parquet(f"{base}/raw")), TEST_RULES)
    marked.write.parquet(f"{base}/marked")
    marked = spark.read.schema(marked.schema).parquet(f"{base}/marked")
    commit_curated(with_genre(marked, rules=TEST_RULES), table, RUN_ID, TEST_RULES)
    rollup.refresh_rollup(spark, table, root)
    again = with_genre(marked.where(F.col("dt") == LOOKUP_DAY.replace("-", "")), _lut(spark, folder), TEST_RULES)
    commit_curated(again, table, RUN_ID, TEST_RULES)
    return root, rollup.refresh_rollup(spark, table, root)


@_query
def rollup_report_pack(spark, folder):
    """Every section answered from the rollup, not from the events."""
    root, days = _rolled_up(spark, folder, "rollup-pack")
    cells, keywords = rollup.read_rollup(spark, root, "cells"), rollup.read_rollup(spark, root, "keywords")
    written = [_as_text(section(cells, keywords), name) for name, section in report_pack.SECTIONS.items()]
    return reduce(DataFrame.unionByName, written).withColumn("days_read", F.lit(",".join(days)))


@_query
def rollup_trending(spark, folder):
    root, _ = _rolled_up(spark, folder, "rollup-trending")
    report, _ = trending.trending(rollup.read_rollup(spark, root, "keywords"), rules=TREND)
    return report


@_query
def rollup_distinct_keywords(spark, folder):
    """Distinct keywords of all days and of the days from a date on, exactly, and whether the sketches are within 2 %."""
    root, _ = _rolled_up(spark, folder, "rollup-distinct")
    windows = {"all": None, "recent": date.fromisoformat(SINCE)}
    found = []
    for name, first in windows.items():
        exact = reports.totals(rollup.read_rollup(spark, root, "keywords", first)).select(F.col("kw").alias("exact"))
        about = rollup.distinct_keywords(rollup.read_rollup(spark, root, "sketches", first))
        # one row each
        near = about.select(F.lit(name).alias("days"), F.col("kw").alias("about")).join(exact.select(F.lit(name).alias("days"), "exact"), "days")
        found.append(near.select("days", F.col("exact").alias("kw"), (F.abs(F.col("about") - F.col("exact")) * 50 <= F.col("exact")).alias("near")))
    return reduce(DataFrame.unionByName, found)


# --- keyword table --------------------------------------------------------------------------


@_query
def lut_unknown_keywords(spark, folder):
    return lut_ops.unknown_keywords(_curated(spark, folder))


def _candidates(spark: SparkSession, folder: str) -> DataFrame:
    unknown = lut_ops.unknown_keywords(_curated(spark, folder))
    return lut_ops.candidates(unknown, _lut(spark, folder), _resolved(spark, folder))


@_query
def lut_candidates(spark, folder):
    return _candidates(spark, folder)


@_query
def lut_classifiable(spark, folder):
    """Part names, some cut to a few letters, some spoken, some with blanks around them."""
    spoken = F.concat(F.repeat(F.lit(" "), (F.col("p_size") % 3).cast("int")), F.lit("tìm kiếm bằng giọng nói"), F.when(F.col("p_size") % 5 == 0, " lại").otherwise(""))
    keyword = F.when(F.col("p_partkey") % 4 == 0, F.expr("left(p_name, int(p_size % 5))")).when(F.col("p_partkey") % 4 == 1, spoken).when(
        F.col("p_partkey") % 4 == 2, F.expr("'  ' || left(p_name, int(p_size % 4)) || '  '")).otherwise(F.col("p_name"))
    return table(spark, folder, "part").select("p_partkey", lut_ops.is_classifiable(keyword).alias("classifiable"))


@_query
def lut_batches(spark, folder):
    return lut_ops.batches(_candidates(spark, folder), size=3)


def _brand(column="p_brand"):
    return F.expr(f"substring({column}, 7)").cast("int")


@_query
def lut_sanitize(spark, folder):
    """Part names with backslashes or tabs for blanks; one batch per brand."""
    blank = F.when(F.col("p_size") % 2 == 0, "\\").otherwise("\t")
    marked = table(spark, folder, "part").select(
        _brand().alias("batch_id"), F.concat(F.replace("p_name", F.lit(" "), blank), F.lit("\n")).alias("keyword")).distinct()
    rank = F.row_number().over(Window.partitionBy("batch_id").orderBy("keyword"))
    return lut_ops.sanitized(marked.select("batch_id", rank.alias("rank"), "keyword"))


def _brand_batches(spark: SparkSession, folder: str) -> DataFrame:
    """A batch per brand: the names of its parts."""
    names = table(spark, folder, "part").select(_brand().alias("batch_id"), F.col("p_name").alias("keyword")).distinct()
    rank = F.row_number().over(Window.partitionBy("batch_id").orderBy("keyword"))
    return names.select("batch_id", rank.alias("rank"), "keyword")


def _brand_replies(spark: SparkSession, folder: str) -> DataFrame:
    """A reply per brand, in the shapes classifiers produce: fenced, inverted, cut off."""
    answered = _brand_batches(spark, folder).withColumn(
        "answer", _by_last_word(F.col("keyword"), VERDICT_WORDS, "UNKNOWN"))
    # the codes as a classifier would spell them when it inverts the object
    key = F.when(F.col("batch_id") % 5 == 0, F.col("answer")).otherwise(F.col("keyword"))
    value = F.when(F.col("batch_id") % 5 == 0, F.col("keyword")).otherwise(F.col("answer"))
    lines = F.transform(
        F.array_sort(F.collect_list(F.struct("rank", key.alias("k"), value.alias("v")))),
        lambda p: F.concat(F.lit('"'), p["k"], F.lit('": "'), p["v"], F.lit('"')))
    body = F.concat(F.lit("{"), F.array_join(lines, ", "), F.when(F.col("batch_id") % 7 == 0, "").otherwise("}"))
    fenced = F.when(F.col("batch_id") % 2 == 0, body).otherwise(F.concat(F.lit("```json\n"), body, F.lit("\n```\n")))
    return answered.groupBy("batch_id").agg(fenced.alias("reply"))


def _pairs(spark: SparkSession, folder: str) -> DataFrame:
    return lut_ops.verdict_pairs(lut_ops.reply_entries(_brand_replies(spark, folder)))


@_query
def lut_parse_replies(spark, folder):
    return _pairs(spark, folder).select("batch_id", "name", "answer")


@_query
def lut_failed_replies(spark, folder):
    return lut_ops.reply_entries(_brand_replies(spark, folder)).select("batch_id", "failed")


@_query
def lut_normalize_genre(spark, folder):
    answer = _by_last_word(F.col("p_name"), VERDICT_WORDS, "no idea")
    answers = table(spark, folder, "part").select("p_type", "p_name", F.lower(answer).alias("answer")).distinct()
    return answers.select("p_type", "p_name", lut_ops.normalized_genre(F.col("answer")).alias("genre"))


def _applied(spark: SparkSession, folder: str) -> DataFrame:
    return lut_ops.applied_verdicts(_pairs(spark, folder), _brand_batches(spark, folder))


@_query
def lut_apply_verdicts(spark, folder):
    return _applied(spark, folder)


@_query
def lut_merge(spark, folder):
    one = _applied(spark, folder).groupBy("keyword").agg(F.max("genre").alias("genre"))
    return lut_ops.merged_lut(_lut(spark, folder), one)


@_query
def lut_resolved(spark, folder):
    parsed = lut_ops.reply_entries(_brand_replies(spark, folder))
    open_keywords = lut_ops.unresolved(
        _brand_batches(spark, folder), _applied(spark, folder), parsed.where("failed"))
    return lut_ops.merged_resolved(_resolved(spark, folder), open_keywords)


@_query
def lut_refresh(spark, folder):
    store = _scratch(spark, "refresh-lut")
    lut_store.save(spark, store, _lut(spark, folder), _resolved(spark, folder))
    rows = _stored(spark, folder, "lut-input", repeats=False)
    return refresh_lut(spark, rows, store, OfflineClassifier((("PHIM_HAN", "gizmo"),)))


# --- quality, lineage, access ---------------------------------------------------------------


def _results(spark: SparkSession, folder: str) -> DataFrame:
    # evaluation reads the table once for the values and once per uniqueness column
    return quality.evaluate(_stored(spark, folder, "quality-input", repeats=False), QUALITY_RULES, run_id=RUN_ID, run_date=date(2024, 1, 31))


_VERDICT = ("rule", "outcome", "failure_reason", "evaluated_metrics")


@_query
def dq_evaluate(spark, folder):
    return _results(spark, folder).select(*_VERDICT)


@_query
def dq_results_roundtrip(spark, folder):
    path = _scratch(spark, "quality")
    quality_results.write_results(_results(spark, folder), path)
    return quality_results.read_results(spark, path).select(*_VERDICT, F.col("run_date").cast("string").alias("run_date"))


@_query
def dq_outcomes(spark, folder):
    return quality.outcome_counts(_results(spark, folder))


@_query
def dq_failing_rules(spark, folder):
    return quality.failing_rules(_results(spark, folder))


@_query
def dq_gate(spark, folder):
    return quality.gate(_results(spark, folder), min_score=0.5)


@_query
def dq_recommend(spark, folder):
    rules = quality.recommend(
        _stored(spark, folder, "profile", repeats=False),
        ["derived_genre", "platform_group", "network_type_norm", "subscription_count", "is_search_abandoned"],
        keys=["event_id"])
    # the values are part of the rule's text
    return quality.rules_table(spark, rules).drop("values", "position")


@_query
def dq_job(spark, folder):
    """Recommend, evaluate, store, gate: the stored results beside the summary of the job. A second run keeps the rules."""
    base = _scratch(spark, "dq-job")
    rows = _stored(spark, folder, "dq-job-input", repeats=False)
    columns = ["derived_genre", "platform_group", "network_type_norm", "subscription_count", "is_search_abandoned"]
    run_quality(rows, f"{base}/rules", f"{base}/first", columns, ["event_id"], "first", min_score=0.9)
    summary = run_quality(rows.where(F.col("derived_genre") != "UNKNOWN"), f"{base}/rules", f"{base}/results", columns, ["event_id"], RUN_ID, min_score=0.9).first()
    results = quality_results.read_results(spark, f"{base}/results")
    stamped = (F.col("evaluation_started_on") != "") & (F.col("evaluation_completed_on") >= F.col("evaluation_started_on"))
    return results.select("rule", "outcome", stamped.alias("stamped"), *[F.lit(summary[c]).alias(c) for c in ("recommended", "rules", "passed", "score", "proceed")])


def _lineage_query(spark, folder):
    return lineage_counts(raw_events(spark, folder))


_lineage_query.__name__ = "lineage_counts"
_query(_lineage_query)


def _contract_query(spark, folder):
    rows = _stored(spark, folder, "contracts", repeats=False)
    report, _ = trending.trending(rows, rules=TREND)
    results = quality.evaluate(rows, QUALITY_RULES, run_id=RUN_ID)
    return contracts.contract_checks(
        raw_events(spark, folder), rows, results, report, reports.content_gaps(rows), reports.hour_genre(rows),
        LOOKUP_DAY, "PHIM_HAN")


_contract_query.__name__ = "contract_checks"
_query(_contract_query)


@_query
def access_lut_view(spark, folder):
    return _portable(access.visible_to(_curated(spark, folder, repeats=True), "lut_refresh"))


@_query
def access_checks(spark, folder):
    """Views of the roles as the catalog has them; the last one was made with a column it should not show."""
    rows = _curated(spark, folder)
    views = {role: access.create_role_view(rows, role, f"checked_{role}_{uuid.uuid4().hex}") for role in ("lut_refresh", "reports", "quality")}
    leaking = f"checked_leak_{uuid.uuid4().hex}"
    rows.drop(*access.hidden_columns("lut_refresh")[1:]).createOrReplaceTempView(leaking)
    checks = contracts.access_checks(rows, views).unionByName(
        contracts.access_checks(rows, {"lut_refresh": leaking}).withColumn("name", F.lit("columns hidden by a leaking view")))
    for view in (*views.values(), leaking):
        spark.catalog.dropTempView(view)
    return checks


# --- new files and streams ------------------------------------------------------------------


def _undated(e: Column) -> Column:
    """Events whose files lie outside any day folder."""
    return e % 250 == 7


def _arrivals(rows: DataFrame, base: str) -> Iterator[str]:
    """The folder ``landing`` after each ``arrival``, a number from 0 to 9 in the rows: files by day, but some beside the day folders.

    All are written in one pass, aside, and arrive by a rename.
    """
    spark = rows.sparkSession
    place = F.when(_undated(F.col("eventid").cast("long")), "stray").otherwise(F.col("dt"))
    write_raw(rows.withColumn("dt", F.concat("arrival", F.lit("-"), place)).drop("arrival"), f"{base}/staged")
    staged = [name for name in folders.subfolders(spark, f"{base}/staged") if "-" in name]
    for number in sorted({name[0] for name in staged}):
        root = f"{base}/landing/{number}"
        folders.make(spark, f"{root}/days")
        for name in staged:
            if name[0] == number:
                place = name[2:]
                folders.rename(spark, f"{base}/staged/{name}", f"{root}/{place}" if place == "stray" else f"{root}/days/{place}")
        yield f"{base}/landing"


@_query
def curated_new_files(spark, folder):
    """Two runs over what is new: first without some files of early days, which arrive late."""
    base = _scratch(spark, "new-files")
    rows = raw_events(spark, folder)
    late = F.col("dt").isin("20240103", "20240104") & (F.col("eventid").cast("long") % 5 == 0)
    write_raw(rows.where(~late), f"{base}/landing/a")
    run_new_files(spark, f"{base}/landing", f"{base}/curated", rules=TEST_RULES, run_id="first", reach_days=4)
    write_raw(rows.where(late), f"{base}/landing/b")
    second = run_new_files(spark, f"{base}/landing", f"{base}/curated", rules=TEST_RULES, run_id="second", reach_days=4).first()
    idle = run_new_files(spark, f"{base}/landing", f"{base}/curated", rules=TEST_RULES, run_id="third", reach_days=4).first()
    rows = read_curated(spark, f"{base}/curated").drop("_pipeline_run_id")
    return _portable(rows).withColumn("dirty_days", F.lit(second["dirty_days"])).withColumn("idle_files", F.lit(idle["new_files"]))


def _streamed(spark: SparkSession, folder: str, name: str) -> str:
    """Three arrivals out of order. Some events have a second copy ten days later, which arrives first and has to give way."""
    base = _scratch(spark, name)
    rows = raw_events(spark, folder)
    e = F.col("eventid").cast("long")
    later = F.date_format(F.to_date("dt", "yyyyMMdd") + F.expr("interval 10 days"), "yyyyMMdd")
    own = F.struct(((e + 1) % 3).alias("arrival"), "dt")
    copy = F.struct(F.lit(0).cast("long").alias("arrival"), later.alias("dt"))
    far = (e % 70 == 3) & ~_undated(e)
    rows = rows.withColumn("at", F.explode(F.when(far, F.array(own, copy)).otherwise(F.array(own)))).withColumns(
        {"arrival": F.col("at.arrival"), "dt": F.col("at.dt")}).drop("at")
    for landing in _arrivals(rows, base):
        ingest(raw_stream(spark, landing), f"{base}/curated", f"{base}/progress", rules=TEST_RULES)
    return f"{base}/curated"


@_query
def stream_ingest(spark, folder):
    """The table and, beside each row, how many rows went to the side table."""
    path = _streamed(spark, folder, "ingest")
    rows = _portable(read_curated(spark, path).drop("_pipeline_run_id"))
    return rows.withColumn("undated", F.lit(side_counts(spark, path).where("reason = 'undated'").first()["rows"]))


@_query
def stream_dedup(spark, folder):
    """Two arrivals: the second brings copies, late events and new ones. Kept events have no reason."""
    base = _scratch(spark, "stream")
    rows, e = raw_events(spark, folder), F.col("eventid").cast("long")
    early = (F.col("dt") <= ARRIVED_UNTIL) & (e % 3 != 0)
    for landing in _arrivals(rows.withColumn("arrival", F.when(early, 0).otherwise(1)), base):
        dedup.append_once(raw_stream(spark, landing), f"{base}/events", f"{base}/progress")
    kept = dedup.rows(spark, f"{base}/events").withColumn("reason", F.lit(None).cast("string"))
    every = kept.unionByName(dedup.side_rows(spark, f"{base}/events"))
    return _portable(every.select("eventid", "event_ts", "reason"))


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Content gaps: keywords of a known genre that users give up on."""
    return _QUERIES["report_content_gaps"](spark, folder)
