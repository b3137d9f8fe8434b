"""The same results in SQL, for checking. Runs on the benchmark tables in DuckDB."""

from __future__ import annotations

from searchtide import vocab
from searchtide.registry.settings import (
    ARRIVED_UNTIL, FILTER_GENRE, FILTER_TEXT, LOOKUP_DAY, LUT_WORDS, NEW_SINCE, PHRASES, QUALITY_RULES, RESOLVED_WORD, RUN_ID,
    SINCE, TREND, VERDICT_WORDS,
)
from searchtide.sources.testtables import WORD_PATTERNS

_EDGE = r"[^\p{L}\p{N}_]"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(values) -> str:
    return ", ".join(_quoted(v) for v in values)


def _found(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {_quoted(f'(?i)(^|{_EDGE})({pattern})($|{_EDGE})')})"


def _genre_case(column: str, patterns) -> str:
    return "CASE " + " ".join(f"WHEN {_found(column, p)} THEN '{g}'" for g, p in patterns) + " END"


def _map_case(column: str, table, default: str) -> str:
    whens = " ".join(f"WHEN {_quoted(k)} THEN {_quoted(v)}" for k, v in table.items())
    return f"CASE lower({column}) {whens} ELSE {_quoted(default)} END"


def pct(part: str, whole: str, scale: int = 100, digits: int = 1) -> str:
    shift = 10 ** digits
    part, whole = f"CAST({part} AS BIGINT)", f"CAST({whole} AS BIGINT)"
    return f"CAST(({2 * scale * shift} * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / {float(shift)}"


RAW = r"""
keyed AS (
  SELECT e.event_id AS e, e.ts, e.user_id AS u, e.event_type AS et, p.p_name
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) e JOIN part p
    ON p.p_partkey = CASE WHEN e.event_id % 2 = 0 THEN k % 20 ELSE (k * 97 + e.event_id) % (SELECT count(*) FROM part) END
), raw AS (
  SELECT CAST(e AS VARCHAR) AS eventid,
    CASE WHEN e % 499 = 0 THEN '0004-01-01 00:00:00.000' WHEN e % 503 = 0 THEN 'bad'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%g') END AS datetime,
    CASE WHEN e % 11 = 0 THEN NULL WHEN e % 37 = 0 THEN '' WHEN e % 13 = 0 THEN upper(p_name) || ' '
         ELSE p_name END AS keyword,
    CASE et WHEN 'error' THEN 'quit' WHEN 'purchase' THEN 'enter' WHEN 'signup' THEN NULL ELSE et END AS category,
    'search' AS action,
    CASE e % 6 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' WHEN 2 THEN 'smarttv' WHEN 3 THEN 'web' WHEN 4 THEN 'Samsung' END
      AS platform,
    CASE e % 5 WHEN 0 THEN 'WiFi' WHEN 1 THEN '4g' WHEN 2 THEN '5g' WHEN 3 THEN 'ethernet' END AS networktype,
    CASE e % 4 WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN ['VIP:30', 'SPORT: x'] WHEN 3 THEN ['BASIC', ' K+ :7'] END
      AS userplansmap,
    CASE WHEN e % 97 <> 0 THEN 'isp' || CAST(e % 3 AS VARCHAR) END AS proxy_isp,
    CASE WHEN e % 5 <> 0 THEN CAST(u % 4 AS VARCHAR) END AS user_id,
    strftime(day, '%Y%m%d') AS dt
  FROM (SELECT *, CASE WHEN day(arrival) IN (10, 17, 18) THEN arrival + INTERVAL 3 DAY ELSE arrival END AS day
    FROM (SELECT *, unnest(CASE WHEN e % 50 = 0 THEN [ts, ts + INTERVAL 1 DAY] ELSE [ts] END) AS arrival FROM keyed))
)"""

TIMED = RAW + r""", found AS (
  SELECT *, regexp_extract(translate(trim(datetime), '٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹', '01234567890123456789'),
    '^(\d{4}-\d{2}-\d{2})\s+(\d{1,2}):(\d{2}):(\d{2})(?:\.(\d+))?', ['d', 'h', 'mi', 's', 'f']) AS m FROM raw
), repaired AS (
  SELECT * EXCLUDE (m), CASE WHEN m.d <> '' THEN
    CASE WHEN m.d LIKE '2565%' THEN '2022' || m.d[5:] ELSE m.d END || ' ' || lpad(m.h, 2, '0') || ':' || m.mi || ':'
    || m.s || '.' || (m.f || '000')[1:3] END AS datetime_clean FROM found
), timed AS (
  SELECT *, TRY_CAST(datetime_clean AS TIMESTAMP) AS event_ts FROM repaired
), usable AS (SELECT * FROM timed WHERE year(event_ts) >= 2015)"""

DEDUPED = TIMED + """, deduped AS (
  SELECT * FROM usable QUALIFY row_number() OVER (PARTITION BY eventid ORDER BY event_ts, dt) = 1
)"""

CURATED = DEDUPED + f""", keyed_sessions AS (
  SELECT *, lower(trim(keyword)) AS keyword_norm,
    CASE WHEN user_id IS NOT NULL THEN user_id ELSE proxy_isp || '|' || platform END || '|'
      || CAST(CAST(floor(epoch(event_ts) / 1800) AS BIGINT) AS VARCHAR) AS session_key FROM deduped
), latest AS (
  SELECT *, last_value(keyword_norm IGNORE NULLS) OVER (PARTITION BY session_key ORDER BY event_ts, eventid
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS previous FROM keyed_sessions
), curated AS (
  SELECT eventid AS event_id, event_ts, CAST(hour(event_ts + INTERVAL 7 HOUR) AS INTEGER) AS hour_of_day_vn,
    sha256(user_id) AS user_id_hashed, user_id IS NOT NULL AS user_is_authenticated,
    CASE category WHEN 'quit' THEN 'ABANDON' WHEN 'enter' THEN 'SUBMIT' ELSE upper(category) END AS session_action,
    category = 'quit' AS is_search_abandoned, keyword_norm,
    CASE WHEN keyword_norm <> '' THEN coalesce({_genre_case('keyword_norm', WORD_PATTERNS)}, 'UNKNOWN')
         ELSE 'EMPTY_QUERY' END AS derived_genre,
    {_map_case('platform', vocab.PLATFORM_GROUPS, vocab.OTHER_PLATFORM)} AS platform_group,
    {_map_case('networktype', vocab.NETWORK_GROUPS, vocab.OTHER_NETWORK)} AS network_type_norm,
    upper(proxy_isp) AS isp_segment,
    coalesce(list_has_any([trim(split_part(coalesce(x, 'None'), ':', 1)) for x in userplansmap],
      [{_list(vocab.PREMIUM_PLANS)}]), false) AS has_premium,
    CAST(len(userplansmap) AS INTEGER) AS subscription_count,
    [trim(split_part(coalesce(x, 'None'), ':', 1)) for x in userplansmap] AS plan_names,
    sha256(session_key) AS search_session_id, keyword_norm = previous AS is_repeat_search,
    '{RUN_ID}' AS _pipeline_run_id, dt[1:4] || '-' || dt[5:6] || '-' || dt[7:8] AS dt
  FROM latest
)"""

_TS = "strftime({}, '%Y-%m-%d %H:%M:%S.%g')"
CURATED_COLUMNS = f"""event_id, {_TS.format('event_ts')} AS event_ts, hour_of_day_vn, user_id_hashed,
  user_is_authenticated, session_action, is_search_abandoned, keyword_norm, derived_genre, platform_group,
  network_type_norm, isp_segment, has_premium, subscription_count,
  CASE WHEN plan_names IS NOT NULL THEN coalesce(array_to_string(plan_names, ','), '') END AS plan_names,
  search_session_id, is_repeat_search, _pipeline_run_id, dt"""

_PRESENT = "keyword_norm <> ''"
_KNOWN = "derived_genre NOT IN ('UNKNOWN', 'EMPTY_QUERY')"
_N = "count(*)"
_ABANDONED = "count(*) FILTER (WHERE is_search_abandoned)"
_PREMIUM = "count(*) FILTER (WHERE has_premium)"
_REPEATED = "count(*) FILTER (WHERE is_repeat_search)"
_GUESTS = "count(*) FILTER (WHERE NOT user_is_authenticated)"


def _from(prelude: str, body: str) -> str:
    return f"WITH {prelude}\n{body}"


def _curated(body: str) -> str:
    return _from(CURATED, body)


def _windows(source: str = "curated") -> str:
    return f""", days AS (SELECT max(CAST(dt AS DATE)) AS ref FROM {source}), marked AS (
  SELECT keyword_norm, derived_genre,
    CAST(dt AS DATE) >= ref - {TREND.current_days} AND CAST(dt AS DATE) < ref AS cur,
    CAST(dt AS DATE) >= ref - {TREND.baseline_age}
      AND CAST(dt AS DATE) < ref - {TREND.baseline_age} + {TREND.baseline_days} AS base
  FROM {source}, days WHERE {_PRESENT}
), c AS (SELECT keyword_norm, derived_genre, count(*) AS n FROM marked WHERE cur GROUP BY ALL),
b AS (SELECT keyword_norm, derived_genre, count(*) AS n FROM marked WHERE base GROUP BY ALL), grown AS (
  SELECT c.keyword_norm, c.derived_genre, c.n AS current_cnt, coalesce(b.n, 0) AS baseline_cnt,
    {pct('c.n', 'b.n', 1, 2)} AS growth_multiplier, b.n IS NULL AS is_new_keyword
  FROM c LEFT JOIN b USING (keyword_norm, derived_genre)
  WHERE c.n >= {TREND.min_volume} AND (b.n IS NULL OR CAST(c.n AS DOUBLE) / b.n >= {TREND.min_growth})
  ORDER BY current_cnt DESC, keyword_norm, derived_genre LIMIT {TREND.limit}
)"""


_AGAIN = f""", renewed AS (
  SELECT * REPLACE (CASE WHEN dt >= '{NEW_SINCE}' AND CAST(event_id AS BIGINT) % 3 = 0 AND {_PRESENT} THEN keyword_norm || ' again' ELSE keyword_norm END AS keyword_norm)
  FROM curated
)"""


_GAPS = f"""SELECT keyword_norm, derived_genre, count(*) AS searches, {_ABANDONED} AS abandoned,
  {pct(_ABANDONED, _N)} AS abandon_rate_pct FROM curated WHERE {_KNOWN} AND {_PRESENT} GROUP BY ALL
  HAVING {_ABANDONED} >= 5 ORDER BY abandon_rate_pct DESC, abandoned DESC, keyword_norm, derived_genre LIMIT 500"""

_HOUR_GENRE = f"""SELECT hour_of_day_vn, derived_genre, n AS searches, {pct('n', 's')} AS pct_of_genre FROM (
  SELECT *, sum(n) OVER (PARTITION BY derived_genre) AS s FROM (
    SELECT hour_of_day_vn, derived_genre, count(*) AS n FROM curated GROUP BY ALL))"""


def _hour_columns(source: str) -> str:
    return ", ".join(f"CAST(count(*) FILTER (WHERE {source} = {h}) AS BIGINT) AS h{h:02d}" for h in range(24))


_LUT = "lut AS (SELECT DISTINCT p_name AS keyword, CASE " + " ".join(
    f"WHEN p_name LIKE '% {word}' THEN '{genre}'" for word, genre in LUT_WORDS
) + " END AS genre FROM part WHERE " + " OR ".join(f"p_name LIKE '% {word}'" for word, _ in LUT_WORDS) + ")"
_RESOLVED = f"resolved AS (SELECT DISTINCT p_name AS keyword FROM part WHERE p_name LIKE '% {RESOLVED_WORD}')"
_MINED = f"""{CURATED}, {_LUT}, {_RESOLVED}, mined AS (
  SELECT keyword_norm, count(*) AS cnt FROM curated WHERE derived_genre = 'UNKNOWN' GROUP BY ALL
), candidates AS (
  SELECT * FROM mined WHERE keyword_norm NOT IN (SELECT keyword FROM lut)
    AND keyword_norm NOT IN (SELECT keyword FROM resolved)
), asked AS (
  SELECT *, row_number() OVER (ORDER BY cnt DESC, keyword_norm) AS rank FROM candidates
  WHERE length(trim(keyword_norm)) > 2 AND keyword_norm <> '{vocab.META_QUERIES[0]}'
)"""

_VERDICT = "CASE " + " ".join(f"WHEN p_name LIKE '% {w}' THEN '{g}'" for w, g in VERDICT_WORDS) + " ELSE 'UNKNOWN' END"
#: brand number decides the form of the reply: broken, inverted, or straight
_REPLIES = f"""named AS (
  SELECT DISTINCT CAST(p_brand[7:] AS INTEGER) AS batch_id, p_name, {_VERDICT} AS code FROM part
), last_named AS (
  SELECT batch_id, code, max(p_name) AS last FROM named WHERE batch_id % 7 <> 0 AND batch_id % 5 = 0 GROUP BY ALL
), judged AS (
  SELECT *, avg(CASE WHEN code IN ({_list(vocab.VERDICT_CODES)}) THEN 1.0 ELSE 0.0 END)
    OVER (PARTITION BY batch_id) > 0.5 AS inverted FROM last_named
), pairs AS (
  SELECT batch_id, p_name AS name, code AS answer FROM named WHERE batch_id % 7 <> 0 AND batch_id % 5 <> 0
  UNION ALL
  SELECT batch_id, CASE WHEN inverted THEN last ELSE code END, CASE WHEN inverted THEN code ELSE last END FROM judged
)"""
_ALIASED = "CASE answer " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in vocab.GENRE_ALIASES.items()) + " ELSE answer END"
_APPLIED = f"""{_REPLIES}, applied AS (
  SELECT batch_id, name AS keyword, {_ALIASED} AS genre FROM pairs
  WHERE {_ALIASED} IN ({_list(vocab.VERDICT_CODES)}) AND {_ALIASED} <> 'UNKNOWN'
    AND EXISTS (SELECT 1 FROM named n WHERE n.batch_id = pairs.batch_id AND n.p_name = pairs.name)
)"""


def _quality() -> str:
    selects = []
    for rule in QUALITY_RULES:
        c = rule.column
        if rule.kind == "listed":
            m = pct(f"count(*) FILTER (WHERE CAST({c} AS VARCHAR) IN ({_list(rule.values)}))", _N, 1, 4)
            source, ok, metric = "curated", f"m >= {rule.threshold}", f"Column.{c}.ColumnValues.Compliance"
            reason = f"Values of {c} in the list: "
        elif rule.kind == "at_most":
            m, source, ok, metric = f"CAST(max({c}) AS DOUBLE)", "curated", f"m <= {rule.limit}", f"Column.{c}.Maximum"
            reason = f"Maximum of {c}: "
        else:
            m = pct(f"count(*) FILTER (WHERE n = 1 AND {c} IS NOT NULL)", "sum(n)", 1, 4)
            source = f"(SELECT {c}, count(*) AS n FROM curated GROUP BY {c})"
            ok, metric, reason = f"m > {rule.limit}", f"Column.{c}.Uniqueness", f"Uniqueness of {c}: "
        selects.append(
            f"SELECT {_quoted(rule.text)} AS rule, CASE WHEN {ok} THEN 'Passed' ELSE 'Failed' END AS outcome, "
            f"CASE WHEN NOT ({ok}) THEN {_quoted(reason)} || CAST(m AS VARCHAR) END AS failure_reason, "
            f"""'{{"{metric}":' || CAST(m AS VARCHAR) || '}}' AS evaluated_metrics FROM (SELECT {m} AS m FROM {source})""")
    return f"{CURATED}, results AS (" + "\nUNION ALL ".join(selects) + ")"


#: events whose files lie outside any day folder, in the queries about arrivals
_UNDATED = "(CAST(eventid AS BIGINT) % 250 = 7)"

_WINDOW = """gap_days AS (
  SELECT strftime(d, '%Y-%m-%d') AS dt FROM (SELECT unnest(generate_series(min(CAST(dt AS DATE)), max(CAST(dt AS DATE)), INTERVAL 1 DAY)) AS d FROM curated)
  WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT dt FROM curated)
), absent AS (
  SELECT count(*) AS missing, array_to_string(list_sort(list(dt))[1:3], '; ') AS named FROM gap_days
), captioned AS (
  SELECT min(dt) || ' → ' || max(dt) || ' • ' || count(DISTINCT dt) || ' days • ' ||
    any_value(CASE WHEN missing > 0 THEN missing || ' missing (' || named || CASE WHEN missing > 3 THEN ' (+' || (missing - 3) || ' more)' ELSE '' END || ') • ' ELSE '' END)
    || format('{:,}', count(*)) || ' rows' AS coverage FROM curated, absent
)"""


def _pack_lines() -> str:
    def two(rate: str) -> str:
        return f"CAST(CAST({rate} AS DECIMAL(20,2)) AS VARCHAR)"

    def line(section: str, body: str, *columns: str) -> str:
        return f"SELECT '{section}' AS section, concat_ws('|', {', '.join(columns)}) AS row FROM ({body})"

    share = "SELECT derived_genre, count(*) AS n, {part} AS k, {pct} AS p FROM curated {where} GROUP BY ALL"
    abandon = f"count(*) AS c, {pct(_ABANDONED, _N)} AS a FROM curated"
    lines = [
        line("dt_window", "SELECT min(dt) AS a, max(dt) AS b, count(DISTINCT dt) AS n, count(*) AS c, array_to_string(list_sort(list(DISTINCT dt)), ',') AS d FROM curated",
             "a", "b", "n", "c", "d"),
        line("totals", f"SELECT count(*) AS n, count(DISTINCT keyword_norm) AS k, {pct(_ABANDONED, _N)} AS p FROM curated", "n", "k", two("p")),
        line("platform", f"SELECT platform_group AS g, {abandon} GROUP BY ALL", "g", "c", two("a")),
        line("genre", f"SELECT derived_genre AS g, {abandon} GROUP BY ALL", "g", "c", two("a")),
        line("keywords", f"SELECT keyword_norm AS w, derived_genre AS g, {abandon} WHERE {_PRESENT} GROUP BY ALL ORDER BY c DESC, w, g LIMIT 20", "w", "g", "c", two("a")),
        line("content_gaps", _GAPS, "keyword_norm", "derived_genre", "searches", "abandoned", two("abandon_rate_pct")),
        line("premium", share.format(part=_PREMIUM, pct=pct(_PREMIUM, _N), where=""), "derived_genre", "n", "k", two("p")),
        line("repeat", share.format(part=_REPEATED, pct=pct(_REPEATED, _N), where=""), "derived_genre", "n", "k", two("p")),
        line("guest", share.format(part=_GUESTS, pct=pct(_GUESTS, _N), where=f"WHERE {_KNOWN}"), "derived_genre", "n", "k", two("p")),
        line("hour_genre", _HOUR_GENRE, "hour_of_day_vn", "derived_genre", "searches", two("pct_of_genre")),
    ]
    return " UNION ALL ".join(f"({text})" for text in lines)


_RECOMMENDED = (""", pairs AS (
  SELECT * FROM (SELECT CAST(derived_genre AS VARCHAR) AS derived_genre, CAST(platform_group AS VARCHAR) AS platform_group,
    CAST(network_type_norm AS VARCHAR) AS network_type_norm, CAST(subscription_count AS VARCHAR) AS subscription_count,
    CAST(is_search_abandoned AS VARCHAR) AS is_search_abandoned FROM curated) UNPIVOT (v FOR col IN (*))
), counts AS (
  SELECT * FROM (SELECT col, v, count(*) AS c FROM pairs GROUP BY col, v) QUALIFY count(*) OVER (PARTITION BY col) <= 20
), running AS (
  SELECT *, (SELECT count(*) FROM curated) AS n, sum(c) OVER (PARTITION BY col) AS total,
    sum(c) OVER (PARTITION BY col ORDER BY c DESC, v ROWS UNBOUNDED PRECEDING) - c AS before FROM counts
), lists AS (
  SELECT col, n, sum(c) AS covered, string_agg('"' || v || '"', ',' ORDER BY v) AS vs FROM running GROUP BY col, n
  UNION ALL
  SELECT col, n, sum(c) FILTER (before < 0.9 * n), string_agg('"' || v || '"', ',' ORDER BY v) FILTER (before < 0.9 * n) FROM running
  GROUP BY col, n HAVING max(total) >= 0.9 * n AND count(*) FILTER (before < 0.9 * n) < count(*)
), listed AS (
  SELECT col, vs, CASE WHEN covered = n THEN 1.0 ELSE CAST(100 * covered // n AS DOUBLE) / 100 END AS threshold FROM lists
), shares AS (
  SELECT """ + pct("count(*) FILTER (n = 1)", "sum(n)", 1, 4) + """ AS share FROM (SELECT event_id, count(*) AS n FROM curated GROUP BY ALL)
)""", """
SELECT 'listed' AS kind, col AS "column", CAST(threshold AS DOUBLE) AS threshold, CAST(0 AS DOUBLE) AS "limit", 'ColumnValues "' || col || '" in [' || vs || ']'
  || CASE WHEN threshold >= 1 THEN '' ELSE printf(' with threshold >= %g', CAST(threshold AS DOUBLE)) END AS rule FROM listed
UNION ALL
SELECT 'at_most', 'subscription_count', 1.0, CAST(max(subscription_count) AS DOUBLE), printf('ColumnValues "subscription_count" <= %g', CAST(max(subscription_count) AS DOUBLE)) FROM curated
UNION ALL
SELECT 'unique', 'event_id', 1.0, greatest(0, trunc(share * 100 - 1) / 100), printf('Uniqueness "event_id" > %g', greatest(0, trunc(share * 100 - 1) / 100)) FROM shares""")


def _job() -> str:
    """The recommended rules measured again on rows of known genres."""
    listed = pct("count(*) FILTER (WHERE contains(',' || vs || ',', ',\"' || v || '\",'))", "count(*)", 1, 4)
    unique = pct("count(*) FILTER (WHERE n = 1 AND event_id IS NOT NULL)", "sum(n)", 1, 4)
    columns = ("derived_genre", "platform_group", "network_type_norm", "subscription_count", "is_search_abandoned")
    # a missing value lies in no list
    values = " UNION ALL ".join(f"SELECT '{c}' AS col, coalesce(CAST({c} AS VARCHAR), '?') AS v FROM known_rows" for c in columns)
    return _from(CURATED + _RECOMMENDED[0] + f""", recommended AS ({_RECOMMENDED[1]}
), known_rows AS (SELECT * FROM curated WHERE derived_genre <> 'UNKNOWN'), every AS ({values}), lists_measured AS (
  SELECT l.col, vs, threshold, {listed} AS m FROM listed l JOIN every USING (col) GROUP BY ALL
), outcomes AS (
  SELECT r.rule, CASE WHEN m >= r.threshold THEN 'Passed' ELSE 'Failed' END AS outcome FROM recommended r JOIN lists_measured l
    ON r.kind = 'listed' AND r."column" = l.col AND r.threshold = l.threshold AND r.rule LIKE '%[' || vs || ']%'
  UNION ALL SELECT rule, CASE WHEN (SELECT max(subscription_count) FROM known_rows) <= "limit" THEN 'Passed' ELSE 'Failed' END FROM recommended WHERE kind = 'at_most'
  UNION ALL SELECT rule, CASE WHEN (SELECT {unique} FROM (SELECT event_id, count(*) AS n FROM known_rows GROUP BY ALL)) > "limit" THEN 'Passed' ELSE 'Failed' END
    FROM recommended WHERE kind = 'unique'
), score AS (SELECT count(*) AS rules, count(*) FILTER (WHERE outcome = 'Passed') AS passed FROM outcomes)""",
        "SELECT rule, outcome, true AS stamped, false AS recommended, rules, passed, " + pct("passed", "rules", 1, 4) + " AS score, "
        + pct("passed", "rules", 1, 4) + " >= 0.9 AS proceed FROM outcomes, score")


#: the curated table after one day was curated again with the keyword table
_RECLASSIFIED = CURATED.replace("), curated AS (", "), curated_first AS (") + f""", {_LUT}, curated AS (
  SELECT c.* REPLACE (CASE WHEN dt = '{LOOKUP_DAY}' AND derived_genre <> 'EMPTY_QUERY' THEN coalesce(genre, derived_genre) ELSE derived_genre END AS derived_genre)
  FROM curated_first c LEFT JOIN lut ON keyword_norm = keyword
)"""

#: part names with one letter taken out and one other changed
_MISSPELT = "misspelt AS (SELECT DISTINCT 'z' || p_name[2:4] || p_name[6:] AS keyword FROM part)"


def oracle_sql() -> dict[str, str]:
    quality = _quality()
    trend = CURATED + _windows()
    sql = {
        # sources and sinks
        "src_raw_scan": _from(RAW, "SELECT eventid, datetime, keyword, category, action, platform, networktype, "
                              "array_to_string(userplansmap, ',') AS userplansmap, proxy_isp, user_id, dt FROM raw"),
        "src_path_dt": _from(RAW, "SELECT dt, count(*) AS rows FROM raw GROUP BY dt"),
        "src_incremental": _from(RAW, f"SELECT eventid, dt FROM raw WHERE strptime(dt, '%Y%m%d') >= DATE '{SINCE}'"),
        "raw_action_distinct": _from(RAW, "SELECT DISTINCT CASE WHEN CAST(eventid AS BIGINT) % 7 = 0 THEN 'open ' || platform ELSE action END AS action FROM raw"),
        "sink_curated_roundtrip": _curated(f"SELECT {CURATED_COLUMNS} FROM curated"),
        "curated_partition_lookup": _curated(
            f"SELECT derived_genre, count(*) AS rows FROM curated WHERE dt = '{LOOKUP_DAY}' AND derived_genre = 'PHIM_HAN' "
            "GROUP BY derived_genre"),
        # enrichment
        "curated": _curated(f"SELECT {CURATED_COLUMNS} FROM curated"),
        "enrich_datetime": _from(TIMED, f"SELECT eventid, dt, datetime_clean, {_TS.format('event_ts')} AS event_ts FROM timed"),
        "filter_corrupt_year": _from(TIMED, "SELECT eventid, dt FROM usable"),
        "enrich_local_hour": _curated("SELECT event_id, hour_of_day_vn FROM curated"),
        "enrich_action": _curated("SELECT event_id, session_action, is_search_abandoned FROM curated"),
        "enrich_identity": _curated("SELECT event_id, user_is_authenticated, user_id_hashed FROM curated"),
        "enrich_keyword": _curated("SELECT event_id, keyword_norm FROM curated"),
        "enrich_genre": _curated("SELECT event_id, keyword_norm, derived_genre FROM curated"),
        "enrich_platform": _curated("SELECT event_id, platform_group FROM curated"),
        "enrich_network": _curated("SELECT event_id, network_type_norm, isp_segment FROM curated"),
        "enrich_plans": _curated(
            "SELECT event_id, has_premium, subscription_count, CASE WHEN plan_names IS NOT NULL THEN "
            "coalesce(array_to_string(plan_names, ','), '') END AS plan_names FROM curated"),
        "enrich_session_id": _curated("SELECT event_id, search_session_id FROM curated"),
        "enrich_repeat_search": _curated("SELECT event_id, is_repeat_search FROM curated"),
        "dedup_events": _from(DEDUPED, f"SELECT eventid, dt, {_TS.format('event_ts')} AS event_ts, keyword FROM deduped"),
        "genre_lut_lookup": _from(
            f"{CURATED}, {_LUT}", "SELECT event_id, keyword_norm, genre AS lut_genre FROM curated "
            "LEFT JOIN lut ON keyword_norm = keyword"),
        "genre_waterfall": _from(
            f"{CURATED}, {_LUT}", "SELECT event_id, CASE WHEN derived_genre = 'EMPTY_QUERY' THEN derived_genre "
            "ELSE coalesce(genre, derived_genre) END AS derived_genre FROM curated LEFT JOIN lut ON keyword_norm = keyword"),
        "genre_regex": f"""WITH phrased AS (SELECT *, [{_list(PHRASES)}][p_partkey % {len(PHRASES)} + 1] AS phrase FROM part), named AS (
  SELECT p_partkey, lower(trim(CASE p_size % 3 WHEN 0 THEN phrase WHEN 1 THEN phrase || ' ' || p_name ELSE p_name || ' ' || phrase END)) AS k FROM phrased
) SELECT p_partkey, {_genre_case("k", vocab.GENRE_PATTERNS)} AS genre FROM named""",
        "genre_fuzzy": _from(CURATED + """, near_lut AS (
  SELECT DISTINCT p_name[2:] AS keyword FROM part
), words AS (SELECT DISTINCT keyword_norm FROM curated WHERE length(keyword_norm) >= 4)""",
            "SELECT keyword_norm, keyword AS near_keyword, 'PHIM_TRUNG' AS near_genre FROM words, near_lut "
            "WHERE levenshtein(keyword_norm, keyword) <= 1 QUALIFY row_number() OVER (PARTITION BY keyword_norm "
            "ORDER BY levenshtein(keyword_norm, keyword), keyword) = 1"),
        "genre_fuzzy_two_edits": _from(CURATED + f", {_MISSPELT}, words AS (SELECT DISTINCT keyword_norm FROM curated WHERE length(keyword_norm) >= 4)",
            "SELECT keyword_norm, keyword AS near_keyword, 'PHIM_TRUNG' AS near_genre FROM words, misspelt "
            "WHERE levenshtein(keyword_norm, keyword) <= 2 QUALIFY row_number() OVER (PARTITION BY keyword_norm "
            "ORDER BY levenshtein(keyword_norm, keyword), keyword) = 1"),
        "genre_waterfall_near": _from(f"{CURATED}, {_LUT}, {_MISSPELT}" + """, entries AS (
  SELECT keyword, max(genre) AS genre FROM (SELECT * FROM lut UNION ALL SELECT keyword, 'PHIM_TRUNG' FROM misspelt) GROUP BY keyword
), near AS (
  SELECT keyword_norm, e.genre FROM (SELECT DISTINCT keyword_norm FROM curated WHERE derived_genre = 'UNKNOWN' AND length(keyword_norm) >= 4) w, entries e
  WHERE length(keyword) >= 4 AND levenshtein(keyword_norm, keyword) <= 2
  QUALIFY row_number() OVER (PARTITION BY keyword_norm ORDER BY levenshtein(keyword_norm, keyword), keyword) = 1
)""", """SELECT event_id, CASE WHEN derived_genre = 'EMPTY_QUERY' THEN derived_genre
  ELSE coalesce(e.genre, CASE WHEN derived_genre = 'UNKNOWN' THEN n.genre END, derived_genre) END AS derived_genre
FROM curated c LEFT JOIN entries e ON c.keyword_norm = e.keyword LEFT JOIN near n ON c.keyword_norm = n.keyword_norm"""),
        # reports
        "report_dt_window": _curated(
            "SELECT min(dt) AS min_dt, max(dt) AS max_dt, count(DISTINCT dt) AS n_days, count(*) AS total_rows, "
            "array_to_string(list_sort(list(DISTINCT dt)), ',') AS dts FROM curated"),
        "report_missing_days": _curated(
            "SELECT strftime(d, '%Y-%m-%d') AS dt FROM (SELECT unnest(generate_series(min(CAST(dt AS DATE)), "
            "max(CAST(dt AS DATE)), INTERVAL 1 DAY)) AS d FROM curated) "
            "WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT dt FROM curated)"),
        "report_window_caption": _from(CURATED + """, gaps AS (
  SELECT strftime(d, '%Y-%m-%d') AS dt FROM (SELECT unnest(generate_series(min(CAST(dt AS DATE)), max(CAST(dt AS DATE)), INTERVAL 1 DAY)) AS d FROM curated)
  WHERE strftime(d, '%Y-%m-%d') NOT IN (SELECT dt FROM curated)
), absent AS (
  SELECT count(*) AS missing, array_to_string(list_sort(list(dt))[1:3], '; ') AS named FROM gaps
)""",
            "SELECT min(dt) || ' → ' || max(dt) || ' • ' || count(DISTINCT dt) || ' days • ' || "
            "any_value(CASE WHEN missing > 0 THEN missing || ' missing (' || named || "
            "CASE WHEN missing > 3 THEN ' (+' || (missing - 3) || ' more)' ELSE '' END || ') • ' ELSE '' END) || "
            "format('{:,}', count(*)) || ' rows' AS label, min(dt) AS min_dt, max(dt) AS max_dt, "
            "count(DISTINCT dt) AS n_days, count(*) AS total_rows, any_value(missing) AS missing FROM curated, absent"),
        "report_totals": _curated(
            f"SELECT count(*) AS total, count(DISTINCT keyword_norm) AS kw, {pct(_ABANDONED, _N)} AS abandon FROM curated"),
        "report_platform": _curated(
            f"SELECT platform_group, count(*) AS c, {pct(_ABANDONED, _N)} AS a FROM curated GROUP BY ALL"),
        "report_genre": _curated(
            f"SELECT derived_genre, count(*) AS c, {pct(_ABANDONED, _N)} AS a FROM curated GROUP BY ALL"),
        "report_top_keywords": _curated(
            f"SELECT keyword_norm, derived_genre, count(*) AS c, {pct(_ABANDONED, _N)} AS a FROM curated "
            f"WHERE {_PRESENT} GROUP BY ALL ORDER BY c DESC, keyword_norm, derived_genre LIMIT 20"),
        "report_content_gaps": _curated(_GAPS),
        "report_premium_share": _curated(
            f"SELECT derived_genre, count(*) AS total_searches, {_PREMIUM} AS premium_searches, "
            f"{pct(_PREMIUM, _N)} AS premium_share_pct FROM curated GROUP BY derived_genre"),
        "report_repeat_share": _curated(
            f"SELECT derived_genre, count(*) AS total_searches, {_REPEATED} AS repeat_searches, "
            f"{pct(_REPEATED, _N)} AS repeat_pct FROM curated GROUP BY derived_genre"),
        "report_guest_share": _curated(
            f"SELECT derived_genre, count(*) AS total_searches, {_GUESTS} AS guest_searches, "
            f"{pct(_GUESTS, _N)} AS guest_share_pct FROM curated WHERE {_KNOWN} GROUP BY derived_genre"),
        "report_hour_genre": _curated(_HOUR_GENRE),
        "report_hour_matrix": _curated(
            f"SELECT derived_genre, {_hour_columns('hour_of_day_vn')} FROM curated GROUP BY derived_genre UNION ALL "
            f"SELECT 'All genres', {_hour_columns('hour_of_day_vn')} FROM curated"),
        "report_trending": _from(CURATED + _AGAIN + _windows("renewed"), "SELECT * FROM grown"),
        "report_trending_section": _from(
            trend + f""", captions AS (
  SELECT strftime(ref - {TREND.current_days}, '%Y-%m-%d') || ' → ' || strftime(ref - 1, '%Y-%m-%d') || ' vs '
    || strftime(ref - {TREND.baseline_age}, '%Y-%m-%d') || ' → ' || strftime(ref - {TREND.baseline_age} + {TREND.baseline_days} - 1, '%Y-%m-%d')
    || ' • growth ≥ {TREND.min_growth}x' AS coverage FROM days
)""", "SELECT grown.*, coverage FROM grown, captions"),
        "report_trending_fallback": _from(
            trend, f"SELECT keyword_norm, derived_genre, n AS current_cnt, CAST(0 AS BIGINT) AS baseline_cnt, "
            f"CAST(NULL AS DOUBLE) AS growth_multiplier, true AS is_new_keyword FROM c WHERE n >= {TREND.min_volume} "
            f"ORDER BY n DESC, keyword_norm, derived_genre LIMIT {TREND.limit}"),
        "report_latest_dt": _curated("SELECT max(dt) AS max_dt FROM curated"),
        "report_by_hour": _curated(
            "SELECT CAST(hour_of_day_vn AS VARCHAR) AS hour, count(*) AS searches FROM curated GROUP BY hour_of_day_vn"),
        "report_auth_mix": _curated("SELECT user_is_authenticated, count(*) AS searches FROM curated GROUP BY ALL"),
        "report_abandon_by_genre": _curated(
            f"SELECT derived_genre, count(*) AS total, {_ABANDONED} AS abandoned, {pct(_ABANDONED, _N)} AS abandon_pct "
            f"FROM curated WHERE {_KNOWN} GROUP BY derived_genre"),
        "report_premium_known": _curated(
            f"SELECT derived_genre, count(*) AS total, {pct(_PREMIUM, _N)} AS premium_pct FROM curated WHERE {_KNOWN} "
            "GROUP BY derived_genre"),
        "report_top_known": _curated(
            f"SELECT keyword_norm, derived_genre, count(*) AS searches FROM curated WHERE {_PRESENT} AND {_KNOWN} "
            "GROUP BY ALL ORDER BY searches DESC, keyword_norm, derived_genre LIMIT 10"),
        "report_classifier_coverage": _curated(
            f"SELECT derived_genre, count(*) AS rows, {pct(_N, '(SELECT count(*) FROM curated)')} AS pct FROM curated "
            "GROUP BY derived_genre"),
        "report_genre_distribution": _curated(
            f"SELECT derived_genre, count(*) AS rows, {pct(_N, '(SELECT count(*) FROM curated)')} AS pct FROM curated "
            "GROUP BY derived_genre UNION ALL SELECT 'Total', count(*), 100.0::DOUBLE FROM curated"),
        "report_filter": _from(
            f"{CURATED}, gaps AS ({_GAPS})",
            f"SELECT * FROM gaps WHERE contains(keyword_norm, lower('{FILTER_TEXT}')) AND derived_genre = '{FILTER_GENRE}'"),
        "rollup_keyword": _curated(
            f"SELECT keyword_norm, derived_genre, platform_group, count(*) AS search_count, "
            f"{_ABANDONED} AS abandoned_count FROM curated GROUP BY ALL"),
        "rollup_keyword_reports": _curated(
            f"SELECT keyword_norm, derived_genre, count(*) AS c, {pct(_ABANDONED, _N)} AS a FROM curated "
            f"WHERE {_PRESENT} GROUP BY ALL ORDER BY c DESC, keyword_norm, derived_genre LIMIT 20"),
        "report_pack": _from(f"{CURATED}, {_WINDOW}", f"SELECT section, row, coverage, 'complete' AS status FROM ({_pack_lines()}), captioned"),
        "rollup_report_pack": _from(_RECLASSIFIED, f"SELECT section, row, 'dt={LOOKUP_DAY}' AS days_read FROM ({_pack_lines()})"),
        "rollup_trending": _from(_RECLASSIFIED + _windows(), "SELECT * FROM grown"),
        "rollup_distinct_keywords": _curated(
            f"SELECT 'all' AS days, count(DISTINCT keyword_norm) AS kw, true AS near FROM curated UNION ALL "
            f"SELECT 'recent', count(DISTINCT keyword_norm), true FROM curated WHERE dt >= '{SINCE}'"),
        "report_refresh_summary": _from(
            trend, f"SELECT max(dt) AS dt, 'growth ≥ {TREND.min_growth}x' AS mode, "
            "(SELECT count(*) FROM grown) AS trending_rows, 0::BIGINT AS errors, NULL::VARCHAR AS messages FROM curated"),
        # keyword table
        "lut_unknown_keywords": _from(_MINED, "SELECT keyword_norm, cnt FROM mined"),
        "lut_candidates": _from(_MINED, "SELECT keyword_norm, cnt FROM candidates"),
        "lut_classifiable": f"""WITH named AS (SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN left(p_name, p_size % 5)
  WHEN 1 THEN repeat(' ', p_size % 3) || '{vocab.META_QUERIES[0]}' || CASE WHEN p_size % 5 = 0 THEN ' lại' ELSE '' END
  WHEN 2 THEN '  ' || left(p_name, p_size % 4) || '  ' ELSE p_name END AS keyword FROM part)
SELECT p_partkey, length(trim(keyword)) > 2 AND trim(keyword) <> '{vocab.META_QUERIES[0]}' AS classifiable FROM named""",
        "lut_batches": _from(_MINED, "SELECT CAST((rank - 1) // 3 AS INTEGER) AS batch_id, CAST(rank AS INTEGER) AS rank, "
                             "keyword_norm AS keyword FROM asked"),
        "lut_sanitize": r"""WITH marked AS (
  SELECT DISTINCT p_brand, replace(p_name, ' ', CASE WHEN p_size % 2 = 0 THEN '\' ELSE chr(9) END) || chr(10) AS keyword
  FROM part), ranked AS (
  SELECT CAST(p_brand[7:] AS INTEGER) AS batch_id, keyword,
    CAST(row_number() OVER (PARTITION BY p_brand ORDER BY keyword) AS INTEGER) AS rank FROM marked)
SELECT batch_id, rank, keyword, trim(regexp_replace(keyword, '[\x00-\x1f\x7f\\]', ' ', 'g')) AS clean FROM ranked
QUALIFY row_number() OVER (PARTITION BY batch_id, clean ORDER BY rank) = 1""",
        "lut_parse_replies": _from(_REPLIES, "SELECT batch_id, name, answer FROM pairs"),
        "lut_failed_replies": _from(_REPLIES, "SELECT DISTINCT batch_id, batch_id % 7 = 0 AS failed FROM named"),
        "lut_normalize_genre": "SELECT p_type, p_name, 'UNKNOWN' AS genre FROM part WHERE false UNION ALL "
                               f"SELECT DISTINCT p_type, p_name, CASE WHEN {_VERDICT} = 'UNKNOWN' THEN 'UNKNOWN' ELSE "
                               + _ALIASED.replace("answer", f"({_VERDICT})") + " END AS genre FROM part",
        "lut_apply_verdicts": _from(_APPLIED, "SELECT batch_id, keyword, genre FROM applied"),
        "lut_merge": _from(f"{_APPLIED}, {_LUT}, one AS (SELECT keyword, max(genre) AS genre FROM applied GROUP BY keyword)",
                           "SELECT keyword, genre FROM one UNION ALL SELECT keyword, genre FROM lut "
                           "WHERE keyword NOT IN (SELECT keyword FROM one)"),
        "lut_resolved": _from(
            f"{_APPLIED}, {_RESOLVED}", "SELECT keyword FROM resolved UNION SELECT p_name FROM named n "
            "WHERE batch_id % 7 <> 0 AND NOT EXISTS (SELECT 1 FROM applied a WHERE a.batch_id = n.batch_id "
            "AND a.keyword = n.p_name)"),
        "lut_roundtrip": _from(f"{_LUT}, {_RESOLVED}", "SELECT keyword, genre FROM lut UNION ALL "
                               "SELECT keyword, 'resolved' FROM resolved"),
        "lut_refresh": _from(
            _MINED, "SELECT (SELECT count(*) FROM asked WHERE keyword_norm LIKE '% gizmo') AS classified, "
            "(SELECT count(*) FROM lut) + (SELECT count(*) FROM asked WHERE keyword_norm LIKE '% gizmo') AS lut_size, "
            "(SELECT count(*) FROM resolved) + (SELECT count(*) FROM asked WHERE keyword_norm NOT LIKE '% gizmo') AS resolved, "
            "0::BIGINT AS errors, 'refreshed' AS message"),
        # quality, lineage, access
        "dq_evaluate": _from(quality, "SELECT rule, outcome, failure_reason, evaluated_metrics FROM results"),
        "dq_results_roundtrip": _from(quality, "SELECT rule, outcome, failure_reason, evaluated_metrics, "
                                      "'2024-01-31' AS run_date FROM results"),
        "dq_outcomes": _from(quality, "SELECT outcome, count(*) AS rules FROM results GROUP BY outcome"),
        "dq_failing_rules": _from(quality, "SELECT rule, count(*) AS occurrences FROM results WHERE outcome = 'Failed' "
                                  "GROUP BY rule"),
        "dq_gate": _from(quality, "SELECT rules, passed, " + pct("passed", "rules", 1, 4) + " AS score, "
                         + pct("passed", "rules", 1, 4) + " >= 0.5 AS proceed FROM (SELECT count(*) AS rules, "
                         "count(*) FILTER (WHERE outcome = 'Passed') AS passed FROM results)"),
        "lineage_counts": _from(DEDUPED, """SELECT *, output_rows / CAST(raw_rows AS DOUBLE) AS retention,
  output_rows / CAST(raw_rows AS DOUBLE) < 0.7 AS retention_alarm FROM (
  SELECT (SELECT count(*) FROM raw) AS raw_rows, (SELECT count(*) FROM usable) AS post_year_rows,
    (SELECT count(*) FROM deduped) AS post_dedup_rows, (SELECT count(*) FROM deduped) AS output_rows)"""),
        "contract_checks": _from(f"{quality}{_windows()}, gaps AS ({_GAPS}), hours AS ({_HOUR_GENRE})", f"""
SELECT 'curated partition has rows' AS name, count(*) > 0 AS ok, CAST(count(*) AS VARCHAR) AS detail FROM curated
  WHERE dt = '{LOOKUP_DAY}' AND derived_genre = 'PHIM_HAN'
UNION ALL SELECT 'quality results are visible', count(*) > 0, CAST(count(*) AS VARCHAR) FROM results
UNION ALL SELECT 'raw action is search', max(action) = 'search' AND min(action) = 'search', max(action) FROM raw
UNION ALL SELECT 'top trending row is a keyword', derived_genre <> 'EMPTY_QUERY', keyword_norm FROM (
  SELECT * FROM grown ORDER BY current_cnt DESC, keyword_norm, derived_genre LIMIT 1)
UNION ALL SELECT 'keyword lists are deep', n >= 100, CAST(n AS VARCHAR) FROM (
  SELECT (SELECT count(*) FROM grown) + (SELECT count(*) FROM gaps) AS n)
UNION ALL SELECT 'hour matrix is complete', count(*) >= 200, CAST(count(*) AS VARCHAR) FROM hours"""),
        "access_lut_view": _curated(
            "SELECT * EXCLUDE (event_ts, plan_names, user_id_hashed, search_session_id, has_premium, subscription_count), "
            f"{_TS.format('event_ts')} AS event_ts, CASE WHEN plan_names IS NOT NULL THEN "
            "coalesce(array_to_string(plan_names, ','), '') END AS plan_names FROM curated"),
        "dq_recommend": _from(CURATED + _RECOMMENDED[0], _RECOMMENDED[1]),
        "dq_job": _job(),
        # streams
        "curated_new_files": _curated(
            f"SELECT {CURATED_COLUMNS.replace('_pipeline_run_id, ', '')}, 2::BIGINT AS dirty_days, 0::BIGINT AS idle_files FROM curated"),
        "stream_ingest": _curated(
            f"SELECT {CURATED_COLUMNS.replace('_pipeline_run_id, ', '')}, (SELECT count(*) FROM raw WHERE {_UNDATED}) AS undated FROM curated").replace(
            "SELECT * FROM usable QUALIFY", f"SELECT * FROM usable WHERE NOT {_UNDATED} QUALIFY"),
        "stream_dedup": _from(TIMED + f""", arrived AS (
  SELECT *, dt <= '{ARRIVED_UNTIL}' AND CAST(eventid AS BIGINT) % 3 <> 0 AS early FROM usable WHERE NOT {_UNDATED}
), firsts AS (
  SELECT * FROM arrived QUALIFY row_number() OVER (PARTITION BY early, eventid ORDER BY event_ts, dt) = 1
), clock AS (SELECT max(event_ts) AS newest FROM arrived WHERE early)""", f"""
SELECT eventid, {_TS.format('event_ts')} AS event_ts, NULL::VARCHAR AS reason FROM firsts WHERE early
UNION ALL SELECT eventid, {_TS.format('event_ts')}, CASE WHEN event_ts < newest - INTERVAL 2 DAY THEN 'late' END FROM firsts, clock
  WHERE NOT early AND eventid NOT IN (SELECT eventid FROM firsts WHERE early)
UNION ALL SELECT eventid, {_TS.format('event_ts')}, 'undated' FROM usable WHERE {_UNDATED}"""),
        "access_checks": "SELECT * FROM (VALUES " + ", ".join(
            f"('columns hidden from {role}', true, '{','.join(vocab.HIDDEN_COLUMNS[role]) or 'all columns visible'}')" for role in ("lut_refresh", "reports", "quality")
        ) + f", ('columns hidden by a leaking view', false, '{','.join(vocab.HIDDEN_COLUMNS['lut_refresh'])}')) t(name, ok, detail)",
    }
    return sql
