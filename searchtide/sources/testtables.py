"""Raw search events derived from the benchmark tables ``events`` and ``part``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.plans.curate import CurationRules
from searchtide.schemas import RAW

#: genre words of the derived events, in order of precedence
WORD_PATTERNS = (("NHAC", "ring"), ("ANIME", "widget"), ("PHIM_HAN", "plate"), ("THE_THAO", "bolt"))
TEST_RULES = CurationRules(patterns=WORD_PATTERNS)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: raw columns from an event ``event_id, ts, user_id, event_type`` and the part name ``p_name`` its key points to
_RAW_COLUMNS = {
    "eventid": "string(event_id)",
    "datetime": """case when event_id % 499 = 0 then '0004-01-01 00:00:00.000' when event_id % 503 = 0 then 'bad'
        else date_format(ts, 'yyyy-MM-dd HH:mm:ss.SSS') end""",
    "keyword": """case when event_id % 11 = 0 then null when event_id % 37 = 0 then ''
        when event_id % 13 = 0 then upper(p_name) || ' ' else p_name end""",
    "category": """case event_type when 'error' then 'quit' when 'purchase' then 'enter' when 'signup' then null
        else event_type end""",
    "action": "'search'",
    "platform": "element_at(array('android', 'ios', 'smarttv', 'web', 'Samsung', null), int(event_id % 6 + 1))",
    "networktype": "element_at(array('WiFi', '4g', '5g', 'ethernet', null), int(event_id % 5 + 1))",
    "userplansmap": """case event_id % 4 when 1 then cast(array() as array<string>)
        when 2 then array('VIP:30', 'SPORT: x') when 3 then array('BASIC', ' K+ :7') end""",
    "proxy_isp": "case when event_id % 97 != 0 then 'isp' || string(event_id % 3) end",
    "user_id": "case when event_id % 5 != 0 then string(user_id % 4) end",
    "dt": "date_format(day, 'yyyyMMdd')",
}


def as_raw(events: DataFrame, parts: DataFrame) -> DataFrame:
    """One raw search event per row of ``events``, and a copy of every fiftieth in the next day's folder.

    Works on a stream as well.
    """
    k = r"""bigint(regexp_extract(props, '"k":\\s*(\\d+)', 1))"""
    # every second event asks for one of a few popular names, the others spread over the whole table
    place = f"if(event_id % 2 = 0, {k} % 20, ({k} * 97 + event_id) % {max(1, parts.count())}L)"
    stamped = events.selectExpr("event_id", "timestamp(ts) as ts", "user_id", "event_type", f"{place} as p_partkey")
    arrivals = stamped.join(parts.select("p_partkey", "p_name"), "p_partkey").selectExpr(
        "*", "explode(if(event_id % 50 = 0, array(ts, ts + interval 1 day), array(ts))) as at")
    # three days without a folder of their own
    arrivals = arrivals.selectExpr("*", "if(day(at) in (10, 17, 18), at + interval 3 days, at) as day")
    return arrivals.selectExpr(*[f"{_RAW_COLUMNS[name]} as {name}" for name in RAW.names])


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    return as_raw(table(spark, folder, "events"), table(spark, folder, "part"))
