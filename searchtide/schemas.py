"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "array<string>": T.ArrayType(T.StringType()),
}


def _struct(columns: str) -> T.StructType:
    """Schema from ``name type`` pairs; unlike ``fromDDL`` it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


#: raw event files, column names as they are on disk
RAW_FILES = _struct(
    "eventID string, datetime string, keyword string, category string, action string, platform string, "
    "networkType string, userPlansMap array<string>, proxy_isp string, user_id string"
)

#: raw events as every operator sees them
RAW = _struct(
    "eventid string, datetime string, keyword string, category string, action string, platform string, "
    "networktype string, userplansmap array<string>, proxy_isp string, user_id string, dt string"
)

#: curated events, in output order
CURATED = _struct(
    "event_id string, event_ts timestamp, hour_of_day_vn int, user_id_hashed string, "
    "user_is_authenticated boolean, session_action string, is_search_abandoned boolean, keyword_norm string, "
    "derived_genre string, platform_group string, network_type_norm string, isp_segment string, "
    "has_premium boolean, subscription_count int, plan_names array<string>, search_session_id string, "
    "is_repeat_search boolean, _pipeline_run_id string, dt string"
)

LUT = _struct("keyword string, genre string")
RESOLVED = _struct("keyword string")

#: JSON name of each quality-result column
DQ_JSON_NAMES = {
    "catalog_id": "catalogId",
    "database_name": "databaseName",
    "table_name": "tableName",
    "dq_run_id": "dqRunId",
    "evaluation_started_on": "evaluationStartedOn",
    "evaluation_completed_on": "evaluationCompletedOn",
    "rule": "rule",
    "outcome": "outcome",
    "failure_reason": "failureReason",
    "evaluated_metrics": "evaluatedMetrics",
}
DQ_RESULTS = _struct(", ".join(f"{name} string" for name in DQ_JSON_NAMES) + ", run_date date")
