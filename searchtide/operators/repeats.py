"""Repeat searches: does a search ask for the keyword last searched in the same session?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from searchtide.vocab import SESSION_SECONDS

#: a session with more rows than this is cut
HOT_ROWS = 1_000_000
#: letters of the event id by which rows of one instant are told apart when a session is cut
_PREFIX = 6

_SESSION = ("_session", "_key")
#: how a large session is cut, from coarse to fine; each level is in the order of the rows
_LEVELS = (("_slot",), ("_second",), ("event_ts", "_prefix"))


def mark_repeats(rows: DataFrame, split_null_sessions: bool = False, counted: DataFrame | None = None, hot_rows: int = HOT_ROWS,
                 hot_keys: Sequence[str | None] | None = None) -> DataFrame:
    """Add ``is_repeat_search`` to rows with ``session_key, event_ts, eventid, keyword_norm``.

    True where the latest earlier keyword of the session (rows without keyword are passed over)
    equals the row's keyword; null where the row has no keyword or no earlier one exists.
    ``split_null_sessions`` treats every row without a session key as its own session.

    Nothing runs while this is planned. Sessions of up to ``hot_rows`` rows are windows. Larger ones are found by a count (of
    ``counted``, rows with ``session_key`` from before an expensive step, by default of the rows themselves; a count that is too high does
    no harm), and there are at most rows / ``hot_rows`` of them, so their keys are broadcast. Their rows are cut by half hour, second,
    instant and the beginning of the event id, all of which follow from the row alone: each piece is a window of its own, and
    what it lacks is the latest keyword of the pieces before it, carried from the finest level to the coarsest. So no task
    holds more of a session than one instant's events with one beginning, and a retried task cuts as the first one did.

    A caller that has counted already names the large sessions in ``hot_keys``; if there are none, the rows are gone through once.
    """
    alone = F.col("session_key").isNull()
    marked = _marked(rows.where(~alone) if split_null_sessions else rows, counted, hot_rows, hot_keys)
    if split_null_sessions:
        marked = marked.unionByName(rows.where(alone).withColumn("is_repeat_search", F.lit(None).cast("boolean")))
    return marked


def _keyed(rows: DataFrame) -> DataFrame:
    # sessions without a key form one session, which is not that of the empty key
    return rows.withColumn("_session", F.xxhash64("session_key", F.col("session_key").isNull())).withColumn(
        "_key", F.concat(F.when(F.col("session_key").isNull(), "-").otherwise("+"), F.coalesce("session_key", F.lit(""))))


def _marked(rows: DataFrame, counted: DataFrame | None, hot_rows: int, hot_keys: Sequence[str | None] | None) -> DataFrame:
    keyed = _keyed(rows)
    if hot_keys is None:
        sizes = _keyed((rows if counted is None else counted).select("session_key")).groupBy(*_SESSION).count()
        hot = sizes.where(F.col("count") > hot_rows).select(*_SESSION)
    else:
        hot = _keyed(rows.sparkSession.createDataFrame([(k,) for k in hot_keys], "session_key string")).select(*_SESSION)
    usual = keyed if hot_keys is not None and not hot_keys else keyed.join(F.broadcast(hot), list(_SESSION), "left_anti")
    marked = usual.withColumn("_before", _latest_before(_SESSION, ("event_ts", "eventid")))
    if hot_keys is None or hot_keys:
        marked = marked.unionByName(_cut(keyed.join(F.broadcast(hot), list(_SESSION))))
    return marked.withColumn("is_repeat_search", F.col("keyword_norm") == F.col("_before")).select(*rows.columns, "is_repeat_search")


def _latest_before(group: Sequence[str], order: Sequence[str], keyword: str = "keyword_norm") -> Column:
    window = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.last(keyword, ignorenulls=True).over(window)


def _cut(rows: DataFrame) -> DataFrame:
    """The rows with ``_before``, the latest earlier keyword of their session."""
    seconds = F.unix_seconds("event_ts")
    pieces = rows.withColumn("_slot", F.floor(seconds / SESSION_SECONDS)).withColumn("_second", seconds).withColumn(
        "_prefix", F.coalesce(F.substring("eventid", 1, _PREFIX), F.lit("")))
    path = [*_SESSION, *(c for level in _LEVELS for c in level)]
    found = pieces.withColumn("_before", _latest_before(path, ("eventid",)))
    inner = ("eventid",)
    ends, keyword = pieces, "keyword_norm"
    for level in reversed(_LEVELS):
        latest = F.max(F.when(F.col(keyword).isNotNull(), F.struct(*inner, F.col(keyword).alias("word"))))
        ends = ends.groupBy(*path).agg(latest["word"].alias("_end"))
        path = path[: -len(level)]
        carried = ends.select(*path, *level, _latest_before(path, level, "_end").alias("_carried")).where("_carried is not null")
        found = found.join(carried, [*path, *level], "left").withColumn("_before", F.coalesce("_before", "_carried")).drop("_carried")
        inner, keyword = level, "_end"
    return found.drop("_slot", "_second", "_prefix")
