"""Curate new raw files as they arrive, session by session.

Everything a batch leaves behind is published as one version of one table (:mod:`searchtide.sources.versions`), so rows and state
never part: the curated rows (``dt=.../derived_genre=...``), the ledger of event ids (:mod:`searchtide.streaming.ledger`), the *tails*
(the latest keyword of each session, by day of the event) and a side table of rows that belong to no day.

A batch touches only its own sessions. Where its rows come after the tail of their session, the repeat flag follows from the
tail, and the rows are added as new files. Where they come before it, or where a copy that had been kept gives way to an
earlier one, that session is read again from the day folders its tail names, and only folders in which a flag changes or a row goes
are written anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.functions import moments
from searchtide.operators.classify import classify
from searchtide.operators.dedup import fingerprint, keep_first_event
from searchtide.operators.repeats import mark_repeats
from searchtide.plans.curate import CurationRules, finished, usable_events, with_keyword, with_session_key
from searchtide.schemas import CURATED, RAW, RAW_FILES
from searchtide.sources import folders, versions
from searchtide.sources.curated import PARTITIONS
from searchtide.sources.raw import named_as_used
from searchtide.streaming import ledger

SIDE, TAILS = "kind=side", "kind=tails"
#: files of a day of tails before they are merged
MOST_TAILS = 16
_SIDE = T.StructType([*RAW.fields, T.StructField("reason", T.StringType())])
_POINT = T.StructType([T.StructField("event_ts", T.TimestampType()), T.StructField("event_id", T.StringType())])
_TAIL = T.StructType([
    T.StructField("session", T.StringType()), T.StructField("last", _POINT), T.StructField("word", T.StringType()),
    T.StructField("days", T.ArrayType(T.StringType())), T.StructField("batch", T.LongType()),
])
#: columns by which the flag of a row is found and its row is found again
_FLAGGED = ("search_session_id", "event_ts", "event_id", "keyword_norm", "is_repeat_search", *PARTITIONS)
#: day of the tail of events without a session, which form one session over all days
_NO_DAY = "none"


def raw_stream(spark: SparkSession, root: str, files_per_trigger: int | None = None) -> DataFrame:
    """Raw events from day folders below ``root``, each file once."""
    reader = spark.readStream.schema(RAW_FILES).option("recursiveFileLookup", "true")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return named_as_used(reader.parquet(root))


def side_rows(spark: SparkSession, root: str) -> DataFrame:
    """Raw rows that the stream set aside, with the ``reason``."""
    return versions.read(spark, root, _SIDE, parts=[SIDE])


def side_counts(spark: SparkSession, root: str) -> DataFrame:
    return side_rows(spark, root).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def ingest(
    stream: DataFrame,
    target: str,
    checkpoint: str,
    lut: DataFrame | None = None,
    rules: CurationRules = CurationRules(),
    run_id: str = "stream",
) -> None:
    """Process everything that has arrived since the last call, then stop.

    The table equals what the batch job makes of all files so far, but that rows of files outside any day folder go to the side
    table instead of an unnamed day. ``target`` and ``checkpoint`` belong together; a batch that runs twice is published once. Nobody
    else may write to the table. Events without a session form one session over all days, so a batch that has such events reads those
    of all days again; with ``split_null_sessions`` it does not.
    """
    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base = versions.current(spark, target)
        run = f"{run_id}-{number}"
        if last_batch(spark, target, base, run_id) >= number:
            return
        work = f"{target}/work/{uuid.uuid4().hex}"
        try:
            _Batch(spark, target, base, work, run, number, lut, rules).process(batch)
        finally:
            folders.remove(spark, work)

    query = (
        stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def last_batch(spark: SparkSession, root: str, newest: versions.Version, run_id: str) -> int:
    """Number of the batch published last; a batch publishes one version, so this is found at the end of the list."""
    for number in range(newest.number, 0, -1):
        name, _, batch = (newest if number == newest.number else versions.at(spark, root, number)).run.rpartition("-")
        if name == run_id:
            return int(batch)
    return -1


def _place() -> Column:
    return F.struct("event_ts", "event_id")


def _tail_day(session: Column, event_ts: Column) -> Column:
    return F.when(session.isNull(), _NO_DAY).otherwise(F.date_format(event_ts, "yyyy-MM-dd"))


class _Batch:
    def __init__(self, spark: SparkSession, root: str, base: versions.Version, work: str, run: str, number: int,
                 lut: DataFrame | None, rules: CurationRules) -> None:
        self.spark, self.root, self.base, self.work, self.run, self.number, self.lut, self.rules = spark, root, base, work, run, number, lut, rules
        # rows, whose folders are partitions, and state lie in commits of their own
        self.commit, self.rows = versions.new_commit(root), versions.new_commit(root)
        self.own = self.commit.rsplit("/", 1)[1]

    def _written(self, rows: DataFrame, name: str) -> DataFrame:
        rows.write.parquet(f"{self.work}/{name}")
        return self.spark.read.schema(rows.schema).parquet(f"{self.work}/{name}")

    def process(self, batch: DataFrame) -> None:
        dated = F.coalesce(F.col("dt").rlike(r"^\d{8}$"), F.lit(False))
        changes: dict[str, tuple[str, ...]] = {}
        batch = self._written(batch, "arrived")
        stray = batch.where(~dated)
        if not stray.isEmpty():
            stray.withColumn("reason", F.lit("undated")).write.parquet(f"{self.commit}/{SIDE}")
            changes[SIDE] = (*self.base.parts.get(SIDE, ()), f"{self.own}/{SIDE}")
        fresh, displaced = self._winners(batch.where(dated), changes)
        if fresh is not None:
            self._merge(fresh, displaced, changes)
        versions.publish(self.spark, self.root, self.base, changes, self.run, also_read=self.base.parts)

    def _winners(self, batch: DataFrame, changes: dict) -> tuple[DataFrame | None, DataFrame | None]:
        """Events of the batch that hold against all that came before, as curated rows; and the entries that give way to them."""
        events = usable_events(batch)
        first = keep_first_event(events)
        first = self._written(first.withColumn("fingerprint", fingerprint(first)).withColumn("id_key", ledger.id_key(F.col("eventid"))), "first")
        if first.isEmpty():
            return None, None
        before, self.opened = ledger.known(self.spark, self.root, self.base, first, self.work)
        before = before.select("id_key", F.struct("event_ts", "dt", "fingerprint").alias("before"))
        better = F.col("before").isNull() | (F.struct("event_ts", "dt", "fingerprint") < F.col("before"))
        won = self._written(first.join(before, "id_key", "left").where(better), "won")
        if won.isEmpty():
            return None, None
        for part, where in ledger.add(won.select(*ledger.ENTRY.names), self.commit).items():
            changes[part] = (*self.base.parts.get(part, ()), *where)
        state = versions.Version(self.base.number, "", (), {**self.base.parts, **changes})
        # files of this commit can be read before it is published
        changes |= ledger.merged(self.spark, self.root, state, versions.new_commit(self.root))
        named = with_session_key(with_keyword(won)).withColumn("is_repeat_search", F.lit(None).cast("boolean"))
        prepared = classify(named, self.lut, self.rules.patterns, self.rules.near_spellings, self.rules.near_min_length, self.rules.near_edits)
        fresh = finished(prepared.withColumn("dt", moments.iso_day(F.col("dt"))), self.run, self.rules)
        displaced = won.where("before is not null").select("eventid", moments.iso_day(F.col("before.dt")).alias("dt"))
        return self._written(fresh, "fresh"), self._written(displaced, "displaced")

    def _curated(self, days: list[str]) -> DataFrame:
        """Rows of the table in the day folders."""
        wanted = {f"dt={d}" for d in days}
        return versions.read(self.spark, self.root, CURATED, self.base, [p for p in self.base.parts if p.split("/")[0] in wanted])

    def _days(self, rows: DataFrame, column: Column) -> list[str]:
        # one value per day
        return [r[0] for r in rows.select(column).distinct().collect()]

    def _merge(self, fresh: DataFrame, displaced: DataFrame, changes: dict) -> None:
        session = F.col("search_session_id")
        days_of_displaced = self._days(displaced, F.col("dt"))
        gone_key = displaced.select(F.col("eventid").alias("gone_id"), F.col("dt").alias("gone_dt"), F.lit(True).alias("gone"))
        is_gone = F.col("event_id").eqNullSafe(F.col("gone_id")) & (F.col("dt") == F.col("gone_dt"))
        gone = self._written(self._curated(days_of_displaced).join(gone_key, is_gone, "left_semi"), "gone")

        touched = fresh.groupBy(session.alias("session")).agg(
            F.min(_place()).alias("first"), F.max(_place()).alias("new_last"),
            F.max(F.when(F.col("keyword_norm").isNotNull(), F.struct("event_ts", "event_id", "keyword_norm")))["keyword_norm"].alias("new_word"),
            F.collect_set("dt").alias("new_days"), F.first(_tail_day(session, F.col("event_ts"))).alias("day"), F.count(F.lit(1)).alias("rows"))
        removed = gone.groupBy(session.alias("of")).agg(F.lit(True).alias("removed"), F.first(_tail_day(session, F.col("event_ts"))).alias("of_day"))
        touched = touched.join(removed, F.col("session").eqNullSafe(F.col("of")), "full").select(
            F.when(F.col("day").isNull(), F.col("of")).otherwise(F.col("session")).alias("session"), F.coalesce("day", "of_day").alias("day"),
            "first", "new_last", "new_word", "new_days", "rows", F.coalesce("removed", F.lit(False)).alias("removed"))
        tails = self._tails(self._days(touched, F.col("day"))).withColumnRenamed("session", "s")
        touched = touched.join(tails, F.col("session").eqNullSafe(F.col("s")), "left").drop("s", "batch")
        alone = F.col("session").isNull() if self.rules.split_null_sessions else F.lit(False)
        again = F.col("last").isNotNull() & (F.col("removed") | (F.col("first") <= F.col("last"))) & ~alone
        touched = self._written(touched.withColumn("again", again), "touched")

        reopened = touched.where("again")
        days = self._days(reopened.select(F.explode("days").alias("d")), F.col("d"))
        keys = reopened.select(F.col("session").alias("s"))
        of_key = session.eqNullSafe(F.col("s"))
        # what the flag depends on; the other columns of rows that stay are read where their folder is written anew
        old = self._curated(days).select(*_FLAGGED).join(keys, of_key, "left_semi").join(gone_key, is_gone, "left_anti")
        old = self._written(old, "old")
        # all rows of reopened sessions; in others, the tail stands for the rows before
        tail = touched.where("not again and word is not null").select(
            F.col("session").alias("search_session_id"), "last.event_ts", "last.event_id", F.col("word").alias("keyword_norm"))
        together = fresh.withColumn("role", F.lit("new")).unionByName(
            old.withColumnRenamed("is_repeat_search", "was").withColumn("role", F.lit("old")), allowMissingColumns=True).unionByName(
            tail.withColumn("role", F.lit("tail")), allowMissingColumns=True)
        sizes = touched.select("session", "rows").unionByName(old.groupBy(session.alias("session")).agg(F.count(F.lit(1)).alias("rows")))
        # at most one key per hot_session_rows
        hot = [r["session"] for r in sizes.groupBy("session").agg(F.sum("rows").alias("rows")).where(F.col("rows") >= self.rules.hot_session_rows).collect()]
        flagged = self._written(self._flags(together, hot).where("role != 'tail'"), "flagged")
        fresh_rows = flagged.where("role = 'new'")

        # folders with a row that goes or changes are written anew, all others are added to
        now = F.col("is_repeat_search").alias("is_now")
        changed = flagged.where(F.col("role") == "old").where(~F.col("was").eqNullSafe(F.col("is_repeat_search"))).select(
            *PARTITIONS, F.col("event_id").alias("f_id"), F.col("dt").alias("f_dt"), now, F.lit(True).alias("flagged"))
        changed = self._written(changed, "changed")
        folders_changed = changed.select(*PARTITIONS).unionByName(gone.select(*PARTITIONS)).distinct()
        # one value per day and genre
        rewritten = {f"dt={r['dt']}/derived_genre={r['derived_genre']}" for r in folders_changed.collect()}
        kept = versions.read(self.spark, self.root, CURATED, self.base, sorted(rewritten)).join(gone_key, is_gone, "left_anti").join(
            changed.select("f_id", "f_dt", "is_now", "flagged"), F.col("event_id").eqNullSafe(F.col("f_id")) & (F.col("dt") == F.col("f_dt")), "left")
        kept = kept.withColumn("is_repeat_search", F.when(F.col("flagged"), F.col("is_now")).otherwise(F.col("is_repeat_search"))).select(*CURATED.names)
        rows = fresh_rows.select(*CURATED.names).unionByName(kept)
        rows.hint("rebalance", *[F.col(k) for k in PARTITIONS]).sortWithinPartitions(*PARTITIONS).write.partitionBy(*PARTITIONS).parquet(self.rows)
        self._take_rows(rewritten, changes)
        self._write_tails(touched, flagged, changes)

    def _flags(self, rows: DataFrame, hot: list[str | None]) -> DataFrame:
        """The repeat flag of rows that are all of their session, or all after its tail, which is among them."""
        named = rows.drop("is_repeat_search").withColumnsRenamed({"search_session_id": "session_key", "event_id": "eventid"})
        marked = mark_repeats(named, self.rules.split_null_sessions, hot_keys=hot)
        return marked.withColumnsRenamed({"session_key": "search_session_id", "eventid": "event_id"}).select(*rows.columns)

    def _take_rows(self, rewritten: set[str], changes: dict) -> None:
        written = versions.written_parts(self.spark, self.rows, len(PARTITIONS))
        for part, where in written.items():
            changes[part] = where if part in rewritten else (*self.base.parts.get(part, ()), *where)
        for part in rewritten - set(written):
            changes[part] = ()

    def _tails(self, days: list[str]) -> DataFrame:
        """The tails of the sessions of some days, the latest of each."""
        rows = versions.read(self.spark, self.root, _TAIL, self.base, [f"{TAILS}/day={d}" for d in days])
        return rows.groupBy("session").agg(F.max_by(F.struct(*_TAIL.names), "batch").alias("t")).select("t.*")

    def _write_tails(self, touched: DataFrame, flagged: DataFrame, changes: dict) -> None:
        whole = flagged.groupBy(F.col("search_session_id").alias("s")).agg(
            F.max(_place()).alias("all_last"), F.collect_set("dt").alias("all_days"),
            F.max(F.when(F.col("keyword_norm").isNotNull(), F.struct("event_ts", "event_id", "keyword_norm")))["keyword_norm"].alias("all_word"))
        onward = touched.where("not again and new_last is not null").select(
            "session", "day", F.coalesce(F.greatest("last", "new_last"), "new_last").alias("last"), F.coalesce("new_word", "word").alias("word"),
            F.array_distinct(F.concat(F.coalesce("days", F.array().cast("array<string>")), "new_days")).alias("days"))
        renewed = touched.where("again").join(whole, F.col("session").eqNullSafe(F.col("s"))).select(
            "session", "day", F.col("all_last").alias("last"), F.col("all_word").alias("word"), F.col("all_days").alias("days"))
        new = onward.unionByName(renewed).withColumn("batch", F.lit(self.number).cast("long"))
        # sessions all of whose rows went
        emptied = touched.where("again").join(whole, F.col("session").eqNullSafe(F.col("s")), "left_anti").select(
            "session", "day", F.lit(None).cast(_POINT).alias("last"), F.lit(None).cast("string").alias("word"),
            F.array().cast("array<string>").alias("days"), F.lit(self.number).cast("long").alias("batch"))
        new = self._written(new.unionByName(emptied), "tails")
        full = [d for d in self._days(new, F.col("day")) if len(self.base.parts.get(f"{TAILS}/day={d}", ())) >= MOST_TAILS - 1]
        for day in full:
            before = self._tails([day]).withColumn("day", F.lit(day))
            new = new.unionByName(before.join(new.select(F.col("session").alias("s")), F.col("session").eqNullSafe(F.col("s")), "left_anti").select(*new.columns))
        new.select(*_TAIL.names, "day").write.partitionBy("day").parquet(f"{self.commit}/{TAILS}")
        for name in folders.subfolders(self.spark, f"{self.commit}/{TAILS}"):
            part = f"{TAILS}/{name}"
            before_parts = () if name[4:] in full else self.base.parts.get(part, ())
            changes[part] = (*before_parts, f"{self.own}/{part}")
