"""Deduplication of an endless stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.operators.dedup import earliest, fingerprint
from searchtide.plans.curate import usable_events
from searchtide.schemas import RAW
from searchtide.sources import folders, versions
from searchtide.streaming import ledger
from searchtide.streaming.ingest import last_batch

ROWS, SIDE, CLOCK = "kind=rows", "kind=side", "kind=clock"
_EVENT = T.StructType([*RAW.fields, T.StructField("event_ts", T.TimestampType())])
_SIDE = T.StructType([*_EVENT.fields, T.StructField("reason", T.StringType())])


def first_events(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Usable events of a raw stream, the first arrival of each id, within a bounded state.

    State must end somewhere, so unlike the batch job this finds copies only while their event
    times lie within ``delay`` of each other, and it drops rows older than that. :func:`append_once` does neither.
    """
    return usable_events(stream).withWatermark("event_ts", delay).dropDuplicatesWithinWatermark(["eventid"])


def append_to(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append everything that has arrived to a Parquet folder, then stop."""
    query = (
        stream.writeStream.format("parquet").outputMode("append").option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def append_once(stream: DataFrame, root: str, checkpoint: str, delay: str = "2 days", run_id: str = "dedup") -> None:
    """Append the first arrival of each event id to a versioned table, then stop.

    Copies are found over any distance in time, by the ledger of ids; of copies in one batch the earliest stays. Nothing is lost
    silently: a row without a day folder goes to the side table as ``undated``, and one whose event is not known and more than
    ``delay`` older than the newest event of the batches before as ``late``. Rows without a usable time are dropped, as in the
    batch job. Rows, side table, ledger and clock change in one step; a batch that runs twice is published once. A batch is read more
    than once, its ids first, so the stream must give the same rows each time, as files do.
    """
    def process(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        base = versions.current(spark, root)
        if last_batch(spark, root, base, run_id) >= number:
            return
        work = f"{root}/work/{uuid.uuid4().hex}"
        try:
            versions.publish(spark, root, base, _batch(spark, root, base, work, batch, delay), f"{run_id}-{number}", also_read=base.parts)
        finally:
            folders.remove(spark, work)

    query = (
        stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()


def _batch(spark: SparkSession, root: str, base: versions.Version, work: str, batch: DataFrame, delay: str) -> dict[str, tuple[str, ...]]:
    commit = versions.new_commit(root)
    own = commit.rsplit("/", 1)[1]
    dated = F.coalesce(F.col("dt").rlike(r"^\d{8}$"), F.lit(False))
    # by the ids alone, before any row is moved; more ids than those of usable events do no harm
    seen, _ = ledger.known(spark, root, base, batch.where(dated).select(ledger.id_key(F.col("eventid")).alias("id_key")), work)
    clock = versions.read(spark, root, T.StructType([T.StructField("newest", T.TimestampType())]), base, [CLOCK]).agg(
        F.unix_micros(F.max("newest"))).first()[0]
    late = F.lit(False) if clock is None else F.col("event_ts") < F.timestamp_micros(F.lit(clock)) - F.expr(f"interval {delay}")

    timed = usable_events(batch.where(dated))
    arrived = Observation()
    marked = timed.withColumn("fingerprint", fingerprint(timed)).withColumn("id_key", ledger.id_key(F.col("eventid"))).observe(
        arrived, F.unix_micros(F.max("event_ts")).alias("newest"))
    # rows move once: copies go and known events are left out where the rows of an id have been gathered
    new = earliest(marked, "id_key", "fingerprint").join(seen.select("id_key"), "id_key", "left_anti").withColumn("reason", F.when(late, "late"))
    undated = usable_events(batch.where(~dated)).withColumn("reason", F.lit("undated"))
    kind = F.when(F.col("reason").isNull(), ROWS.removeprefix("kind=")).otherwise(SIDE.removeprefix("kind="))
    new.select(*_SIDE.names).unionByName(undated.select(*_SIDE.names)).withColumn("kind", kind).write.partitionBy("kind").parquet(commit)
    added = versions.written_parts(spark, commit, 1)

    stored = spark.read.schema(_SIDE).parquet(commit).where("reason is null or reason = 'late'").select(*_EVENT.names)
    # late events are known from now on, so that their copies are not set aside again
    stored = stored.withColumn("fingerprint", fingerprint(stored)).withColumn("id_key", ledger.id_key(F.col("eventid")))
    added |= ledger.add(stored.select(*ledger.ENTRY.names), commit)
    changes = {part: (*base.parts.get(part, ()), *where) for part, where in added.items()}
    changes |= ledger.merged(spark, root, versions.Version(base.number, "", (), {**base.parts, **changes}), versions.new_commit(root))
    # the observation of a plan that turned out empty is never answered
    answered = any(part.startswith(ledger.IDS) for part in added)
    newest = arrived.get["newest"] if answered else timed.agg(F.unix_micros(F.max("event_ts"))).first()[0]
    spark.range(1).select(F.timestamp_micros(F.lit(newest).cast("long")).alias("newest")).write.parquet(f"{commit}/{CLOCK}")
    changes[CLOCK] = (*base.parts.get(CLOCK, ()), f"{own}/{CLOCK}")
    return changes


def rows(spark: SparkSession, root: str) -> DataFrame:
    """Events that :func:`append_once` kept."""
    return versions.read(spark, root, _EVENT, parts=[ROWS])


def side_rows(spark: SparkSession, root: str) -> DataFrame:
    """Rows that it set aside, with the ``reason``."""
    return versions.read(spark, root, _SIDE, parts=[SIDE])
