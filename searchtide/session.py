"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

#: settings that change results or are needed for whole results
REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "DYNAMIC",
}

#: settings that only change speed
TUNING = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
}


def build_session(app_name: str = "searchtide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**TUNING, **REQUIRED, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_settings(spark: SparkSession) -> SparkSession:
    """Apply the result-changing settings to a session somebody else created."""
    for key, value in REQUIRED.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session, where the driver
    and the executors share one machine, may fall back to a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="searchtide-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def ready_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint()`` usable."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


#: input data per shuffle task; rows shrink to narrow columns before they move, so a task gets less than this
SHUFFLE_TASK_BYTES = 2 * 1024**3


def shuffle_tasks(spark: SparkSession, input_bytes: int) -> int:
    """Shuffle partitions for a job that reads so many bytes; never fewer than the session has.

    100 TB give about 50,000. Pass the number on (see :func:`sized`); the caller's session keeps its own.
    """
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-input_bytes // SHUFFLE_TASK_BYTES))


def sized(spark: SparkSession, input_bytes: int) -> SparkSession:
    """A session of the same application with settings of its own, sized for the input.

    Jobs in other threads keep their settings. Temporary views are not shared.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            own.conf.set(key, value)
    own.conf.set("spark.sql.shuffle.partitions", str(shuffle_tasks(spark, input_bytes)))
    return own
