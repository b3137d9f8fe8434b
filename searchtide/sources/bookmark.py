"""Which raw files have been curated: a ledger of (path, length, time), kept in the versioned table the rows go to.

A file that is new, changed or gone since the ledger was written makes its day dirty, however old the day is. Files are listed and
compared by tasks; the driver sees days.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.sources import versions
from searchtide.sources.raw import DAY_FOLDER

FILES = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("length", T.LongType()), T.StructField("modified", T.TimestampType()),
])
PART = "kind=files"
#: additions to the ledger before it is written anew
MOST_PARTS = 16


def listed(spark: SparkSession, *roots: str) -> DataFrame:
    """All Parquet files below the folders, without opening them. More than a few dozen folders are listed by tasks."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return reader.load(list(roots)).select("path", "length", F.col("modificationTime").alias("modified"))


def curated_files(spark: SparkSession, table: str, version: versions.Version | None = None) -> DataFrame:
    """The ledger of a version of the table."""
    return versions.read(spark, table, FILES, version, [PART])


def with_day(files: DataFrame) -> DataFrame:
    """Files with the day folder they lie in, empty if none, and with that folder's path."""
    return files.withColumn("day", F.regexp_extract("path", DAY_FOLDER, 1)).withColumn("folder", F.regexp_extract("path", r"^(.*)/[^/]*$", 1))


def changed(files: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Files that are not in the ledger as they are, and entries of the ledger that are no longer so."""
    return files.join(known, FILES.names, "left_anti"), known.join(files, FILES.names, "left_anti")


def record(spark: SparkSession, version: versions.Version, commit: str, new: DataFrame, files: DataFrame, whole: bool) -> dict[str, tuple[str, ...]]:
    """Write new entries, or the whole list, into a commit; the change to publish."""
    parts = version.parts.get(PART, ())
    whole = whole or len(parts) >= MOST_PARTS
    (files if whole else new).select(*FILES.names).write.parquet(f"{commit}/{PART}")
    own = f"{commit.rsplit('/', 1)[1]}/{PART}"
    return {PART: (own,) if whole else (*parts, own)}


def days_around(days: Iterable[str], reach: int) -> list[str]:
    """The given ``YYYYMMDD`` days and those up to ``reach`` days away. What is no day stays alone."""
    found = set(days)
    for day in list(found):
        try:
            at = datetime.strptime(day, "%Y%m%d")
        except ValueError:
            continue
        found.update((at + timedelta(days=d)).strftime("%Y%m%d") for d in range(-reach, reach + 1))
    return sorted(found)
