"""Raw event files: Parquet in bare ``YYYYMMDD`` folders."""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.schemas import RAW, RAW_FILES
from searchtide.sources import folders

#: columns whose name on disk differs from the name used everywhere else
_DISK_NAMES = {"eventID": "eventid", "networkType": "networktype", "userPlansMap": "userplansmap"}
DAY_FOLDER = r"/(\d{8})/"


def parse_since(argument: str | None) -> date | None:
    """First day to read from ``"dt >= 2022-06-01"``; ``all``, ``none`` and blank mean every day."""
    text = (argument or "").strip()
    if text.lower() in ("", "all", "none"):
        return None
    found = re.fullmatch(r"(?:dt\s*>=\s*)?'?(\d{4}-\d{2}-\d{2})'?", text)
    if not found:
        raise ValueError(f"not a day limit: {argument!r}")
    return date.fromisoformat(found.group(1))


def day_of_file() -> Column:
    """Day folder of the file a row comes from; empty if it lies in none."""
    return F.regexp_extract(F.col("_metadata.file_path"), DAY_FOLDER, 1)


def named_as_used(files: DataFrame) -> DataFrame:
    return files.withColumn("dt", day_of_file()).withColumnsRenamed(_DISK_NAMES).select(*RAW.names)


def _since_paths(spark: SparkSession, root: str, since: date) -> list[str]:
    """Folders to read: day folders from ``since`` on, and folders that are no day (they may hold some)."""
    first = since.strftime("%Y%m%d")
    return [
        f"{root}/{name}" for name in folders.subfolders(spark, root)
        if not name.startswith(("_", ".")) and (not re.fullmatch(r"\d{8}", name) or name >= first)
    ]


def read_raw(spark: SparkSession, root: str, since: date | None = None) -> DataFrame:
    """All raw events below ``root``, or those in day folders from ``since`` on.

    With ``since`` the older folders are not even listed. The condition on the day is kept, for
    day folders further down; it rests on the file path alone, so Spark drops files by it.
    """
    reader = spark.read.schema(RAW_FILES).option("recursiveFileLookup", "true").option("mergeSchema", "false")
    root = root.rstrip("/")
    if since is None:
        return named_as_used(reader.parquet(root))
    paths = _since_paths(spark, root, since)
    if not paths:
        return spark.createDataFrame([], RAW)
    return named_as_used(reader.parquet(*paths)).where(F.try_to_date("dt", "yyyyMMdd") >= F.lit(since))


def read_folders(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw events of the files directly in the given folders."""
    if not paths:
        return spark.createDataFrame([], RAW)
    return named_as_used(spark.read.schema(RAW_FILES).option("mergeSchema", "false").parquet(*paths))


def raw_bytes(spark: SparkSession, root: str, since: date | None = None) -> int:
    """Bytes of the files that :func:`read_raw` would read. Many folders are listed by tasks."""
    root = root.rstrip("/")
    paths = [root] if since is None else _since_paths(spark, root, since)
    if not paths:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(paths)
    return files.agg(F.sum("length")).first()[0] or 0


def write_raw(rows: DataFrame, root: str) -> None:
    """Lay rows out as a raw landing folder: one bare folder per day, names as on disk."""
    spark = rows.sparkSession
    back = {used: disk for disk, used in _DISK_NAMES.items()}
    gathered = rows.withColumnsRenamed(back).withColumnRenamed("dt", "day").hint("rebalance", F.col("day"))
    gathered.write.mode("overwrite").partitionBy("day").parquet(root)
    for name in folders.subfolders(spark, root):
        if name.startswith("day="):
            folders.rename(spark, f"{root}/{name}", f"{root}/{name[4:]}")
