"""Keyword table and resolved set, kept as versions (:mod:`searchtide.sources.versions`).

Both tables change in one step, or not at all. A writer names the version it started from; if somebody else has published one
since, it fails, so that no verdict is lost to a writer that had not seen it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from searchtide.schemas import LUT, RESOLVED
from searchtide.sources import folders, versions

_LUT, _RESOLVED = "lut", "resolved"


def current(spark: SparkSession, root: str) -> versions.Version:
    return versions.current(spark, root)


def load(spark: SparkSession, root: str, version: versions.Version | None = None) -> tuple[DataFrame, DataFrame]:
    """``(lut, resolved)`` of a version, by default the newest; empty tables where nothing was saved yet."""
    version = version or current(spark, root)
    return versions.read(spark, root, LUT, version, [_LUT]), versions.read(spark, root, RESOLVED, version, [_RESOLVED])


def save(spark: SparkSession, root: str, lut: DataFrame, resolved: DataFrame | None = None, base: versions.Version | None = None) -> int:
    """Publish a new version and return its number. A keyword has one genre, and one that has a genre is not also resolved.

    Without ``resolved`` the resolved set of the version before stays, but for keywords that have a genre now.
    """
    base = current(spark, root) if base is None else base
    commit = versions.new_commit(root)
    own = commit.rsplit("/", 1)[1]
    lut.groupBy("keyword").agg(F.max("genre").alias("genre")).write.parquet(f"{commit}/{_LUT}")
    known = spark.read.schema(LUT).parquet(f"{commit}/{_LUT}")
    resolved = versions.read(spark, root, RESOLVED, base, [_RESOLVED]) if resolved is None else resolved
    resolved.select("keyword").distinct().join(known, "keyword", "left_anti").write.parquet(f"{commit}/{_RESOLVED}")
    try:
        return versions.publish(spark, root, base, {name: (f"{own}/{name}",) for name in (_LUT, _RESOLVED)}).number
    except versions.Conflict:
        folders.remove(spark, commit)
        raise
