"""The few file-system calls Spark's readers and writers do not offer, for any Hadoop file system."""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    location = jvm.org.apache.hadoop.fs.Path(path)
    return location.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), location


def exists(spark: SparkSession, path: str) -> bool:
    files, location = _open(spark, path)
    return files.exists(location)


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly below ``path``."""
    files, location = _open(spark, path)
    if not files.exists(location):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(location) if status.isDirectory())


def files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path``."""
    system, location = _open(spark, path)
    if not system.exists(location):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(location) if status.isFile())


def read_text(spark: SparkSession, path: str) -> str:
    system, location = _open(spark, path)
    stream = system.open(location)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is there whole or not at all; false, and nothing is changed, if it exists already."""
    system, location = _open(spark, path)
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    stream = system.create(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside), False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    try:
        if system.getUri().getScheme() == "file":
            # a local rename replaces what is there, a link does not
            try:
                os.link(_local(aside), _local(path))
            except FileExistsError:
                return False
            return True
        return not system.exists(location) and system.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(aside), location)
    finally:
        remove(spark, aside)


def _local(path: str) -> str:
    return unquote(urlparse(path).path) if path.startswith("file:") else path


def make(spark: SparkSession, path: str) -> None:
    """The folder and those above it, where they are missing."""
    files, location = _open(spark, path)
    files.mkdirs(location)


def rename(spark: SparkSession, old: str, new: str) -> None:
    files, location = _open(spark, old)
    if not files.rename(location, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)):
        raise OSError(f"could not rename {old} to {new}")


def remove(spark: SparkSession, path: str) -> None:
    files, location = _open(spark, path)
    files.delete(location, True)


def total_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    files, location = _open(spark, path)
    return files.getContentSummary(location).getLength() if files.exists(location) else 0
