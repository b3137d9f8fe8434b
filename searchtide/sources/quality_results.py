"""Quality results: JSON lines in a folder per run date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from searchtide.schemas import DQ_JSON_NAMES, DQ_RESULTS


def write_results(results: DataFrame, path: str) -> None:
    """Append results; a results table has one row per rule, so a run is one small file."""
    columns = [F.col(name).alias(json_name) for name, json_name in DQ_JSON_NAMES.items()]
    results.select(*columns, "run_date").coalesce(1).write.mode("append").partitionBy("run_date").json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    on_disk = T.StructType([T.StructField(n, T.StringType()) for n in DQ_JSON_NAMES.values()]
                           + [T.StructField("run_date", T.DateType())])
    rows = spark.read.schema(on_disk).json(path)
    return rows.withColumnsRenamed({j: n for n, j in DQ_JSON_NAMES.items()}).select(*DQ_RESULTS.names)
