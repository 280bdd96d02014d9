"""Tables in the other formats that Spark reads and writes, under one pair of functions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: What each format needs so that a written table reads back as it was.
DEFAULTS = {"parquet": {}, "orc": {}, "json": {"ignoreNullFields": "false"}, "csv": {"header": "true", "escape": '"', "multiLine": "true"}, "avro": {}, "text": {}}


def write_as(df: DataFrame, path: str, kind: str, mode: str = "error", partition_by: Iterable[str] = (), **options: str) -> None:
    if kind not in DEFAULTS:
        raise ValueError(f"no such format: {kind}")
    writer = df.write.format(kind).mode(mode).options(**DEFAULTS[kind] | options)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def read_as(spark: SparkSession, path: str, kind: str, schema: T.StructType | str | None = None, **options: str) -> DataFrame:
    """CSV and JSON should be given a schema: inferring one reads the data twice."""
    if kind not in DEFAULTS:
        raise ValueError(f"no such format: {kind}")
    reader = spark.read.format(kind).options(**DEFAULTS[kind] | options)
    return (reader.schema(schema) if schema is not None else reader).load(path)
