"""Windowed counts and facets over streams of table files."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).parquet(path)


def windowed(df: DataFrame, time: str, width: str, slide: str | None = None, late: str = "0 seconds", by: Iterable[str] = (), value: str | None = None) -> DataFrame:
    """Counts (and the sum of value) per tumbling or sliding window and key; rows later than `late` are dropped by the watermark when streaming."""
    at = F.col(time).cast("timestamp")
    df = df.withColumn(time, at)
    df = df.withWatermark(time, late) if df.isStreaming else df
    measures = [F.count("*").alias("n"), *([F.sum(value).alias("total")] if value else [])]
    window = F.window(time, width, slide) if slide else F.window(time, width)
    grouped = df.groupBy(window.alias("w"), *by).agg(*measures)
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *by, *[c for c in ("n", "total") if c in grouped.columns])


def session_windows(df: DataFrame, time: str, gap: str, late: str = "0 seconds", by: Iterable[str] = ()) -> DataFrame:
    """Counts per session window and key."""
    df = df.withColumn(time, F.col(time).cast("timestamp"))
    df = df.withWatermark(time, late) if df.isStreaming else df
    grouped = df.groupBy(F.session_window(time, gap).alias("w"), *by).agg(F.count("*").alias("n"))
    return grouped.select(F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), *by, "n")


def facet_stream(df: DataFrame, values: str, time: str, width: str, late: str = "0 seconds") -> DataFrame:
    """Facet counts of an array column per tumbling window, each distinct value of a row counted once."""
    df = df.withColumn("_v", F.explode_outer(F.array_distinct(F.filter(F.col(values), lambda x: x.isNotNull()))))
    return windowed(df, time, width, late=late, by=["_v"]).withColumnRenamed("_v", "value")
