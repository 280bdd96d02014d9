"""Session settings that the engine's plans profit from; nothing is changed behind the caller's back."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Runtime settings. The shuffle partitions start high and are coalesced to the data.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}
#: With Parquet as a V2 source, count, min and max without a filter come from the footers.
FOOTER_AGGREGATES = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text", "spark.sql.parquet.aggregatePushdown": "true"}


def session(name: str = "sparlode", **settings: str) -> SparkSession:
    """A session with SETTINGS; keyword arguments are further settings with dots as double underscores."""
    builder = SparkSession.builder.appName(name)
    for k, v in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


@contextmanager
def configure(spark: SparkSession, settings: dict[str, str]):
    """Settings for the plans built and run inside; what was set before is restored."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield spark
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def footer_read(spark: SparkSession, path: str):
    """A Parquet table whose count, min and max without a filter come from the footers, however the DataFrame is used further on.

    The relation stays a V2 one; aggregate pushdown, which changes no result, is switched on
    for the session, as plans look it up when they run.
    """
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    with configure(spark, FOOTER_AGGREGATES):
        table = spark.read.parquet(path)
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return table
