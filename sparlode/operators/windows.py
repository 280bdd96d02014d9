"""Window helpers: sessions and the last rows of a group."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..paths import free_name


def sessions(df: DataFrame, by: Iterable[str], time: str, gap_seconds: int, tie: Iterable[str] = ()) -> DataFrame:
    """Adds `session`: the number, from 0, of the run of rows at most gap_seconds apart."""
    line = Window.partitionBy(*by).orderBy(time, *tie)
    seconds = F.unix_micros(F.col(time).cast("timestamp"))
    new = F.coalesce(((seconds - F.lag(seconds).over(line)) > gap_seconds * 1_000_000).cast("int"), F.lit(0))
    mark = free_name([*df.columns, "session"], "_new")
    return df.withColumn(mark, new).withColumn("session", F.sum(F.col(mark)).over(line.rowsBetween(Window.unboundedPreceding, 0))).drop(mark)


def top_rows(df: DataFrame, by: Iterable[str], order: Iterable[Column], k: int) -> DataFrame:
    """The first k rows of each group; Spark prunes each task to k rows per group before the shuffle."""
    rank = free_name(df.columns, "_rank")
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= k).drop(rank)
