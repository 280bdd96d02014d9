"""Joins that Spark has no operator for; all others are DataFrame.join."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import free_name


def as_of_join(
    left: DataFrame, right: DataFrame, by: Iterable[str], left_time: str, right_time: str, values: Iterable[str], suffix: str = "", chunk: float | None = None
) -> DataFrame:
    """Each left row with the values of the latest right row of its keys that isn't later than it.

    Both sides are merged into one timeline per key and the last right row is carried
    forward, so the work is one shuffle and one sort, whatever the number of matches. Of
    right rows with one time the largest by `values` counts. Rows with a null time match
    nothing. Left columns are kept; values get the suffix.

    chunk cuts the timelines into pieces of so many units (seconds for timestamps), for keys
    with very many rows: pieces are sorted apart, and each gets the last right row of the
    pieces before it from a table with one row per key and piece.
    """
    by, values = list(by), list(values)
    kept = [c for c in left.columns if c not in by]
    kind = right.select(F.struct(*values).alias("s")).schema["s"].dataType
    at, side, mine, theirs, piece, last, end, before = (free_name(by, c) for c in ("_t", "_side", "_left", "_right", "_piece", "_last", "_end", "_before"))
    l = left.select(*by, F.col(left_time).alias(at), F.lit(1).alias(side), F.struct(*kept).alias(mine), F.lit(None).cast(kind).alias(theirs))
    r = right.where(F.col(right_time).isNotNull()).select(*by, F.col(right_time).alias(at), F.lit(0).alias(side), F.lit(None).cast(l.schema[mine].dataType).alias(mine), F.struct(*values).alias(theirs))
    both, cut = l.unionByName(r), []
    if chunk is not None:
        timed = isinstance(l.schema[at].dataType, (T.TimestampType, T.TimestampNTZType))
        when = F.unix_micros(F.col(at).cast("timestamp")) / F.lit(1e6) if timed else F.col(at).cast("double")
        both, cut = both.withColumn(piece, F.floor(when / F.lit(float(chunk)))), [piece]
    line = Window.partitionBy(*by, *cut).orderBy(F.asc_nulls_first(at), side, F.asc_nulls_first(theirs)).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn(last, F.last(theirs, ignorenulls=True).over(line)).where(F.col(side) == 1)
    if cut:
        ends = both.groupBy(*by, *cut).agg(F.max(F.when(F.col(side) == 0, F.struct(at, theirs))).alias(end))
        earlier = Window.partitionBy(*by).orderBy(piece).rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.withColumn(before, F.last(end, ignorenulls=True).over(earlier)).select(*by, *cut, F.col(f"{before}.{theirs}").alias(before))
        same = [found[c].eqNullSafe(ends[c]) for c in [*by, *cut]]
        found = found.join(ends, same, "left").select(*[found[c] for c in by], found[at], found[mine], F.coalesce(found[last], ends[before]).alias(last))
    found = found.withColumn(last, F.when(F.col(at).isNotNull(), F.col(last)))
    return found.select(*by, *[F.col(f"{mine}.`{c}`").alias(c) for c in kept], *[F.col(f"{last}.`{c}`").alias(c + suffix) for c in values])


def interval_join(points: DataFrame, spans: DataFrame, at: str, begin: str, end: str, width: float, by: Iterable[str] = ()) -> DataFrame:
    """Points joined with the spans [begin, end) that hold them, as an equi-join on buckets of `width`.

    A span is repeated for each bucket that it touches, a point has one bucket, so the cost
    follows the overlaps and not the product. Choose a width near the usual span.
    """
    by = list(by)
    bucket = free_name([*points.columns, *spans.columns], "_bucket")
    p = points.withColumn(bucket, F.floor(F.col(at) / F.lit(width)))
    last = F.floor(F.col(end) / F.lit(width)) - (F.col(end) == F.floor(F.col(end) / F.lit(width)) * F.lit(width)).cast("long")
    s = spans.where(F.col(begin) < F.col(end)).withColumn(bucket, F.explode(F.sequence(F.floor(F.col(begin) / F.lit(width)), last)))
    return p.join(s, [*by, bucket]).where((F.col(at) >= F.col(begin)) & (F.col(at) < F.col(end))).drop(bucket)


def small_join(df: DataFrame, small: DataFrame, by: Iterable[str], how: str = "inner", most_rows: int = 1_000_000) -> DataFrame:
    """An equi-join that sends the small side to every task if it has at most most_rows rows, and shuffles both sides otherwise.

    The small side is counted first, up to the bound; give it only the columns that are needed.
    """
    fits = small.limit(most_rows + 1).count() <= most_rows
    return df.join(F.broadcast(small) if fits else small.hint("merge"), list(by), how)
