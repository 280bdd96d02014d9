"""Aggregates by paths. Partial and final aggregation, spilling and skew are Spark's."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import column, type_at

#: Aggregates by name, of one column.
SINGLE = {
    "count": F.count, "min": F.min, "max": F.max, "sum": F.sum, "avg": F.avg,
    "var_pop": F.var_pop, "var_samp": F.var_samp, "stddev_pop": F.stddev_pop, "stddev_samp": F.stddev_samp,
    "count_distinct": F.count_distinct, "sum_distinct": F.sum_distinct, "approx_count_distinct": F.approx_count_distinct,
}
#: Aggregates by name, of two columns.
PAIRED = {
    "covar_pop": F.covar_pop, "covar_samp": F.covar_samp, "corr": F.corr,
    "regr_intercept": F.regr_intercept, "regr_r2": F.regr_r2, "regr_slope": F.regr_slope, "regr_sxy": F.regr_sxy,
}


def _single_valued(df: DataFrame, path: str, name: str) -> Column:
    if name != "count" and isinstance(type_at(df.schema, path), (T.ArrayType, T.MapType)):
        raise TypeError(f"{name} of the multi-valued column {path!r}: explode it first, or use facet()")
    return column(df.schema, path)


def measure(df: DataFrame, name: str, *paths: str) -> Column:
    """An aggregate by its name; `count` without a path counts rows.

    A sum of whole numbers that overflows is an error under ANSI rules. `count` of a column
    counts its non-null values, of any type.
    """
    if name == "count" and not paths:
        return F.count(F.lit(1))
    if name in SINGLE and len(paths) == 1:
        return SINGLE[name](_single_valued(df, paths[0], name))
    if name in PAIRED and len(paths) == 2:
        return PAIRED[name](*(_single_valued(df, p, name) for p in paths))
    raise ValueError(f"no aggregate {name} of {len(paths)} columns")


def aggregate(
    df: DataFrame, by: Iterable[str] | Mapping[str, str] = (), measures: Mapping[str, tuple[str, ...]] | None = None, filters: Mapping[str, Column | str] | None = None, grouping: str = "group"
) -> DataFrame:
    """Group by paths and aggregate.

    by: paths, or output name -> path; without any, one row over all input (count 0 over
    none). measures: output name -> (aggregate, path...). filters: output name -> predicate
    that restricts that measure alone. grouping: "group", "rollup" or "cube". Without
    measures the result is the distinct groups.
    """
    named = dict(by) if isinstance(by, Mapping) else {p: p for p in by}
    keys = [column(df.schema, p).alias(n) for n, p in named.items()]
    filters = filters or {}
    out = []
    for name, (kind, *paths) in (measures or {}).items():
        if name in filters:
            test = F.expr(filters[name]) if isinstance(filters[name], str) else filters[name]
            out.append(_filtered(df, kind, paths, test).alias(name))
        else:
            out.append(measure(df, kind, *paths).alias(name))
    if not out:
        return df.select(*keys).distinct()
    grouped = {"group": df.groupBy, "rollup": df.rollup, "cube": df.cube}[grouping](*keys)
    return grouped.agg(*out)


def _filtered(df: DataFrame, kind: str, paths: list[str], test: Column) -> Column:
    if kind == "count" and not paths:
        return F.count_if(test)
    values = [F.when(test, _single_valued(df, p, kind)) for p in paths]
    return (SINGLE if len(paths) == 1 else PAIRED)[kind](*values)


def statistics(df: DataFrame, x: str, y: str, by: Iterable[str] = ()) -> DataFrame:
    """All variance, covariance, correlation and regression aggregates of two columns."""
    measures = {n: (n, x) for n in ("var_pop", "var_samp", "stddev_pop", "stddev_samp")} | {n: (n, x, y) for n in PAIRED}
    return aggregate(df, by, measures)
