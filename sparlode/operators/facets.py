"""Facet counts over multi-valued columns.

With distinct=True (the default, as an inverted index counts) a row counts once for each
different non-null value it holds, and once in the null group if it holds none: null, empty
and all-null arrays. With distinct=False every element counts, nulls included, as
explode_outer gives them. Several facets count the cross product of a row's value sets.
Measures count a row once for each key that it falls in.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import column, free_name, type_at
from .aggregates import measure


def facet_values(df: DataFrame, path: str, distinct: bool = True) -> Column:
    """What a row holds at a path, as an array to explode, or as it is where it is atomic."""
    value = column(df.schema, path)
    if not isinstance(type_at(df.schema, path), T.ArrayType):
        return value
    return F.filter(F.array_distinct(value), lambda x: x.isNotNull()) if distinct else value


def facet(
    df: DataFrame, paths: Iterable[str] | Mapping[str, str], measures: Mapping[str, tuple[str, ...]] | None = None, distinct: bool = True, where: Column | str | None = None, top: int | None = None, pregroup: bool = False
) -> DataFrame:
    """Group by the values at paths and count, or aggregate.

    paths: paths, or output name -> path. measures: output name -> (aggregate, path...); by
    default n, the number of rows. top keeps that many groups, largest first measure first,
    ties by key. pregroup counts rows by their whole sets of values before these are exploded,
    which pays where few different sets occur; for counts only.
    """
    named = dict(paths) if isinstance(paths, Mapping) else {p: p for p in paths}
    measures = measures or {"n": ("count",)}
    df = df if where is None else df.where(where)
    # Only the facets and what is measured go through the explode.
    used = {p: f"_m{i}" for i, p in enumerate(dict.fromkeys(p for m in measures.values() for p in m[1:]))}
    plain = {m: measure(df, *spec) for m, spec in measures.items()}  # also rejects multi-valued measures
    assert plain
    slim = df.select(*[facet_values(df, p, distinct).alias(n) for n, p in named.items()], *[column(df.schema, p).alias(a) for p, a in used.items()])
    pregroup = pregroup and all(m == ("count",) for m in measures.values())
    if pregroup:
        slim = slim.groupBy(*slim.columns).agg(F.count("*").alias(many := free_name(slim.columns, "_n")))
    for name, path in named.items():
        if isinstance(type_at(df.schema, path), T.ArrayType):
            slim = slim.withColumn(name, F.explode_outer(F.col(f"`{name}`")))
    out = [F.sum(many).alias(m) for m in measures] if pregroup else [measure(slim, kind, *(used[p] for p in rest)).alias(m) for m, (kind, *rest) in measures.items()]
    result = slim.groupBy(*[F.col(f"`{n}`") for n in named]).agg(*out)
    if top is not None:
        first = next(iter(measures))
        result = result.orderBy(F.desc(first), *[F.asc_nulls_last(f"`{n}`") for n in named]).limit(top)
    return result
