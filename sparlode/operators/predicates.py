"""Predicates over paths, with SQL's three-valued logic throughout.

On a path to an array a comparison is existential: true if some element satisfies it. Spark
pushes what it can into the Parquet scan (atomic columns and struct leaves); nothing is
evaluated outside Catalyst.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from operator import and_, or_
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..paths import column, type_at


class Path:
    """A nested value of a DataFrame as the left side of predicates."""

    def __init__(self, df: DataFrame, path: str):
        self.path, self.kind, self.value = path, type_at(df.schema, path), column(df.schema, path)

    def _holds(self, test: Callable[[Column], Column]) -> Column:
        return F.exists(self.value, test) if isinstance(self.kind, T.ArrayType) else test(self.value)

    def __eq__(self, other: Any) -> Column:  # type: ignore[override]
        return self._holds(lambda x: x == other)

    def __ne__(self, other: Any) -> Column:  # type: ignore[override]
        return ~(self == other)

    __hash__ = None  # type: ignore[assignment]

    def __gt__(self, other: Any) -> Column:
        return self._holds(lambda x: x > other)

    def __ge__(self, other: Any) -> Column:
        return self._holds(lambda x: x >= other)

    def __lt__(self, other: Any) -> Column:
        return self._holds(lambda x: x < other)

    def __le__(self, other: Any) -> Column:
        return self._holds(lambda x: x <= other)

    def same(self, other: Any) -> Column:
        """Null-safe equality: never null."""
        return self.value.eqNullSafe(other)

    def between(self, low: Any, high: Any) -> Column:
        return self._holds(lambda x: x.between(low, high))

    def isin(self, values: Iterable[Any]) -> Column:
        listed = list(values)
        return self._holds(lambda x: x.isin(listed))

    def is_null(self) -> Column:
        """True for null and for an absent map key; an empty array or map is not null."""
        return self.value.isNull()

    def is_not_null(self) -> Column:
        return self.value.isNotNull()

    def startswith(self, text: str) -> Column:
        return self._holds(lambda x: x.startswith(text))

    def endswith(self, text: str) -> Column:
        """Literal: `*`, `?`, `%` and `\\` mean themselves."""
        return self._holds(lambda x: x.endswith(text))

    def contains(self, text: str) -> Column:
        """Literal: `*`, `?`, `%` and `\\` mean themselves."""
        return self._holds(lambda x: x.contains(text))

    def has(self, value: Any) -> Column:
        """array_contains: null if the array is null, or if it holds a null and not the value."""
        return F.array_contains(self.value, value)

    def any(self, test: Callable[[Column], Column]) -> Column:
        """Whether some element satisfies the test; NOT any(p) differs from any(NOT p)."""
        return F.exists(self.value, test)


def all_of(predicates: Iterable[Column]) -> Column:
    """Conjunction; of none, true."""
    return reduce(and_, predicates, F.lit(True))


def any_of(predicates: Iterable[Column]) -> Column:
    """Disjunction; of none, false."""
    return reduce(or_, predicates, F.lit(False))


def where(df: DataFrame, *predicates: Column | str) -> DataFrame:
    """Rows for which all predicates are true; strings are SQL. Without predicates, all rows."""
    for p in predicates:
        df = df.where(p)
    return df
