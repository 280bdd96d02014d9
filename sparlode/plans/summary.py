"""Term summaries: for each file and field, how many rows hold each value, and how many aren't null.

Rows without a value are counted under a null term. A facet over a whole table without a
filter and the count of a simple condition are sums over the summary; a filter on values
needs only the files that list them.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.facets import facet_values
from ..paths import column, parse, type_at

#: Types whose values are the same exactly if their text is.
EXACT = (T.StringType, T.IntegerType, T.LongType, T.ShortType, T.ByteType, T.BooleanType, T.DateType)
_PATH = r"(?P<path>(?:`(?:[^`]|``)+`|[^\W\d]\w*)(?:\.(?:`(?:[^`]|``)+`|\w+)|\['[^'\\]*'\])*)"
_ONE = r"(?:'[^'\\]*'|-?\d+)"
_SIMPLE = [
    ("has", re.compile(rf"array_contains\(\s*{_PATH}\s*,\s*(?P<values>{_ONE})\s*\)", re.I)),
    ("is", re.compile(rf"{_PATH}\s*=\s*(?P<values>{_ONE})")),
    ("is", re.compile(rf"{_PATH}\s+IN\s*\((?P<values>\s*{_ONE}(?:\s*,\s*{_ONE})*\s*)\)", re.I)),
    ("present", re.compile(rf"{_PATH}\s+IS\s+NOT\s+NULL", re.I)),
]
_TEXT = re.compile(r"'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\"")


def build(df: DataFrame, fields: Mapping[str, str]) -> DataFrame:
    """(file, field, kind, term, n) of a table that was read from files; fields: name -> path to read; terms as strings, kind "term" or "present"."""
    file = F.col("_metadata.file_path").alias("file")

    def one(name: str, path: str) -> DataFrame:
        values = facet_values(df, path)
        term = F.explode_outer(values) if isinstance(type_at(df.schema, path), T.ArrayType) else values
        terms = df.select(file, F.lit(name).alias("field"), F.lit("term").alias("kind"), term.alias("term")).withColumn("term", F.col("term").cast("string"))
        return terms.groupBy("file", "field", "kind", "term").agg(F.count("*").alias("n"))

    counted = df.select(file, *[column(df.schema, path).alias(f"f{i}") for i, path in enumerate(fields.values())]).groupBy("file").agg(*[F.count(f"f{i}").alias(f"f{i}") for i in range(len(fields))])
    rows = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"f{i}").alias("n")) for i, f in enumerate(fields)])
    present = counted.select("file", F.explode(rows).alias("r")).select("file", "r.field", F.lit("present").alias("kind"), F.lit(None).cast("string").alias("term"), "r.n")
    return reduce(DataFrame.unionByName, [*(one(*f) for f in fields.items()), present])


def facet(terms: DataFrame, path: str, name: str, schema: T.StructType) -> DataFrame:
    """The facet counts of one field, as facet() gives them."""
    kind = type_at(schema, path)
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    return terms.where((F.col("field") == path) & (F.col("kind") == "term")).groupBy(F.col("term").cast(kind).alias(name)).agg(F.sum("n").alias("n"))


def conjuncts(predicate: str) -> list[str]:
    """The parts of a conjunction at its top level; one part where it isn't surely a conjunction."""
    bare = _TEXT.sub(lambda m: "x" * len(m[0]), predicate)
    if re.search(r"\b(OR|BETWEEN|CASE|NOT)\b(?!\s+NULL)", bare, re.I):
        return [predicate.strip()]
    depth, cuts = 0, [0]
    for m in re.finditer(r"[()\[\]]|\bAND\b", bare, re.I):
        if m[0] in "([":
            depth += 1
        elif m[0] in ")]":
            depth -= 1
        elif not depth:
            cuts += [m.start(), m.end()]
    cuts.append(len(predicate))
    return [predicate[a:b].strip() for a, b in zip(cuts[::2], cuts[1::2])]


def condition(predicate: str, schema: T.StructType, fields: Iterable[str]) -> Column | None:
    """The condition on summary rows that stands for a simple predicate on a field: their n adds up to the rows for which it is true."""
    for kind, pattern in _SIMPLE:
        m = pattern.fullmatch(predicate.strip())
        if not m:
            continue
        field = next((f for f in fields if parse(f) == parse(m["path"])), None)
        if field is None:
            return None
        found = type_at(schema, field)
        array = isinstance(found, T.ArrayType)
        here = F.col("field") == field
        if kind == "present":
            return here & (F.col("kind") == "present") & (F.col("n") > 0)
        leaf = found.elementType if array else found
        values = re.findall(_ONE, m["values"])
        text = [v.startswith("'") for v in values]
        if array != (kind == "has") or not isinstance(leaf, EXACT) or any(t != isinstance(leaf, T.StringType) for t in text):
            return None
        listed = [v[1:-1] if t else str(int(v)) for v, t in zip(values, text)]
        return here & (F.col("kind") == "term") & F.col("term").isin(listed)
    return None


def files_with(terms: DataFrame, tests: Iterable[Column]) -> DataFrame:
    """The files that have a summary row for each of the conditions."""
    return reduce(lambda a, b: a.join(b, "file", "left_semi"), [terms.where(t).select("file").distinct() for t in tests])
