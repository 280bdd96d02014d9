"""Columns made from hot map keys.

Spark does not push predicates on map values into the scan. A key that gets a column of its
own is pruned, pushed down and compared with row group statistics like any other column. The
map stays: an absent key and a null value are the same for `m['k']`, not for
map_contains_key.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..paths import free_name, parse, quote

_TOKEN = re.compile(
    r"(?P<text>'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.)*\")"
    r"|(?P<path>(?:`(?:[^`]|``)+`|[^\W\d]\w*)(?:\s*\.\s*(?:`(?:[^`]|``)+`|\w+)|\[\s*'(?:[^'\\]|\\.)*'\s*\])*)"
)


def name(column: str, key: str) -> str:
    """The column that holds a map's key; characters that a column name can't have are written as hexadecimal."""
    return f"{column}__{re.sub(r'[^0-9A-Za-z]', lambda m: f'_{ord(m[0]):x}_', key)}"


#: Map column -> key -> the column that holds it.
Hidden = Mapping[str, Mapping[str, str]]


def named(columns: Iterable[str], keys: Mapping[str, Iterable[str]]) -> dict[str, dict[str, str]]:
    """A free column name for each listed key of each listed map."""
    taken, out = list(columns), {}
    for column, listed in keys.items():
        for k in listed:
            out.setdefault(column, {})[k] = free_name(taken, name(column, k))
            taken.append(out[column][k])
    return out


def shred(df: DataFrame, keys: Hidden) -> DataFrame:
    """Adds the column of each key."""
    new = {hidden: F.try_element_at(F.col(quote(c)), F.lit(k)) for c, listed in keys.items() for k, hidden in listed.items()}
    return df.withColumns(new) if new else df


def rewrite_path(path: str, keys: Hidden) -> str:
    """The path with a shredded key replaced by its column."""
    steps = parse(path)
    if len(steps) >= 2 and isinstance(steps[1], str) and steps[1] in keys.get(str(steps[0]), {}):
        rest = "".join(f"[{s}]" if isinstance(s, int) else "." + quote(s) for s in steps[2:])
        return quote(keys[str(steps[0])][steps[1]]) + rest
    return path


def rewrite(predicate: str, keys: Hidden) -> str:
    """An SQL expression with its paths to shredded keys replaced; strings in it stay as they are."""

    def change(m: re.Match) -> str:
        if m["text"]:
            return m[0]
        try:
            return rewrite_path(re.sub(r"\s*([.\[\]])\s*", r"\1", m["path"]) if "`" not in m["path"] and "'" not in m["path"] else m["path"], keys)
        except ValueError:
            return m[0]

    return _TOKEN.sub(change, predicate)
