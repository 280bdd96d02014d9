"""Paths to nested values: `s.f`, `m.key`, ``m.`0.3` ``, `m['key']`, `a[0]`."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_STEP = re.compile(r"\.?`((?:[^`]|``)+)`|\['((?:[^'\\]|\\.)*)'\]|\[(\d+)\]|\.?([^\s.`\[\]]+)")


def parse(path: str) -> list[str | int]:
    """The steps of a path; whole numbers in brackets are array positions."""
    steps: list[str | int] = []
    at = 0
    for m in _STEP.finditer(path):
        if m.start() != at:
            break
        at = m.end()
        if m[1] is not None:
            steps.append(m[1].replace("``", "`"))
        elif m[2] is not None:
            steps.append(re.sub(r"\\(.)", r"\1", m[2]))
        elif m[3] is not None:
            steps.append(int(m[3]))
        else:
            steps.append(m[4])
    if at != len(path) or not steps:
        raise ValueError(f"not a path: {path!r}")
    return steps


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(taken: Iterable[str], name: str) -> str:
    """The name, with underscores after it until no column has it; column names differ whatever their case."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name += "_"
    return name


def type_at(schema: T.StructType, path: str) -> T.DataType:
    """The type of the value at a path; a step through an array of structs gives an array."""
    kind: T.DataType = schema
    for step in parse(path):
        kind = _step_type(kind, step, path)
    return kind


def _step_type(kind: T.DataType, step: str | int, path: str) -> T.DataType:
    if isinstance(kind, T.StructType):
        found = next((f for f in kind.fields if f.name == step), None) or next((f for f in kind.fields if f.name.lower() == str(step).lower()), None)
        if found is None:
            raise ValueError(f"no field {step!r} in {path!r}")
        return found.dataType
    if isinstance(kind, T.MapType):
        return kind.valueType
    if isinstance(kind, T.ArrayType):
        return kind.elementType if isinstance(step, int) else T.ArrayType(_step_type(kind.elementType, step, path))
    raise ValueError(f"{path!r} goes on below a {kind.simpleString()}")


def column(schema: T.StructType, path: str) -> Column:
    """The value at a path; missing keys and positions give null, also under ANSI rules."""
    first, *rest = parse(path)
    kind = _step_type(schema, first, path)
    value = F.col(quote(str(first)))
    for step in rest:
        if isinstance(kind, T.MapType):
            value = F.try_element_at(value, F.lit(step).cast(kind.keyType))
        elif isinstance(kind, T.ArrayType) and isinstance(step, int):
            value = F.get(value, F.lit(step))
        else:
            value = value.getField(str(step))
        kind = _step_type(kind, step, path)
    return value


def leaves(schema: T.StructType, prefix: str = "") -> list[tuple[str, T.DataType]]:
    """All atomic paths with their types; `*` stands for any key of a map, elements belong to their array's path."""
    out: list[tuple[str, T.DataType]] = []
    for f in schema.fields:
        out += _leaves(f.dataType, prefix + (quote(f.name) if re.search(r"[.\s`]", f.name) else f.name))
    return out


def _leaves(kind: T.DataType, path: str) -> list[tuple[str, T.DataType]]:
    if isinstance(kind, T.StructType):
        return leaves(kind, path + ".")
    if isinstance(kind, T.MapType):
        return _leaves(kind.valueType, path + ".*")
    if isinstance(kind, T.ArrayType):
        return _leaves(kind.elementType, path)
    return [(path, kind)]
