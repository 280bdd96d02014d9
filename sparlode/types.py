"""Which column types the index formats of this kind know, and the schema that facets see."""

from __future__ import annotations

from pyspark.sql import types as T

#: The atomic types that are accepted by the strict gate.
STRICT = (T.BooleanType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def unsupported(kind: T.DataType, path: str = "") -> list[str]:
    """Paths whose type the strict gate refuses; Spark itself handles more."""
    if isinstance(kind, T.StructType):
        return [x for f in kind.fields for x in unsupported(f.dataType, f"{path}.{f.name}".lstrip("."))]
    if isinstance(kind, T.ArrayType):
        return unsupported(kind.elementType, path)
    if isinstance(kind, T.MapType):
        return unsupported(kind.valueType, path + ".*")
    return [] if isinstance(kind, STRICT) else [f"{path}: {kind.simpleString()}"]


def check(schema: T.StructType) -> None:
    if bad := unsupported(schema):
        raise TypeError("unsupported types: " + ", ".join(bad))


def facet_schema(kind: T.DataType) -> T.DataType:
    """The schema as a facet reads it: arrays of atomic values become their element, also in maps and structs."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, facet_schema(f.dataType), f.nullable) for f in kind.fields])
    if isinstance(kind, T.ArrayType) and not isinstance(kind.elementType, (T.ArrayType, T.MapType, T.StructType)):
        return kind.elementType
    if isinstance(kind, T.MapType):
        return T.MapType(kind.keyType, facet_schema(kind.valueType), True)
    return kind
