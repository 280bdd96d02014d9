"""The scalar functions that expressions may name, each as the Spark function that computes it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _case(*parts: Column) -> Column:
    """CASE_WHEN(condition, value, ..., [otherwise])."""
    pairs = len(parts) // 2
    out = F.when(parts[0], parts[1])
    for i in range(1, pairs):
        out = out.when(parts[2 * i], parts[2 * i + 1])
    return out.otherwise(parts[-1]) if len(parts) % 2 else out


# The names and what computes them.
FUNCTIONS: dict[str, Callable[..., Column]] = {
    "+": lambda a, b: a + b, "-": lambda a, b: a - b, "*": lambda a, b: a * b, "/": lambda a, b: a / b, "%": lambda a, b: a % b,
    "&": lambda a, b: a.bitwiseAND(b), "|": lambda a, b: a.bitwiseOR(b), "^": lambda a, b: a.bitwiseXOR(b), "~": F.bitwise_not,
    "CASE_WHEN": _case, "ABS": F.abs, "COALESCE": F.coalesce, "GREATEST": F.greatest, "LEAST": F.least, "RAND": F.rand,
    "LOG": lambda base, x: F.ln(x) / F.ln(base), "LOG10": F.log10, "LOG2": F.log2, "LN": F.ln, "EXP": F.exp, "POWER": F.pow,
    "SQRT": F.sqrt, "FLOOR": F.floor, "CEIL": F.ceil, "ROUND": F.round, "SIN": F.sin, "SINH": F.sinh, "COS": F.cos, "COSH": F.cosh,
    "TAN": F.tan, "TANH": F.tanh, "COT": F.cot, "ASIN": F.asin, "ASINH": F.asinh, "ACOS": F.acos, "ACOSH": F.acosh,
    "ATAN": F.atan, "ATANH": F.atanh, "ATAN2": F.atan2, "CBRT": F.cbrt, "DEGREES": F.degrees, "RADIANS": F.radians,
    "SIGN": F.signum, "WIDTH_BUCKET": F.width_bucket, "SUBSTRING": F.substring, "UPPER": F.upper, "LOWER": F.lower,
    "TRANSLATE": F.translate, "TRIM": F.trim, "LTRIM": F.ltrim, "RTRIM": F.rtrim, "BIT_LENGTH": F.bit_length,
    "CHAR_LENGTH": F.char_length, "CONCAT": F.concat, "OVERLAY": F.overlay, "DATE_ADD": F.date_add, "DATE_DIFF": F.datediff,
    "TRUNC": F.trunc, "AES_ENCRYPT": F.aes_encrypt, "AES_DECRYPT": F.aes_decrypt, "SHA1": F.sha1, "SHA2": F.sha2, "MD5": F.md5, "CRC32": F.crc32,
}
PREDICATES: dict[str, Callable[..., Column]] = {
    "IS_NULL": lambda a: a.isNull(), "IS_NOT_NULL": lambda a: a.isNotNull(), "STARTS_WITH": lambda a, b: a.startswith(b), "ENDS_WITH": lambda a, b: a.endswith(b),
    "CONTAINS": lambda a, b: a.contains(b), "IN": lambda a, *b: a.isin(*b), "=": lambda a, b: a == b, "<>": lambda a, b: a != b, "<=>": lambda a, b: a.eqNullSafe(b),
    "<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b, "AND": lambda a, b: a & b, "OR": lambda a, b: a | b,
    "NOT": lambda a: ~a, "ALWAYS_TRUE": lambda: F.lit(True), "ALWAYS_FALSE": lambda: F.lit(False),
}


def call(name: str, *args) -> Column:
    """The function or predicate of that name; names are not case-sensitive."""
    table = FUNCTIONS | PREDICATES
    if name.upper() not in table:
        raise ValueError(f"no such function: {name}")
    return table[name.upper()](*args)
