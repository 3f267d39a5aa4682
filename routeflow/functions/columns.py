"""Column expressions (all JVM-side, inside whole-stage codegen).

Each function returns a ``Column``; none touches data. Operators compose them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from routeflow import fixed_values as FV


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- standardisation --------------------------------------------------------------------------


def code(c: str | Column) -> Column:
    """Canonical code: spaces trimmed, upper case."""
    return F.upper(F.trim(col(c)))


def text(c: str | Column) -> Column:
    """Free text: spaces trimmed, case kept."""
    return F.trim(col(c))


def null_if(c: str | Column, spellings: Sequence[str] = FV.NULL_SPELLINGS) -> Column:
    """NULL when the text is one of ``spellings`` (checked before any typing)."""
    c = col(c)
    return F.when(c.isin(*spellings), F.lit(None).cast(T.StringType())).otherwise(c)


def try_convert(c: str | Column, data_type: T.DataType) -> Column:
    """Text -> ``data_type`` without raising; NULL when the text does not convert.

    Whole numbers go through ``decimal(38,0)`` so that ``'1.5'`` rounds half-up to 2 instead of
    failing, then land as ``bigint``.
    """
    c = col(c)
    if isinstance(data_type, T.StringType):
        return c
    if isinstance(data_type, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return c.try_cast(T.DecimalType(38, 0)).try_cast(data_type)
    return c.try_cast(data_type)


def all_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conds)


def any_of(conds: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conds)


def all_not_null(cols: Iterable[str | Column]) -> Column:
    return all_of(col(c).isNotNull() for c in cols)


def any_null(cols: Iterable[str | Column]) -> Column:
    return any_of(col(c).isNull() for c in cols)


# --- derivations ------------------------------------------------------------------------------


def route_key(origin: str | Column, destination: str | Column, sep: str = FV.ROUTE_KEY_SEPARATOR) -> Column:
    """``origin || sep || destination``; NULL if either end is NULL."""
    return F.concat(col(origin), F.lit(sep), col(destination))


def differs(a: str | Column, b: str | Column) -> Column:
    """TRUE when the trimmed values differ, FALSE otherwise (a NULL side gives FALSE)."""
    return F.when(F.trim(col(a)) != F.trim(col(b)), F.lit(True)).otherwise(F.lit(False))


def bucket(
    c: str | Column,
    bounds: Sequence[tuple[float, str]] = FV.DISTANCE_CATEGORIES,
    otherwise: str = FV.DISTANCE_CATEGORY_ELSE,
) -> Column:
    """Half-open ordered buckets: first ``c < bound`` wins; NULL falls to ``otherwise``."""
    c = col(c)
    expr = None
    for bound, label in bounds:
        expr = F.when(c < F.lit(bound), F.lit(label)) if expr is None else expr.when(c < F.lit(bound), F.lit(label))
    return F.lit(otherwise) if expr is None else expr.otherwise(F.lit(otherwise))


def flag_contradicts(flag: str | Column, a: str | Column, b: str | Column) -> Column:
    """Stored flag disagrees with its inputs: TRUE with equal, or FALSE with different trimmed values.

    A NULL flag or a NULL input never counts (the comparison is NULL, not TRUE).
    """
    flag, ta, tb = col(flag), F.trim(col(a)), F.trim(col(b))
    return ((flag == F.lit(True)) & (ta == tb)) | ((flag == F.lit(False)) & (ta != tb))


def outside(c: str | Column, lo, hi) -> Column:
    """``c NOT BETWEEN lo AND hi`` (inclusive bounds valid, NULL is not outside)."""
    return ~col(c).between(F.lit(lo), F.lit(hi))


def as_flag(cond: Column) -> Column:
    """Boolean -> 1/0 with NULL counted as 0."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def verdict(ok: Column) -> Column:
    return F.when(ok, F.lit(FV.RESULT_PASS)).otherwise(F.lit(FV.RESULT_FAIL))


# --- text rendering ---------------------------------------------------------------------------


def number_text(c: str | Column) -> Column:
    """A number as prompt text without float noise: 5541.0 -> '5541', 1234.5 -> '1234.5'.

    Floating values go through ``decimal(38,6)``; integers print as they are.
    """
    c = col(c)
    as_dec = c.try_cast(T.DecimalType(38, 6)).cast(T.StringType())
    return F.regexp_replace(as_dec, r"\.?0+$", "")


def integer_text(c: str | Column) -> Column:
    return col(c).cast(T.StringType())


def template(parts: Sequence[str], columns: dict[str, Column]) -> Column:
    """Concatenate literal parts and ``{name}`` placeholders; NULL if any placeholder is NULL."""
    pieces = []
    for p in parts:
        if p.startswith("{") and p.endswith("}"):
            pieces.append(columns[p[1:-1]])
        else:
            pieces.append(F.lit(p))
    return F.concat(*pieces)
