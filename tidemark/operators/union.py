"""Relaxed unions: vertical (same columns) and diagonal (union of column sets).

Each column is cast to a common supertype before ``unionByName``, because under
ANSI Spark would otherwise widen e.g. int + string to bigint and fail at run
time. Supertypes: NULL (void) < any type; integers widen to the wider integer;
decimals, and integers with decimals, to a decimal that holds every digit of both
(of more than 38 digits, as many places as are left beside the whole digits);
float or double with any other number -> double, whose 53 bits do not hold every
bigint or decimal; timestamp_ntz + timestamp -> timestamp; anything
else that differs -> string. Duplicates are kept.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INT_RANK = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 3, T.LongType: 4}


#: Digits of the integer types.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def _decimal(t: T.DataType) -> tuple[int, int] | None:
    """Whole digits and decimal places of an exact number."""
    if isinstance(t, T.DecimalType):
        return t.precision - t.scale, t.scale
    return (_DIGITS[type(t)], 0) if type(t) in _DIGITS else None


def supertype(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    ra, rb = _INT_RANK.get(type(a)), _INT_RANK.get(type(b))
    if ra and rb:
        return a if ra >= rb else b
    da, db = _decimal(a), _decimal(b)
    if da and db:
        whole, scale = max(da[0], db[0]), max(da[1], db[1])
        return T.DecimalType(min(38, whole + scale), min(scale, max(0, 38 - whole)))
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
    if isinstance(a, numeric) and isinstance(b, numeric):
        return T.DoubleType()
    stamps = (T.TimestampType, T.TimestampNTZType, T.DateType)
    if isinstance(a, stamps) and isinstance(b, stamps):
        if isinstance(a, T.DateType) and isinstance(b, T.DateType):
            return a
        if isinstance(a, T.TimestampNTZType) and isinstance(b, (T.TimestampNTZType, T.DateType)):
            return a
        if isinstance(b, T.TimestampNTZType) and isinstance(a, T.DateType):
            return b
        return T.TimestampType()
    return T.StringType()


def _union(frames: list[DataFrame], diagonal: bool) -> DataFrame:
    if not frames:
        raise ValueError("nothing to union")
    names: list[str] = []
    types: dict[str, T.DataType] = {}
    for df in frames:
        for f in df.schema.fields:
            if f.name not in types:
                names.append(f.name)
                types[f.name] = f.dataType
            else:
                types[f.name] = supertype(types[f.name], f.dataType)
    if not diagonal:
        first = set(frames[0].columns)
        for df in frames[1:]:
            if set(df.columns) != first:
                raise ValueError(f"vertical union needs the same columns: {sorted(first)} vs {sorted(df.columns)}")
    aligned = []
    for df in frames:
        have = set(df.columns)
        aligned.append(df.select(*[
            (F.col(f"`{n}`") if n in have else F.lit(None)).cast(types[n]).alias(n) for n in names]))
    return reduce(lambda a, b: a.unionByName(b), aligned)


def union_relaxed(*frames: DataFrame) -> DataFrame:
    """Vertical union with per-column supertypes (same column set required)."""
    return _union(list(frames), diagonal=False)


def union_diagonal(*frames: DataFrame) -> DataFrame:
    """Union of all column sets; missing columns are NULL; types relaxed."""
    return _union(list(frames), diagonal=True)
