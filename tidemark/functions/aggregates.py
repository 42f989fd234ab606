"""Aggregate expressions with the reference's empty/null semantics."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: str | Column, scale: int = 9) -> Column:
    """Sum of money: 0.0 on empty input, and the same double in batch, stream
    and any partitioning, because the addition happens in a fixed-scale decimal.

    Each value counts to ``scale`` decimals, up to 29 digits before the point;
    the partial sums are combined map-side like any other ``sum``.
    """
    summed = F.sum(_col(c).cast(f"decimal(38,{scale})"))
    return F.coalesce(summed.cast("double"), F.lit(0.0))


def n_unique(c: str | Column) -> Column:
    """Exact distinct count in which NULL counts as one value; 0 on empty input."""
    col = _col(c)
    has_null = F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))
    return (F.count_distinct(col) + has_null).cast("bigint")


def approx_n_unique(c: str | Column, rsd: float = 0.01) -> Column:
    """HyperLogLog++ version of ``n_unique`` for very large inputs (and streams)."""
    col = _col(c)
    has_null = F.coalesce(F.max(col.isNull().cast("int")), F.lit(0))
    return (F.approx_count_distinct(col, rsd) + has_null).cast("bigint")
