"""Last N rows by an order column (TakeOrdered, no full sort).

The reference takes ``OFFSET count-50 LIMIT 50`` in insertion order; Spark has
no insertion order, so the caller names the order column(s) and a tiebreak.
Each task keeps its top N and one task merges them: N rows per task move, never
the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tail_n(df: DataFrame, n: int, order_by: list[str] | str) -> DataFrame:
    cols = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*[F.col(c).desc_nulls_last() for c in cols]).limit(n)
