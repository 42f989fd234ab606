"""Trailing-range KPIs: revenue and active sessions as of a given instant.

The range has a lower bound only (``ts >= as_of - window``), as in the
reference: rows after ``as_of`` count too. ``as_of`` is an argument, never a
hidden clock; ``None`` means ``current_timestamp()``.

Plan shape: parquet scan with the bound in PushedFilters and two columns in
ReadSchema, partial aggregate per task, one exchange to a single final task.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.aggregates import exact_sum, n_unique
from tidemark.functions.timestamps import to_utc_ntz


def _bound(df: DataFrame, ts: str, as_of, window: str) -> Column:
    """``as_of - window`` typed like the timestamp column."""
    dtype = df.schema[ts].dataType
    if as_of is None:
        anchor = F.current_timestamp()
        if isinstance(dtype, T.TimestampNTZType):  # stored as UTC wall clock, whatever the session's zone
            anchor = to_utc_ntz(anchor)
    elif isinstance(as_of, Column):
        anchor = as_of
    elif isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:  # an instant: its UTC wall clock
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        anchor = F.lit(as_of.isoformat(sep=" "))
    else:
        anchor = F.lit(str(as_of)).cast(dtype)
    return (anchor.cast(dtype) - F.expr(f"INTERVAL {window}")).cast(dtype)


def trailing(df: DataFrame, ts: str, as_of, window: str) -> DataFrame:
    """Rows with ``ts >= as_of - window``; NULL timestamps drop out."""
    return df.where(F.col(ts) >= _bound(df, ts, as_of, window))


def total_revenue(fact_orders: DataFrame, as_of=None, window: str = "7 DAYS") -> DataFrame:
    """Sum of price over orders departing at or after ``as_of - window``.

    All currencies and statuses are summed; empty input gives 0.0.
    """
    return trailing(fact_orders, "time_key", as_of, window).agg(
        exact_sum("price").alias("total_revenue"))


def total_revenue_last_hour(fact_orders: DataFrame, as_of=None) -> DataFrame:
    return total_revenue(fact_orders, as_of, "1 HOUR")


def total_revenue_last_week(fact_orders: DataFrame, as_of=None) -> DataFrame:
    return total_revenue(fact_orders, as_of, "7 DAYS")


def active_sessions(clicks: DataFrame, as_of=None, minutes: int | None = None,
                    window: str | None = None, approximate: bool = False) -> DataFrame:
    """Distinct sessions with an event at or after ``as_of - window``.

    A NULL session counts as one value. ``approximate`` switches to HLL++.
    """
    if window is None:
        window = f"{minutes if minutes is not None else 15} MINUTES"
    kept = trailing(clicks, "event_timestamp", as_of, window)
    if approximate:
        from tidemark.functions.aggregates import approx_n_unique
        return kept.agg(approx_n_unique("session_id").alias("active_sessions"))
    return kept.agg(n_unique("session_id").alias("active_sessions"))


def active_sessions_last_15_minutes(clicks: DataFrame, as_of=None) -> DataFrame:
    return active_sessions(clicks, as_of, minutes=15)


def active_sessions_last_1_day(clicks: DataFrame, as_of=None) -> DataFrame:
    return active_sessions(clicks, as_of, window="1 DAY")


def kpi(name: str, fact_orders: DataFrame | None = None, clicks: DataFrame | None = None,
        as_of=None) -> DataFrame:
    """The KPI endpoint as a 1-row DataFrame ``(kpi string, value double)``.

    total_revenue: last 7 days of the gold fact table; active_sessions: last day
    of the bronze clickstream.
    """
    if name == "total_revenue":
        if fact_orders is None:
            raise ValueError("total_revenue needs fact_orders")
        v = total_revenue_last_week(fact_orders, as_of).select(
            F.col("total_revenue").cast("double").alias("value"))
    elif name == "active_sessions":
        if clicks is None:
            raise ValueError("active_sessions needs clicks")
        v = active_sessions_last_1_day(clicks, as_of).select(
            F.col("active_sessions").cast("double").alias("value"))
    else:
        raise ValueError(f"unknown kpi {name!r}; expected total_revenue or active_sessions")
    return v.select(F.lit(name).alias("kpi"), "value")
