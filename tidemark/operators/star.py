"""Bookings to a star schema: three dimensions and one fact table.

All four outputs are projections of one input. When all four are written, cache
or checkpoint the input once; otherwise each output is its own pruned scan.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Star(NamedTuple):
    dim_time: DataFrame
    dim_product: DataFrame
    dim_customer: DataFrame
    fact_orders: DataFrame


def dim_time(bookings: DataFrame) -> DataFrame:
    """Distinct departure instants with their calendar parts.

    The key is the raw timestamp (microseconds kept, not truncated).
    """
    d = F.col("departure_date")
    return bookings.select(
        d.alias("time_key"),
        F.hour(d).cast("tinyint").alias("hour"),
        F.dayofmonth(d).cast("tinyint").alias("day"),
        F.month(d).cast("tinyint").alias("month"),
        F.year(d).cast("int").alias("year"),
    ).distinct()


def dim_product(bookings: DataFrame) -> DataFrame:
    """Distinct (flight, price, currency); a flight may carry many prices."""
    return bookings.select(
        F.col("flight_number").alias("product_key"), F.col("price"), F.col("currency")
    ).distinct()


def dim_customer(bookings: DataFrame) -> DataFrame:
    return bookings.select(
        F.col("customer_name").alias("customer_key"), F.col("agency_id")
    ).distinct()


def fact_orders(bookings: DataFrame) -> DataFrame:
    """One row per booking, not deduplicated."""
    return bookings.select(
        F.col("booking_id").alias("order_id"),
        F.col("departure_date").alias("time_key"),
        F.col("flight_number").alias("product_key"),
        F.col("customer_name").alias("customer_key"),
        F.col("price"),
    )


def star_schema(bookings: DataFrame) -> Star:
    return Star(dim_time(bookings), dim_product(bookings), dim_customer(bookings),
                fact_orders(bookings))
