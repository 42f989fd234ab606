"""Bookings and events, derived from the driver's test tables.

bookings  = orders joined to customer
clickstream = events
view / cart / buy = events of type view / click / purchase

All timestamps stay ``timestamp_ntz`` as stored. The derivations are plain
projections, so Catalyst prunes the scan to the columns a query uses and pushes
filters on them into the parquet reader.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Stand-in values, picked by a key modulo 4.
CURRENCIES = ("CHF", "NOK", "JPY", "CAD")
PAYMENT_METHODS = ("invoice", "wallet", "voucher", "debit")
PRODUCT_NAMES = ("kettle", "lantern", "notebook", "umbrella")
CATEGORIES = ("kitchen", "camping", "paper", "rain")

# Anchors ("now") that make the trailing-range KPIs deterministic on the test data.
ORDERS_AS_OF = "2001-08-01 00:00:00"
EVENTS_AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pick(values: tuple[str, ...], idx: Column) -> Column:
    """``values[idx]`` as a CASE expression (stays inside codegen)."""
    expr = F.when(idx == 0, F.lit(values[0]))
    for i, v in enumerate(values[1:], start=1):
        expr = expr.when(idx == i, F.lit(v))
    return expr


def bookings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partner-agency bookings: one row per order with a known customer."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    j = o.join(c, o.o_custkey == c.c_custkey, "inner")
    return j.select(
        F.col("o_orderkey").cast("string").alias("booking_id"),
        F.concat(F.lit("agency"), (F.col("o_custkey") % 4 + 1).cast("string")).alias("agency_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("VA"), (F.col("o_orderkey") % 9000 + 1000).cast("string")).alias("flight_number"),
        F.col("o_orderdate").alias("departure_date"),
        (F.col("o_orderdate") + F.expr("INTERVAL 1 DAY")).alias("arrival_date"),
        F.col("o_totalprice").alias("price"),
        _pick(CURRENCIES, F.col("o_orderkey") % 4).alias("currency"),
        F.col("o_orderstatus").alias("status"),
    )


BOOKINGS_SQL = f"""
SELECT CAST(o_orderkey AS VARCHAR) AS booking_id,
       'agency' || CAST(o_custkey % 4 + 1 AS VARCHAR) AS agency_id,
       c_name AS customer_name,
       'VA' || CAST(o_orderkey % 9000 + 1000 AS VARCHAR) AS flight_number,
       o_orderdate AS departure_date,
       o_orderdate + INTERVAL 1 DAY AS arrival_date,
       o_totalprice AS price,
       CASE o_orderkey % 4 {' '.join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(CURRENCIES))} END AS currency,
       o_orderstatus AS status
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clickstream events; a session is one user's day."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.col("user_id").cast("string"), F.lit("-"),
                 F.col("ts").cast("date").cast("string")).alias("session_id"),
        F.col("event_type"),
        F.col("ts").alias("event_timestamp"),
        F.col("value"),
    )


CLICKSTREAM_SQL = """
SELECT CAST(event_id AS VARCHAR) AS event_id,
       CAST(user_id AS VARCHAR) AS user_id,
       CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
       event_type,
       ts AS event_timestamp,
       value
FROM events
"""


def _k() -> Column:
    return F.get_json_object(F.col("props"), "$.k").cast("bigint")


def product_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "view")
    k = _k()
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("product"), k.cast("string")).alias("view_product_id"),
        _pick(PRODUCT_NAMES, k % 4).alias("view_product_name"),
        _pick(CATEGORIES, k % 4).alias("view_category"),
        F.col("ts").alias("timestamp"),
    )


def carts(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "click")
    k = _k()
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("product"), k.cast("string")).alias("cart_product_id"),
        _pick(PRODUCT_NAMES, k % 4).alias("cart_product_name"),
        (k % 5 + 1).alias("cart_quantity"),
        F.col("value").alias("price"),
        F.col("ts").alias("timestamp"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase")
    k = _k()
    return e.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.concat(F.lit("order"), F.col("event_id").cast("string")).alias("order_id"),
        F.concat(F.lit("product"), k.cast("string")).alias("purchase_product_id"),
        _pick(PRODUCT_NAMES, k % 4).alias("purchase_product_name"),
        (k % 5 + 1).alias("purchase_quantity"),
        F.col("value").alias("price"),
        F.col("ts").alias("timestamp"),
        (F.col("value") * (k % 5 + 1)).alias("total_amount"),
        _pick(PAYMENT_METHODS, F.col("event_id") % 4).alias("payment_method"),
    )


_K_SQL = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _pick_sql(values: tuple[str, ...], idx: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {idx} {arms} END"


VIEWS_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       'product' || CAST({_K_SQL} AS VARCHAR) AS view_product_id,
       {_pick_sql(PRODUCT_NAMES, f'{_K_SQL} % 4')} AS view_product_name,
       {_pick_sql(CATEGORIES, f'{_K_SQL} % 4')} AS view_category,
       ts AS timestamp
FROM events WHERE event_type = 'view'
"""

CARTS_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       'product' || CAST({_K_SQL} AS VARCHAR) AS cart_product_id,
       {_pick_sql(PRODUCT_NAMES, f'{_K_SQL} % 4')} AS cart_product_name,
       {_K_SQL} % 5 + 1 AS cart_quantity,
       value AS price,
       ts AS timestamp
FROM events WHERE event_type = 'click'
"""

PURCHASES_SQL = f"""
SELECT CAST(event_id AS VARCHAR) AS event_id, CAST(user_id AS VARCHAR) AS user_id,
       'order' || CAST(event_id AS VARCHAR) AS order_id,
       'product' || CAST({_K_SQL} AS VARCHAR) AS purchase_product_id,
       {_pick_sql(PRODUCT_NAMES, f'{_K_SQL} % 4')} AS purchase_product_name,
       {_K_SQL} % 5 + 1 AS purchase_quantity,
       value AS price,
       ts AS timestamp,
       value * ({_K_SQL} % 5 + 1) AS total_amount,
       {_pick_sql(PAYMENT_METHODS, 'event_id % 4')} AS payment_method
FROM events WHERE event_type = 'purchase'
"""
