"""Star schema and KPI queries (T1-T10, A1, A2, A4, P5, P6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import kpi as K
from tidemark.operators import star as S
from tidemark.plans import entities as E
from tidemark.plans.registry import register

_B = f"({E.BOOKINGS_SQL})"
_C = f"({E.CLICKSTREAM_SQL})"


@register("star_dim_time", f"""
SELECT DISTINCT departure_date AS time_key,
       CAST(hour(departure_date) AS TINYINT) AS hour,
       CAST(day(departure_date) AS TINYINT) AS day,
       CAST(month(departure_date) AS TINYINT) AS month,
       CAST(year(departure_date) AS INTEGER) AS year
FROM {_B} b""", "T1 T2 P5 A4")
def q_dim_time(spark, sf):
    return S.dim_time(E.bookings(spark, sf))


@register("star_dim_product", f"""
SELECT DISTINCT flight_number AS product_key, price, currency FROM {_B} b""", "T3 A4")
def q_dim_product(spark, sf):
    return S.dim_product(E.bookings(spark, sf))


@register("star_dim_customer", f"""
SELECT DISTINCT customer_name AS customer_key, agency_id FROM {_B} b""", "T4 A4")
def q_dim_customer(spark, sf):
    return S.dim_customer(E.bookings(spark, sf))


@register("star_fact_orders", f"""
SELECT booking_id AS order_id, departure_date AS time_key, flight_number AS product_key,
       customer_name AS customer_key, price
FROM {_B} b""", "T5 P1")
def q_fact_orders(spark, sf):
    return S.fact_orders(E.bookings(spark, sf))


def _fact(spark, sf):
    return S.fact_orders(E.bookings(spark, sf))


def _rev_sql(interval: str, as_of: str) -> str:
    return f"""
SELECT COALESCE(CAST(SUM(CAST(price AS DECIMAL(38,9))) AS DOUBLE), 0.0) AS total_revenue
FROM (SELECT departure_date AS time_key, price FROM {_B} b) f
WHERE time_key >= TIMESTAMP '{as_of}' - INTERVAL {interval}"""


@register("kpi_revenue_last_hour", _rev_sql("1 HOUR", E.ORDERS_AS_OF), "T6 P6 P7 A1")
def q_rev_hour(spark, sf):
    return K.total_revenue_last_hour(_fact(spark, sf), E.ORDERS_AS_OF)


@register("kpi_revenue_last_week", _rev_sql("7 DAYS", E.ORDERS_AS_OF), "T7 P6 A1")
def q_rev_week(spark, sf):
    return K.total_revenue_last_week(_fact(spark, sf), E.ORDERS_AS_OF)


@register("kpi_revenue_last_year", _rev_sql("365 DAYS", E.ORDERS_AS_OF), "T7 P6 A1")
def q_rev_year(spark, sf):
    return K.total_revenue(_fact(spark, sf), E.ORDERS_AS_OF, "365 DAYS")


# A thousandth of each price: the oracle adds whole tenths of a cent's hundredths.
@register("kpi_revenue_subcent", f"""
SELECT CAST(SUM(CAST(round(price * 100) AS BIGINT)) AS DOUBLE) / 100000 AS total_revenue
FROM (SELECT departure_date AS time_key, price FROM {_B} b) f
WHERE time_key >= TIMESTAMP '{E.ORDERS_AS_OF}' - INTERVAL 365 DAYS""", "A1 prices below a cent")
def q_rev_subcent(spark, sf):
    fact = _fact(spark, sf)
    # Decimal arithmetic: a double's price / 1000 is not the decimal one.
    return K.total_revenue(fact.withColumn("price", F.col("price").cast("decimal(20,2)") / 1000), E.ORDERS_AS_OF, "365 DAYS")


_FAR_FUTURE = "2200-01-01 00:00:00"


@register("kpi_revenue_empty", _rev_sql("7 DAYS", _FAR_FUTURE), "A1 empty input")
def q_rev_empty(spark, sf):
    return K.total_revenue_last_week(_fact(spark, sf), _FAR_FUTURE)


def _sessions_sql(interval: str) -> str:
    return f"""
SELECT CAST(COUNT(DISTINCT session_id) + COALESCE(MAX(CAST(session_id IS NULL AS INTEGER)), 0) AS BIGINT)
       AS active_sessions
FROM {_C} c
WHERE event_timestamp >= TIMESTAMP '{E.EVENTS_AS_OF}' - INTERVAL {interval}"""


@register("kpi_active_sessions_15min", _sessions_sql("15 MINUTES"), "T8 A2")
def q_sessions_15(spark, sf):
    return K.active_sessions_last_15_minutes(E.clickstream(spark, sf), E.EVENTS_AS_OF)


@register("kpi_active_sessions_1day", _sessions_sql("1 DAY"), "T9 A2")
def q_sessions_1d(spark, sf):
    return K.active_sessions_last_1_day(E.clickstream(spark, sf), E.EVENTS_AS_OF)


@register("kpi_active_sessions_30day", _sessions_sql("30 DAYS"), "T9 A2")
def q_sessions_30d(spark, sf):
    return K.active_sessions(E.clickstream(spark, sf), E.EVENTS_AS_OF, window="30 DAYS")


# Sessions keyed so that a third of them are NULL (signup events carry no
# session yet): NULL must count as one value.
@register("kpi_active_sessions_null", f"""
SELECT CAST(COUNT(DISTINCT session_id) + COALESCE(MAX(CAST(session_id IS NULL AS INTEGER)), 0) AS BIGINT)
       AS active_sessions
FROM (SELECT CASE WHEN event_type = 'signup' THEN NULL ELSE session_id END AS session_id,
             event_timestamp FROM {_C} c) c
WHERE event_timestamp >= TIMESTAMP '{E.EVENTS_AS_OF}' - INTERVAL 3 DAYS""", "A2 null semantics")
def q_sessions_null(spark, sf):
    clicks = E.clickstream(spark, sf).withColumn(
        "session_id", F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("session_id")))
    return K.active_sessions(clicks, E.EVENTS_AS_OF, window="3 DAYS")


@register("kpi_table", f"""
SELECT 'total_revenue' AS kpi, total_revenue AS value FROM ({_rev_sql("7 DAYS", E.ORDERS_AS_OF)}) r
UNION ALL
SELECT 'active_sessions' AS kpi, CAST(active_sessions AS DOUBLE) AS value FROM ({_sessions_sql("1 DAY")}) s
""", "T10")
def q_kpi_table(spark, sf):
    fact = _fact(spark, sf)
    clicks = E.clickstream(spark, sf)
    return K.kpi("total_revenue", fact_orders=fact, as_of=E.ORDERS_AS_OF).unionByName(
        K.kpi("active_sessions", clicks=clicks, as_of=E.EVENTS_AS_OF))
