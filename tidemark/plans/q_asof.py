"""As-of join queries (J1, J2, ST4) over view / cart / purchase events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import asof as A
from tidemark.plans import entities as E
from tidemark.plans.registry import register

_V, _C, _B = f"({E.VIEWS_SQL})", f"({E.CARTS_SQL})", f"({E.PURCHASES_SQL})"

_CV_SQL = f"""(SELECT c.event_id, c.user_id, v.view_product_id, v.view_product_name, v.view_category,
        c.timestamp, c.cart_product_id, c.cart_product_name, c.cart_quantity, c.price
 FROM {_C} c ASOF LEFT JOIN {_V} v ON c.user_id = v.user_id AND c.timestamp >= v.timestamp)"""


@register("asof_cart_view", _CV_SQL, "J1")
def q_cart_view(spark, sf):
    return A.asof_join(E.carts(spark, sf), E.product_views(spark, sf), "user_id", "timestamp",
                       tiebreak="event_id")


_NULL_V = f"(SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 7 = 0 THEN NULL ELSE timestamp END AS timestamp) FROM {_V} v)"
_NULL_C = f"(SELECT * REPLACE (CASE WHEN CAST(event_id AS BIGINT) % 5 = 0 THEN NULL ELSE timestamp END AS timestamp) FROM {_C} c)"


@register("asof_null_times", f"""
SELECT c.event_id, c.user_id, v.view_product_id, v.view_product_name, v.view_category,
       c.timestamp, c.cart_product_id, c.cart_product_name, c.cart_quantity, c.price
FROM {_NULL_C} c LEFT JOIN LATERAL (
  SELECT * FROM {_NULL_V} v WHERE v.user_id = c.user_id AND v.timestamp <= c.timestamp
  ORDER BY v.timestamp DESC, v.event_id DESC LIMIT 1) v ON true""", "J1 NULL times never match")
def q_null_times(spark, sf):
    def some_null(df, n):
        return df.withColumn("timestamp", F.when(F.col("event_id").cast("bigint") % n != 0, F.col("timestamp")))
    return A.asof_join(some_null(E.carts(spark, sf), 5), some_null(E.product_views(spark, sf), 7), "user_id", "timestamp", tiebreak="event_id")


JOURNEY_SQL = f"""
SELECT b.event_id, b.user_id, cv.view_product_id, cv.view_product_name, cv.view_category, b.timestamp,
       cv.cart_product_id, cv.cart_product_name, cv.cart_quantity, b.price, b.order_id,
       b.purchase_product_id, b.purchase_product_name, b.purchase_quantity, b.total_amount, b.payment_method
FROM {_B} b ASOF LEFT JOIN {_CV_SQL} cv ON b.user_id = cv.user_id AND b.timestamp >= cv.timestamp"""


_IN_7 = "CASE WHEN {x}.timestamp >= {y}.timestamp - INTERVAL 7 DAYS THEN {x}.{c} END AS {c}"
_VIEW, _CART = ("view_product_id", "view_product_name", "view_category"), ("cart_product_id", "cart_product_name", "cart_quantity")
GRACE_SQL = f"""
SELECT b.event_id, b.user_id, {", ".join(_IN_7.format(x="cv", y="b", c=c) for c in _VIEW)}, b.timestamp,
       {", ".join(_IN_7.format(x="cv", y="b", c=c) for c in _CART)}, b.price, b.order_id,
       b.purchase_product_id, b.purchase_product_name, b.purchase_quantity, b.total_amount, b.payment_method
FROM {_B} b ASOF LEFT JOIN (
  SELECT c.event_id, c.user_id, c.timestamp, c.cart_product_id, c.cart_product_name, c.cart_quantity,
         {", ".join(_IN_7.format(x="v", y="c", c=c) for c in _VIEW)}
  FROM {_C} c ASOF LEFT JOIN {_V} v ON c.user_id = v.user_id AND c.timestamp >= v.timestamp) cv
ON b.user_id = cv.user_id AND b.timestamp >= cv.timestamp"""


@register("customer_journey_grace", GRACE_SQL, "J2 ST4 seven days of grace")
def q_journey_grace(spark, sf):
    return A.customer_journey(E.product_views(spark, sf), E.carts(spark, sf), E.purchases(spark, sf), tolerance="7 DAYS")


@register("customer_journey", JOURNEY_SQL, "J2")
def q_journey(spark, sf):
    return A.customer_journey(E.product_views(spark, sf), E.carts(spark, sf), E.purchases(spark, sf))


@register("customer_journey_daily_buckets", f"""
SELECT b.event_id, b.user_id, cv.view_product_id, cv.view_product_name, cv.view_category, b.timestamp,
       cv.cart_product_id, cv.cart_product_name, cv.cart_quantity, b.price, b.order_id,
       b.purchase_product_id, b.purchase_product_name, b.purchase_quantity, b.total_amount, b.payment_method
FROM {_B} b ASOF LEFT JOIN {_CV_SQL} cv ON b.user_id = cv.user_id AND b.timestamp >= cv.timestamp""",
          "J2 with day buckets")
def q_journey_day(spark, sf):
    return A.customer_journey(E.product_views(spark, sf), E.carts(spark, sf), E.purchases(spark, sf),
                              bucket="day")


@register("asof_grace", f"""
SELECT b.event_id, b.user_id,
       CASE WHEN c.timestamp >= b.timestamp - INTERVAL 1 DAY THEN c.cart_product_id END AS cart_product_id,
       CASE WHEN c.timestamp >= b.timestamp - INTERVAL 1 DAY THEN c.cart_product_name END AS cart_product_name,
       CASE WHEN c.timestamp >= b.timestamp - INTERVAL 1 DAY THEN c.cart_quantity END AS cart_quantity,
       b.price, b.timestamp, b.order_id, b.purchase_product_id, b.purchase_product_name,
       b.purchase_quantity, b.total_amount, b.payment_method
FROM {_B} b ASOF LEFT JOIN {_C} c ON b.user_id = c.user_id AND b.timestamp >= c.timestamp""", "J1 ST4 tolerance")
def q_grace(spark, sf):
    return A.asof_join(E.purchases(spark, sf), E.carts(spark, sf), "user_id", "timestamp",
                       tolerance="1 DAY", tiebreak="event_id")


@register("asof_buy_cart", f"""
SELECT b.event_id, b.user_id, c.cart_product_id, c.cart_product_name, c.cart_quantity, b.price, b.timestamp,
       b.order_id, b.purchase_product_id, b.purchase_product_name, b.purchase_quantity, b.total_amount,
       b.payment_method
FROM {_B} b ASOF LEFT JOIN {_C} c ON b.user_id = c.user_id AND b.timestamp >= c.timestamp""", "J1")
def q_buy_cart(spark, sf):
    return A.asof_join(E.purchases(spark, sf), E.carts(spark, sf), "user_id", "timestamp", tiebreak="event_id")
