"""Ingest-side queries: relaxed unions (U1, U2), tail (L1), UTC parsing (P4),
Kafka envelope codec (K15, P8, P9) and event fan-out (K17)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions.timestamps import parse_utc
from tidemark.operators import fanout as FO
from tidemark.operators import tail as TL
from tidemark.operators import union as U
from tidemark.plans import entities as E
from tidemark.plans.registry import register
from tidemark import schemas


def _feeds(spark, sf):
    """Two feeds of the same events with drifting types, split by event type."""
    ev = E.table(spark, sf, "events")
    a_types = ["view", "click"]
    a = ev.where(F.col("event_type").isin(a_types)).select(
        "event_id", "user_id", "event_type", "value", F.lit(None).alias("note"))
    b = ev.where(~F.coalesce(F.col("event_type").isin(a_types), F.lit(False))).select(
        F.col("event_id").cast("int").alias("event_id"), F.col("user_id").cast("string").alias("user_id"),
        "event_type", F.floor("value").alias("value"), F.col("props").alias("note"))
    return a, b


@register("union_relaxed", """
SELECT event_id, CAST(user_id AS VARCHAR) AS user_id, event_type, value, CAST(NULL AS VARCHAR) AS note
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT CAST(event_id AS BIGINT), CAST(user_id AS VARCHAR), event_type, CAST(CAST(floor(value) AS BIGINT) AS DOUBLE),
       props
FROM events WHERE coalesce(event_type NOT IN ('view', 'click'), true)""", "U1")
def q_union_relaxed(spark, sf):
    a, b = _feeds(spark, sf)
    return U.union_relaxed(a, b)


@register("union_diagonal", """
SELECT event_id, user_id, value, CAST(NULL AS VARCHAR) AS event_type, CAST(NULL AS VARCHAR) AS props
FROM events WHERE event_type IN ('view', 'click')
UNION ALL
SELECT event_id, CAST(NULL AS BIGINT), CAST(CAST(floor(value) AS BIGINT) AS DOUBLE), event_type, props
FROM events WHERE coalesce(event_type NOT IN ('view', 'click'), true)""", "U2")
def q_union_diagonal(spark, sf):
    ev = E.table(spark, sf, "events")
    a = ev.where(F.col("event_type").isin("view", "click")).select("event_id", "user_id", "value")
    b = ev.where(~F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))).select(
        "event_id", F.floor("value").alias("value"), "event_type", "props")
    return U.union_diagonal(a, b)


@register("tail_n", f"""
SELECT * FROM ({E.CLICKSTREAM_SQL}) c ORDER BY event_timestamp DESC, event_id DESC LIMIT 50""", "L1 L2")
def q_tail(spark, sf):
    return TL.tail_n(E.clickstream(spark, sf), 50, ["event_timestamp", "event_id"])


# Each event type writes its time in another style: Z, +05:30, +0530, naive, +00:00.
def _texts(spark, sf):
    ev = E.table(spark, sf, "events")
    base = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    shifted = F.col("ts") + F.expr("INTERVAL 5 HOURS 30 MINUTES")
    text = (F.when(F.col("event_type") == "view", F.concat(F.date_format("ts", base), F.lit("Z")))
            .when(F.col("event_type") == "click", F.concat(F.date_format(shifted, base), F.lit("+05:30")))
            .when(F.col("event_type") == "purchase", F.concat(F.date_format(shifted, base), F.lit("+0530")))
            .when(F.col("event_type") == "signup", F.date_format("ts", base))
            .otherwise(F.concat(F.date_format("ts", base), F.lit("+00:00"))))
    return ev.select("event_id", "event_type", "props", text.alias("text"))


_TEXTS_SQL = """
SELECT event_id, event_type, props,
  CASE event_type
    WHEN 'view' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z'
    WHEN 'click' THEN strftime(ts + INTERVAL 330 MINUTES, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30'
    WHEN 'purchase' THEN strftime(ts + INTERVAL 330 MINUTES, '%Y-%m-%dT%H:%M:%S.%f') || '+0530'
    WHEN 'signup' THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' END AS text
FROM events"""


@register("parse_utc", f"""
SELECT event_id, text,
       CASE WHEN event_type = 'signup' THEN CAST(text AS TIMESTAMP)
            ELSE CAST(text AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END AS parsed
FROM ({_TEXTS_SQL}) t""", "P4 strict")
def q_parse_utc(spark, sf):
    t = _texts(spark, sf)
    return t.select("event_id", "text", parse_utc("text").alias("parsed"))


@register("parse_utc_lenient", f"""
SELECT event_id, raw,
       CASE WHEN event_type = 'signup' THEN TRY_CAST(raw AS TIMESTAMP)
            ELSE TRY_CAST(raw AS TIMESTAMPTZ) AT TIME ZONE 'UTC' END AS parsed
FROM (SELECT event_id, event_type, CASE WHEN event_type = 'error' THEN props ELSE text END AS raw
      FROM ({_TEXTS_SQL}) t) r""", "P4 lenient")
def q_parse_lenient(spark, sf):
    t = _texts(spark, sf)
    raw = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("text"))
    return t.select("event_id", raw.alias("raw"), parse_utc(raw, strict=False).alias("parsed"))


@register("kafka_encode_decode", f"""
SELECT user_id AS key, event_id, user_id, session_id, event_type, event_timestamp, value
FROM ({E.CLICKSTREAM_SQL}) c""", "K15 P8 P9")
def q_kafka_codec(spark, sf):
    clicks = E.clickstream(spark, sf)
    env = FO.encode(clicks, topic="topic_0", key="user_id")
    schema = "event_id string, user_id string, session_id string, event_type string, " \
             "event_timestamp timestamp_ntz, value double"
    return FO.decode(env, schema, keep=("key",))


def bundles(spark, sf):
    """Bundles that hold every event once: the n-th view, cart and purchase of a user and day go together."""
    at = Window.partitionBy("user_id", "day").orderBy("timestamp", "event_id")

    def numbered(df, name):
        rows = df.withColumn("day", F.col("timestamp").cast("date"))
        return rows.select("user_id", "day", F.row_number().over(at).alias("n"), F.struct(*df.columns).alias(name))
    key = ["user_id", "day", "n"]
    out = numbered(E.product_views(spark, sf), "product_view").join(numbered(E.carts(spark, sf), "add_to_cart"), key, "full")
    return out.join(numbered(E.purchases(spark, sf), "purchase"), key, "full").select("product_view", "add_to_cart", "purchase")


@register("kafka_decode_iso", """
SELECT CAST(event_id AS VARCHAR) AS event_id, ts AS event_timestamp, props FROM events""", "P8 P4: five time styles of one message")
def q_decode_iso(spark, sf):
    texts = _texts(spark, sf)
    value = FO.json_value(F.col("event_id").cast("string").alias("event_id"), F.col("text").alias("event_timestamp"), "props")
    return FO.decode(texts.select(value.alias("value")), "event_id string, event_timestamp timestamp_ntz, props string")


@register("event_fanout", """
SELECT CASE event_type WHEN 'view' THEN 'ecomm_product_view' WHEN 'click' THEN 'ecomm_cart' ELSE 'ecomm_buy' END AS topic,
       count(*) AS messages, count(DISTINCT user_id) AS users
FROM events WHERE event_type IN ('view', 'click', 'purchase') GROUP BY 1""", "K17")
def q_fanout(spark, sf):
    msgs = FO.fan_out(bundles(spark, sf))
    return msgs.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"),
                                     F.count_distinct("key").alias("users"))


@register("event_fanout_decode", f"""
SELECT event_id, user_id, order_id, purchase_product_id, purchase_quantity, price, timestamp FROM ({E.PURCHASES_SQL}) b""", "K17 P8 round trip")
def q_fanout_decode(spark, sf):
    msgs = FO.fan_out(bundles(spark, sf)).where(F.col("topic") == FO.BUY_TOPIC)
    dec = FO.decode(msgs, schemas.with_ntz(schemas.PURCHASE))
    return dec.select("event_id", "user_id", "order_id", "purchase_product_id", "purchase_quantity", "price",
                      "timestamp")
