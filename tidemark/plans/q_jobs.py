"""Pipeline job runs over the test tables (T11-T13)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.plans import entities as E
from tidemark.plans import jobs as JB
from tidemark.operators.fanout import encode
from tidemark.plans.registry import register
from tidemark.sources import files as R
from tidemark.session import scratch_dir
from tidemark.table import VersionedTable

_B = f"({E.BOOKINGS_SQL})"
_CUT = "2001-01-01 00:00:00"


def _bronze(spark, sf, root):
    """Historic load (departures before 2001) plus a refresh from the landed CSV batches."""
    bookings = E.bookings(spark, sf)
    bronze = VersionedTable(spark, f"{root}/bronze")
    bronze.write(bookings.where(F.col("departure_date") < F.lit(_CUT).cast("timestamp_ntz")),
                 bucket_by="booking_id", num_buckets=16)
    landed = JB.iso_text(bookings, ["departure_date", "arrival_date"]).withColumn(
        "batch", F.year("departure_date").cast("string"))
    landed.write.partitionBy("batch").option("header", True).csv(f"{root}/landing")
    # The feed delivers times as text; the refresh parses them.
    text_schema = T.StructType([T.StructField(f.name, T.StringType() if f.name in ("departure_date", "arrival_date")
                                              else f.dataType, True) for f in bookings.schema.fields])
    JB.bronze_bookings_refresh(spark, f"{root}/landing", bronze, schema=text_schema)
    return bronze


@register("bronze_bookings_refresh", f"SELECT * FROM {_B} b", "T11 S15 P4 M1: latest CSV batch merged into bronze")
def q_bronze(spark, sf):
    root = scratch_dir(spark, "bronze")
    return _bronze(spark, sf, root).read()


def _gold(spark, sf, name):
    root = scratch_dir(spark, "gold")
    bronze = _bronze(spark, sf, root)
    JB.gold_refresh(spark, bronze.read(), f"{root}/gold")
    # A second refresh of the same bronze snapshot changes nothing (idempotent).
    JB.gold_refresh(spark, bronze.read(), f"{root}/gold")
    return VersionedTable(spark, f"{root}/gold/{name}").read()


@register("gold_refresh_fact_orders", f"""
SELECT booking_id AS order_id, departure_date AS time_key, flight_number AS product_key,
       customer_name AS customer_key, price FROM {_B} b""", "T12 T1 T5 M1 J4")
def q_gold_fact(spark, sf):
    return _gold(spark, sf, "fact_orders")


@register("gold_refresh_dim_customer", f"""
SELECT DISTINCT customer_name AS customer_key, agency_id FROM {_B} b""", "T12 T4 J4 aliases s/t")
def q_gold_customer(spark, sf):
    return _gold(spark, sf, "dim_customer")


@register("gold_refresh_dim_product", f"""
SELECT DISTINCT flight_number AS product_key, price, currency FROM {_B} b""", "T12 T3: currency is part of the key")
def q_gold_product(spark, sf):
    return _gold(spark, sf, "dim_product").select("product_key", "price", "currency")


@register("gold_refresh_dim_time", f"""
SELECT DISTINCT departure_date AS time_key, CAST(year(departure_date) AS INTEGER) AS year,
       CAST(month(departure_date) AS INTEGER) AS month, CAST(day(departure_date) AS INTEGER) AS day
FROM {_B} b""", "T12 T2")
def q_gold_time(spark, sf):
    t = _gold(spark, sf, "dim_time")
    return t.select("time_key", *[F.col(c).cast("int").alias(c) for c in ("year", "month", "day")])


@register("bronze_clickstream_refresh", f"SELECT * FROM ({E.CLICKSTREAM_SQL}) c", "T11 S18 P8 M1: messages and database rows merged on event_id")
def q_clickstream(spark, sf):
    clicks = E.clickstream(spark, sf)
    table = VersionedTable(spark, scratch_dir(spark, "clicks"))
    first = F.col("event_timestamp") < F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    early = F.coalesce(first, F.lit(False))
    # Loaded before, with values that the refresh corrects.
    table.write(clicks.where(early).withColumn("value", -F.col("value")), bucket_by="event_id", num_buckets=16)
    by_message = F.pmod(F.xxhash64("event_id"), F.lit(2)) == 0
    feed = JB.iso_text(clicks.where(by_message), ["event_timestamp"])
    JB.clickstream_refresh(table, encode(feed, key="user_id"), clicks.schema, rows=clicks.where(~by_message))
    return table.read()


@register("publish_bookings_csv", f"SELECT * FROM {_B} b", "T13 K1: the CSV sink read back")
def q_publish_csv(spark, sf):
    root = scratch_dir(spark, "publish")
    bookings = E.bookings(spark, sf)
    JB.publish(bookings, csv_path=f"{root}/bookings.csv")
    return R.read_csv(spark, f"{root}/bookings.csv", schema=bookings.schema)


@register("publish_bookings", f"SELECT * FROM {_B} b", "T13 K1 K7: one input, several sinks")
def q_publish(spark, sf):
    root = scratch_dir(spark, "publish")
    JB.publish(E.bookings(spark, sf), csv_path=f"{root}/bookings.csv", parquet_path=f"{root}/bookings.parquet")
    return spark.read.parquet(f"{root}/bookings.parquet")
