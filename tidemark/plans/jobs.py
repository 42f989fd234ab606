"""The pipeline jobs: bronze refresh (T11), gold refresh (T12), publish (T13).

Each is a plain function over tables and paths; ``q_jobs`` registers runs of
them over the test tables.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import parse_utc
from tidemark.operators import merge as M
from tidemark.operators import star as S
from tidemark.operators.fanout import decode
from tidemark.sinks import files as W
from tidemark.sources import files as R
from tidemark.table import VersionedTable

UPSERT = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)

# Key columns of the gold tables; the first one spreads the files.
GOLD_KEYS = {"dim_time": ["time_key"], "dim_product": ["product_key", "price", "currency"],
             "dim_customer": ["customer_key", "agency_id"], "fact_orders": ["order_id"]}


def feed_refresh(bronze: VersionedTable, feed: DataFrame, key: str, time_columns=()) -> dict:
    """Any feed's rows (files, a database, decoded messages) merged into a bronze table by ``key``.

    ``time_columns`` that are text are parsed as UTC.
    """
    texts = [c for c in time_columns if dict(feed.dtypes)[c] == "string"]
    return bronze.merge(feed.withColumns({c: parse_utc(c) for c in texts}), UPSERT, on=[key])


def clickstream_refresh(bronze: VersionedTable, envelope: DataFrame, schema, rows: DataFrame | None = None) -> dict:
    """Clickstream messages, and optionally the rows of a database feed, merged into bronze on event_id."""
    feed = decode(envelope, schema)
    return feed_refresh(bronze, feed if rows is None else feed.unionByName(rows.select(*feed.columns)), "event_id")


def bronze_bookings_refresh(spark: SparkSession, landing_root: str, bronze: VersionedTable,
                            time_columns=("departure_date", "arrival_date"), schema=None) -> dict:
    """Latest CSV batch -> timestamps parsed as UTC -> MERGE on booking_id."""
    newest = R.latest_path(spark, landing_root, "*.csv")
    batch = R.read_csv(spark, newest.rsplit("/", 1)[0], schema=schema)
    return feed_refresh(bronze, batch, "booking_id", time_columns)


def gold_refresh(spark: SparkSession, bronze: DataFrame, gold_root: str, num_buckets: int = 16) -> dict:
    """Star schema of the bronze bookings, each output merged into its gold table.

    Each output reads the two to five bronze columns it needs; nothing is kept
    in executor memory between them.
    """
    stats = {}
    for name, df in S.star_schema(bronze)._asdict().items():
        table = VersionedTable(spark, f"{gold_root}/{name}")
        if not table.exists():
            table.write(spark.createDataFrame([], df.schema), bucket_by=GOLD_KEYS[name][:1], num_buckets=num_buckets)
        stats[name] = table.merge(df, UPSERT, on=GOLD_KEYS[name])
    return stats


def publish(df: DataFrame, csv_path: str | None = None, parquet_path: str | None = None,
            jdbc: dict | None = None, kafka: dict | None = None) -> None:
    """One input, several sinks: computed once (persisted), written to each."""
    data = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if csv_path:
            W.write_csv(data, csv_path)
        if parquet_path:
            W.write_parquet(data, parquet_path)
        if jdbc:
            from tidemark.sources.jdbc import write_jdbc
            write_jdbc(data, **jdbc)
        if kafka:
            from tidemark.operators.fanout import encode
            from tidemark.sources.kafka import write_kafka
            write_kafka(encode(data, key=kafka.get("key")), kafka["servers"], kafka["topic"])
    finally:
        data.unpersist()


def iso_text(df: DataFrame, columns) -> DataFrame:
    """Timestamps as ISO-8601 UTC text (``...Z``), the way feeds deliver them."""
    fmt = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return df.withColumns({c: F.concat(F.date_format(c, fmt), F.lit("Z")) for c in columns})
