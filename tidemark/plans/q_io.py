"""Reader/writer round trips (S1-S9, S12-S15, K1-K10) over the orders table.

Each query writes the whole table under the session's checkpoint root with one
of the writers and returns what the matching reader gives back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import entities as E
from tidemark.plans.registry import register
from tidemark.session import scratch_dir
from tidemark.sinks import files as W
from tidemark.sources import files as R

_ORDERS = "SELECT * FROM orders"


def _orders(spark, sf):
    return E.table(spark, sf, "orders")


@register("csv_roundtrip", _ORDERS, "S1 K1")
def q_csv(spark, sf):
    o = _orders(spark, sf)
    path = scratch_dir(spark, "orders") + ".csv"
    W.write_csv(o, path)
    return R.read_csv(spark, path, schema=o.schema)


@register("csv_roundtrip_inferred", _ORDERS, "S1 inferred types")
def q_csv_infer(spark, sf):
    o = _orders(spark, sf)
    path = scratch_dir(spark, "orders") + ".csv"
    W.write_csv(o, path, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    back = R.read_csv(spark, path, preferDate=False, timestampNTZFormat="yyyy-MM-dd HH:mm:ss")
    # Inference types whole numbers as int when they fit: cast to the table's types.
    return back.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in o.schema.fields])


@register("json_roundtrip", _ORDERS, "S3 K3 documents")
def q_json(spark, sf):
    o = _orders(spark, sf)
    path = scratch_dir(spark, "orders") + ".json"
    W.write_json_documents(o, path, rows_per_document=2_000)
    return R.read_json(spark, path, schema=o.schema, recursiveFileLookup=True)


@register("ndjson_roundtrip", _ORDERS, "S7 K5")
def q_ndjson(spark, sf):
    o = _orders(spark, sf)
    path = scratch_dir(spark, "orders") + ".ndjson"
    W.write_ndjson(o, path)
    return R.read_ndjson(spark, path, schema=o.schema)


@register("parquet_roundtrip", _ORDERS, "S5 K7 list of paths, compression")
def q_parquet(spark, sf):
    o = _orders(spark, sf)
    base = scratch_dir(spark, "orders")
    finished = F.col("o_orderstatus") == "F"
    W.write_parquet(o.where(finished), f"{base}/finished", compression="zstd")
    W.write_parquet(o.where(~finished | F.col("o_orderstatus").isNull()), f"{base}/open", compression="zstd")
    return R.read_parquet(spark, [f"{base}/finished", f"{base}/open"])


_LINE = "concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR), o_orderstatus, o_orderpriority)"


@register("text_roundtrip", f"SELECT {_LINE} AS value FROM orders", "S9 K9 K10 overwrite then append")
def q_text(spark, sf):
    o = _orders(spark, sf)
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"),
                       "o_orderstatus", "o_orderpriority").alias("value")
    path = scratch_dir(spark, "orders") + ".txt"
    early = F.coalesce(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), F.lit(False))
    W.write_text(o.where(early).select(line), path)
    W.append_text(o.where(~early).select(line), path)
    return R.read_text(spark, path)


def _batches(spark, sf):
    """Orders landed as one CSV batch folder per order year."""
    o = _orders(spark, sf)
    root = scratch_dir(spark, "landing")
    (o.withColumn("batch", F.year("o_orderdate").cast("string"))
      .write.partitionBy("batch").option("header", True).csv(root))
    return o, root


@register("latest_file", "SELECT * FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
          "S12 S15 S16 pick the latest batch, read it")
def q_latest(spark, sf):
    o, root = _batches(spark, sf)
    newest = R.latest_path(spark, root, "*.csv")
    return R.read_csv(spark, newest.rsplit("/", 1)[0], schema=o.schema)


@register("file_inventory_folders", "SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS batch FROM orders WHERE o_orderdate IS NOT NULL",
          "S12 S13 S14 one folder per landed year, found by a path glob")
def q_inventory_folders(spark, sf):
    _, root = _batches(spark, sf)
    files = R.file_inventory(spark, root, "**/batch=*/*.csv")
    return files.select(F.regexp_extract("path", "batch=([0-9]+)/", 1).alias("batch")).distinct()


@register("text_whole_file", f"SELECT CAST(sum(length({_LINE}) + 1) AS BIGINT) AS characters, count(*) AS lines FROM orders", "S9 whole files")
def q_text_whole(spark, sf):
    o = _orders(spark, sf)
    line = F.concat_ws("|", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus", "o_orderpriority").alias("value")
    path = scratch_dir(spark, "orders") + ".txt"
    W.write_text(o.select(line), path)
    whole = R.read_text(spark, path, whole=True)
    lines = F.length("value") - F.length(F.translate("value", "\n", ""))
    return whole.agg(F.sum(F.length("value")).alias("characters"), F.sum(lines).alias("lines"))


@register("file_inventory", None, "S12 S13 S14 listing (rows = files)")
def q_inventory(spark, sf):
    _, root = _batches(spark, sf)
    return R.file_inventory(spark, root, "*.csv")
