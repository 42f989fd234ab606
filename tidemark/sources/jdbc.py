"""JDBC reader and writer.

A query is pushed to the database as a subquery. For large tables read by
``table`` with a numeric ``partition_column`` and bounds: Spark then issues
``num_partitions`` range queries in parallel instead of one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              properties: dict | None = None, partition_column: str | None = None,
              lower_bound: int | None = None, upper_bound: int | None = None,
              num_partitions: int | None = None, fetch_size: int = 10000) -> DataFrame:
    if (query is None) == (table is None):
        raise ValueError("give exactly one of query or table")
    r = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in (properties or {}).items():
        r = r.option(k, v)
    if query is not None:
        if partition_column:
            # Partitioned reads need a table expression; wrap the query.
            r = r.option("dbtable", f"({query}) AS q")
        else:
            r = r.option("query", query)
    else:
        r = r.option("dbtable", table)
    if partition_column:
        r = (r.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
             .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return r.load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append", properties: dict | None = None,
               batch_size: int = 10000, num_partitions: int | None = None) -> None:
    """Append by default, as the reference publishes (re-publishing duplicates rows).
    ``num_partitions`` caps the concurrent connections."""
    out = df.coalesce(num_partitions) if num_partitions else df
    w = out.write.format("jdbc").option("url", url).option("dbtable", table).option("batchsize", batch_size)
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.mode(mode).save()
