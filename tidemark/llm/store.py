"""Intermediate tables of the operators, in the shared folder that ``spark.checkpoint.dir`` names.

A table written there outlives the executors that wrote it, and reading it back
cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.session import scratch_dir


def stored(df: DataFrame, name: str, tasks: int | None = None) -> DataFrame:
    """``df`` written and read back; by ``tasks`` tasks at most, where its size is known to be small for more."""
    spark = df.sparkSession
    df = df.coalesce(tasks) if tasks else df
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
