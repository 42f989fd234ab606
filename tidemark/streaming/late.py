"""Late rows as an output.

A stateful operator drops rows behind the watermark without a trace.
``start_late_split`` sits ahead of one and writes every row, marked ``late`` or
not, so that on-time rows go on and late ones can be counted, kept or merged
later. Its mark follows Spark's rule: the greatest time of all earlier
micro-batches less the delay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import path_exists


def start_late_split(stream: DataFrame, time_col: str, delay: str, folder: str, checkpoint: str):
    """Write each row of ``stream`` below ``folder/rows/batch=<id>/late=<true|false>``.

    A row is late if its time is before the mark; rows with a null time are never
    late, and neither is any row of the first batch. One write a batch; the mark
    is then taken from the times written. Folders are named by the batch's id and
    the mark of a batch depends on the one before it only, so a batch that is run
    again gives the same files. ``delay`` is an interval, like ``8 days``. The
    stream must have no column ``late``.
    """
    spark = stream.sparkSession

    def each(batch: DataFrame, batch_id: int) -> None:
        mark = None
        if path_exists(spark, f"{folder}/marks/batch={batch_id - 1}"):
            mark = spark.read.parquet(f"{folder}/marks/batch={batch_id - 1}").first()["mark"]
        bound = F.lit(mark).cast(batch.schema[time_col].dataType) - F.expr(f"INTERVAL {delay}")
        late = F.coalesce(F.col(f"`{time_col}`") < bound, F.lit(False))
        rows = f"{folder}/rows/batch={batch_id}"
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(rows)
        seen = batch.sparkSession.read.schema(batch.schema).parquet(rows)
        top = F.greatest(F.max(f"`{time_col}`"), F.lit(mark).cast(batch.schema[time_col].dataType))
        seen.agg(top.alias("mark")).write.mode("overwrite").parquet(f"{folder}/marks/batch={batch_id}")

    return stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def split_rows(spark, folder: str, schema) -> DataFrame:
    """What ``start_late_split`` has written: the stream's columns and ``late``."""
    late = F.col("late").cast("boolean").alias("late")
    rows = spark.read.option("basePath", f"{folder}/rows").schema(schema).parquet(f"{folder}/rows")
    return rows.select(*[f"`{f.name}`" for f in schema.fields], late)
