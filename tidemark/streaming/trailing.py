"""Trailing active sessions kept up by a stream, so that a figure is a look-up and no rescan.

One query reduces events to what later figures need and nothing else: per minute
the set of its sessions, each with its last time in that minute (exact), and per
minute one HLL sketch of that set. Figures merge minutes: short ranges from the
sets, long ones from the sketches, whose size does not depend on the traffic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timestamps import to_utc_ntz
from tidemark.operators.kpi import trailing

_SETS = "minute timestamp_ntz, session_id string, last_seen timestamp_ntz, day date"
_SKETCHES = "minute timestamp_ntz, sketch binary, no_session boolean, day date"


def start_minutes(clicks: DataFrame, folder: str, checkpoint: str, time_col: str = "event_time", delay: str = "1 hour", lg_k: int = 14):
    """Write each closed minute of ``clicks`` (``session_id`` and an instant ``time_col``) below ``folder``.

    ``sets`` has a row a minute and session with the session's last time in that
    minute; a null session is a session like any other. ``sketches`` has a row a
    minute: a sketch of 2^``lg_k`` buckets and whether a null session was among
    them. A minute is closed once the watermark (the greatest time less
    ``delay``) is past its end; all its rows then leave in one batch. Folders
    are named by the batch's id, so a batch that is run again gives the same
    files. Events with a null time count nowhere, as in the KPIs.
    """
    per = (clicks.withWatermark(time_col, delay).groupBy(F.window(time_col, "1 minute").alias("w"), F.col("session_id").cast("string").alias("session_id"))
           .agg(F.max(time_col).alias("seen")))

    def each(batch: DataFrame, batch_id: int) -> None:
        minute = to_utc_ntz(F.col("w.start"))
        sets = batch.select(minute.alias("minute"), "session_id", to_utc_ntz(F.col("seen")).alias("last_seen"), F.to_date(minute).alias("day"))
        path = f"{folder}/sets/batch={batch_id}"
        sets.write.mode("overwrite").partitionBy("day").parquet(path)
        written = batch.sparkSession.read.schema(_SETS).parquet(path)
        sketch = F.hll_sketch_agg("session_id", lg_k).alias("sketch")
        found = written.groupBy("day", "minute").agg(sketch, F.bool_or(F.col("session_id").isNull()).alias("no_session"))
        found.write.mode("overwrite").partitionBy("day").parquet(f"{folder}/sketches/batch={batch_id}")

    return per.writeStream.foreachBatch(each).outputMode("append").option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("basePath", path).schema(schema).parquet(path)


def _since(rows: DataFrame, time_col: str, as_of: str, window: str) -> DataFrame:
    """Rows in range; the day, by which folders are laid out, prunes the rest before it is read."""
    days = F.col("day") >= F.to_date(F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {window}"))
    return trailing(rows.where(days), time_col, as_of, window)


def sessions_exact(spark: SparkSession, folder: str, as_of: str, window: str = "15 MINUTES") -> DataFrame:
    """``active_sessions``: distinct sessions with an event at or after ``as_of - window``, exact for any instant."""
    kept = _since(_read(spark, f"{folder}/sets", _SETS), "last_seen", as_of, window).select("session_id").distinct()
    return kept.agg(F.count(F.lit(1)).alias("active_sessions"))


def sessions_sketched(spark: SparkSession, folder: str, as_of: str, window: str = "1 DAY", lg_k: int = 14) -> DataFrame:
    """``active_sessions`` as an estimate from the sketches of whole minutes in range and the set of the minute the range begins in.

    The standard error is about 1.04 / sqrt(2^``lg_k``), 0.8 % at 14; nothing in range gives 0.
    """
    whole = _since(_read(spark, f"{folder}/sketches", _SKETCHES), "minute", as_of, window).select("sketch", "no_session")
    edge = _since(_read(spark, f"{folder}/sets", _SETS), "last_seen", as_of, window)
    start = F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {window}")
    edge = edge.where(F.col("minute") < start).agg(F.hll_sketch_agg("session_id", lg_k).alias("sketch"), F.bool_or(F.col("session_id").isNull()).alias("no_session"))
    both = whole.union(edge).agg(F.hll_union_agg("sketch").alias("sketch"), F.bool_or("no_session").alias("no_session"))
    null_session = F.coalesce(F.col("no_session"), F.lit(False)).cast("bigint")
    return both.select((F.coalesce(F.hll_sketch_estimate("sketch"), F.lit(0)) + null_session).alias("active_sessions"))
