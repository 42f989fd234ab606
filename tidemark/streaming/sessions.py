"""Streaming active-session KPI: distinct sessions per event-time window.

``countDistinct`` is not allowed on streams; instead each (window, session)
pair is kept once (``dropDuplicates`` with the watermark bounding its state) and
the pairs are counted per window. In append mode a window is emitted once the
watermark passes its end, exactly once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sessions_per_window(clicks: DataFrame, time_col: str = "event_time", window: str = "1 day",
                        delay: str = "1 day") -> DataFrame:
    w = F.window(time_col, window)
    return (clicks.withWatermark(time_col, delay)
            .select(w.alias("window"), "session_id", time_col)
            .dropDuplicates(["window", "session_id"])
            .groupBy("window").agg(F.count(F.lit(1)).alias("active_sessions")))
