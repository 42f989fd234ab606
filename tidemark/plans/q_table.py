"""Versioned-table queries (S10, K11, K13, M1, M11-like incremental merges, M13).

Each query writes under the session's checkpoint root (the shared folder named
by ``spark.checkpoint.dir``) and returns a read of what was committed.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.plans import entities as E
from tidemark.plans import q_merge as QM
from tidemark.plans.registry import register
from tidemark.session import scratch_dir
from tidemark.table import VersionedTable

_BUCKETS = 16
_UPSERT = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
_ALL_SQL = f"SELECT {', '.join(QM.COLS)} FROM ({E.CLICKSTREAM_SQL}) t"


def _loaded(spark, sf, name, rows=QM.target_clicks):
    """A table of the events before the merges' cut date, or of all of them with ``rows=E.clickstream``."""
    t = VersionedTable(spark, scratch_dir(spark, name))
    t.write(rows(spark, sf), bucket_by="event_id", num_buckets=_BUCKETS)
    return t


@register("table_merge_bucketed", f"""
SELECT {QM._pick("s._s IS NOT NULL")}
FROM {QM.T_SQL} t FULL JOIN {QM.S_SQL} s ON s.event_id = t.event_id""", "M1 M2 K11 bucketed rewrite")
def q_table_merge(spark, sf):
    t = _loaded(spark, sf, "table_merge")
    t.merge(QM.source_clicks(spark, sf), _UPSERT, predicate="source.event_id = target.event_id")
    return t.read()


@register("table_merge_metrics", QM.METRICS_SQL,
          "A5 on a committed merge")
def q_table_metrics(spark, sf):
    t = _loaded(spark, sf, "table_metrics")
    m = t.merge(QM.source_clicks(spark, sf), _UPSERT, predicate="source.event_id = target.event_id")
    cols = ["num_source_rows", "num_target_rows_inserted", "num_target_rows_updated",
            "num_target_rows_deleted", "num_target_rows_copied", "num_output_rows"]
    return t.history().where(F.col("operation") == "MERGE").select(
        *[F.col("metrics")[c].alias(c) for c in cols])


@register("table_time_travel", _ALL_SQL, "S10 version")
def q_time_travel(spark, sf):
    t = _loaded(spark, sf, "table_tt", E.clickstream)
    t.merge(QM.source_clicks(spark, sf), _UPSERT, predicate="source.event_id = target.event_id")
    return t.read(version=0)


@register("table_time_travel_ts", _ALL_SQL, "S10 timestamp")
def q_time_travel_ts(spark, sf):
    t = _loaded(spark, sf, "table_tt_ts", E.clickstream)
    v0_time = t.log()[0]["timestamp"]
    t.merge(QM.source_clicks(spark, sf), _UPSERT, predicate="source.event_id = target.event_id")
    return t.read(timestamp=v0_time)


@register("table_insert_only_append", f"""
SELECT {', '.join(QM.COLS)} FROM {QM.T_SQL} t
UNION ALL
SELECT {', '.join(f's.{c}' for c in QM.COLS)} FROM {QM.S_SQL} s ANTI JOIN {QM.T_SQL} t ON s.event_id = t.event_id
""", "M6 append path")
def q_insert_only(spark, sf):
    t = _loaded(spark, sf, "table_append")
    t.merge(QM.source_clicks(spark, sf), M.merge_options(when_not_matched_insert_all=True),
            predicate="source.event_id = target.event_id")
    return t.read()


@register("table_overwrite_schema", f"""
SELECT event_id, user_id, session_id, event_type, event_timestamp,
       CAST(round(value * 100) AS BIGINT) AS value_cents
FROM ({E.CLICKSTREAM_SQL}) t""", "K13")
def q_overwrite_schema(spark, sf):
    t = _loaded(spark, sf, "table_schema", E.clickstream)
    new = t.read().select("event_id", "user_id", "session_id", "event_type", "event_timestamp",
                          F.round(F.col("value") * 100).cast("bigint").alias("value_cents"))
    # Version 1 is written to its own folder, so reading version 0 while
    # writing it is safe.
    t.write(new, mode="overwrite", overwrite_schema=True)
    return t.read()


@register("compact_table", _ALL_SQL, "M13")
def q_compact(spark, sf):
    path = scratch_dir(spark, "table_compact")
    t = VersionedTable(spark, path)
    clicks = E.clickstream(spark, sf)
    # Five appends that hold all rows: every bucket collects one folder per append.
    fifth = F.pmod(F.xxhash64("event_id"), F.lit(5))
    t.write(clicks.where(fifth == 0), bucket_by="event_id", num_buckets=4)
    for k in range(1, 5):
        t.write(clicks.where(fifth == k), mode="append")
    t.compact(target_bytes=1 << 30)
    return t.read()


@register("table_upsert_idempotent", _ALL_SQL, "M11 idempotence: the same batch merged twice")
def q_idempotent(spark, sf):
    t = VersionedTable(spark, scratch_dir(spark, "table_idem"))
    empty = spark.createDataFrame([], E.clickstream(spark, sf).schema)
    t.write(empty, bucket_by="event_id", num_buckets=_BUCKETS)
    for _ in range(2):
        t.merge(E.clickstream(spark, sf), _UPSERT, predicate="source.event_id = target.event_id")
    return t.read()
