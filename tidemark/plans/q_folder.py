"""Plain partitioned folders (M1, M5, M13): merged and compacted without a table format."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.folder import compact_folder, merge_folder
from tidemark.operators import merge as M
from tidemark.plans import entities as E
from tidemark.plans import q_merge as QM
from tidemark.plans.registry import register
from tidemark.session import scratch_dir

_KEY = ["event_id", "event_day"]


def _by_day(df):
    return df.withColumn("event_day", F.to_date("event_timestamp"))


def _merged(spark, sf, name, clauses):
    folder = scratch_dir(spark, name)
    _by_day(QM.target_clicks(spark, sf)).write.partitionBy("event_day").parquet(folder)
    merge_folder(spark, folder, _by_day(QM.source_clicks(spark, sf)), clauses, "event_day", on=_KEY)
    return spark.read.parquet(folder).select(*QM.COLS)


@register("folder_merge", f"""
SELECT {QM._pick("s._s IS NOT NULL")}
FROM {QM.T_SQL} t FULL JOIN {QM.S_SQL} s ON s.event_id = t.event_id""", "M1 M3 M6 K11 upsert into a partitioned folder")
def q_folder_merge(spark, sf):
    return _merged(spark, sf, "folder_merge", M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True))


@register("folder_merge_delete", f"""
SELECT {', '.join(f't.{c}' for c in QM.COLS)} FROM {QM.T_SQL} t ANTI JOIN {QM.S_SQL} s ON s.event_id = t.event_id""",
          "M5 K11 matched rows deleted; days left without rows go")
def q_folder_delete(spark, sf):
    return _merged(spark, sf, "folder_delete", M.merge_options(when_matched_delete=True))


@register("compact_folder", f"SELECT {', '.join(QM.COLS)} FROM ({E.CLICKSTREAM_SQL}) t", "M13 small files of each partition by size")
def q_compact_folder(spark, sf):
    folder = scratch_dir(spark, "compact_folder")
    clicks = _by_day(E.clickstream(spark, sf))
    fifth = F.pmod(F.xxhash64("event_id"), F.lit(5))
    for k in range(5):
        clicks.where(fifth == k).write.mode("append").partitionBy("event_day").parquet(folder)
    compact_folder(spark, folder)
    return spark.read.parquet(folder).select(*QM.COLS)
