"""MERGE queries (M1-M10, M12, A5, J3-J5).

Target: the bronze clickstream as loaded through 2024-01-19. Source: a later
batch from 2024-01-10 on whose values were corrected (value doubled, type
upper-cased). Together they cover the whole events table; the overlap
(10th-19th) is the matched part.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.plans import entities as E
from tidemark.plans.registry import register

T_CUT = "2024-01-20 00:00:00"
S_CUT = "2024-01-10 00:00:00"
COLS = ["event_id", "user_id", "session_id", "event_type", "event_timestamp", "value"]


def target_clicks(spark, sf):
    c = E.clickstream(spark, sf)
    return c.where(F.col("event_timestamp") < F.lit(T_CUT).cast("timestamp_ntz"))


def source_clicks(spark, sf):
    c = E.clickstream(spark, sf)
    return c.where(F.col("event_timestamp") >= F.lit(S_CUT).cast("timestamp_ntz")).select(
        "event_id", "user_id", "session_id", F.upper("event_type").alias("event_type"),
        "event_timestamp", (F.col("value") * 2).alias("value"))


_C = f"({E.CLICKSTREAM_SQL})"
T_SQL = f"(SELECT *, 1 AS _t FROM {_C} c WHERE event_timestamp < TIMESTAMP '{T_CUT}')"
S_SQL = (f"(SELECT event_id, user_id, session_id, upper(event_type) AS event_type, event_timestamp, "
         f"value * 2 AS value, 1 AS _s FROM {_C} c WHERE event_timestamp >= TIMESTAMP '{S_CUT}')")


def _pick(when_source: str, cols=COLS) -> str:
    return ", ".join(f"CASE WHEN {when_source} THEN s.{c} ELSE t.{c} END AS {c}" for c in cols)


@register("upsert_update_insert_all", f"""
SELECT {_pick("s._s IS NOT NULL")}
FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.event_id = t.event_id""", "M1 M3 M6 J3")
def q_update_insert_all(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


METRICS_SQL = f"""
SELECT (SELECT count(*) FROM {S_SQL} s) AS num_source_rows,
       CAST(count(*) FILTER (WHERE t._t IS NULL) AS BIGINT) AS num_target_rows_inserted,
       CAST(count(*) FILTER (WHERE t._t IS NOT NULL AND s._s IS NOT NULL) AS BIGINT) AS num_target_rows_updated,
       CAST(0 AS BIGINT) AS num_target_rows_deleted,
       CAST(count(*) FILTER (WHERE s._s IS NULL) AS BIGINT) AS num_target_rows_copied,
       CAST(count(*) AS BIGINT) AS num_output_rows
FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.event_id = t.event_id"""


@register("upsert_metrics", METRICS_SQL, "A5")
def q_metrics(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge_plan(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                        predicate="source.event_id = target.event_id").metrics()


@register("upsert_update_expr", f"""
SELECT t.event_id, t.user_id, t.session_id,
       CASE WHEN s._s IS NOT NULL THEN 'updated' ELSE t.event_type END AS event_type,
       t.event_timestamp,
       CASE WHEN s._s IS NOT NULL THEN t.value + s.value ELSE t.value END AS value
FROM {T_SQL} t LEFT JOIN {S_SQL} s ON s.event_id = t.event_id""", "M4")
def q_update_expr(spark, sf):
    opts = M.merge_options(when_matched_update=True, when_matched_update_params={
        "value": "target.value + source.value", "event_type": "'updated'"})
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


@register("upsert_matched_delete", f"""
SELECT {", ".join(f"t.{c}" for c in COLS)} FROM {T_SQL} t ANTI JOIN {S_SQL} s ON s.event_id = t.event_id
UNION ALL
SELECT {", ".join(f"s.{c}" for c in COLS)} FROM {S_SQL} s ANTI JOIN {T_SQL} t ON s.event_id = t.event_id
""", "M5 M6")
def q_matched_delete(spark, sf):
    opts = M.merge_options(when_matched_delete=True, when_not_matched_insert_all=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


@register("upsert_insert_expr", f"""
SELECT {", ".join(COLS)} FROM {T_SQL} t
UNION ALL
SELECT s.event_id, s.user_id, CAST(NULL AS VARCHAR) AS session_id, 'new' AS event_type,
       s.event_timestamp, CAST(NULL AS DOUBLE) AS value
FROM {S_SQL} s ANTI JOIN {T_SQL} t ON s.event_id = t.event_id""", "M7")
def q_insert_expr(spark, sf):
    opts = M.merge_options(when_not_matched_insert=True, when_not_matched_insert_params={
        "event_id": "source.event_id", "user_id": "source.user_id", "event_type": "'new'",
        "event_timestamp": "source.event_timestamp"})
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


@register("upsert_by_source_update", f"""
SELECT t.event_id, t.user_id, t.session_id,
       CASE WHEN s._s IS NULL THEN 'stale' ELSE s.event_type END AS event_type,
       t.event_timestamp,
       CASE WHEN s._s IS NULL THEN t.value ELSE s.value END AS value
FROM {T_SQL} t LEFT JOIN {S_SQL} s ON s.event_id = t.event_id""", "M8 M3")
def q_by_source_update(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_by_source_update=True,
                           when_not_matched_by_source_update_params={"event_type": "'stale'"})
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


@register("upsert_by_source_delete", f"""
SELECT {", ".join(f"s.{c}" for c in COLS)} FROM {S_SQL} s""", "M9 M3 M6")
def q_by_source_delete(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True,
                           when_not_matched_by_source_delete=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id")


# Per-clause conditions, first applicable clause wins within each group.
_ORDER_CLAUSES = [
    M.Clause("when_matched_delete", predicate="source.event_type = 'ERROR'"),
    M.Clause("when_matched_update", predicate="source.value > 40", updates={"value": "-1.0"}),
    M.Clause("when_matched_update_all"),
    M.Clause("when_not_matched_insert", predicate="source.event_type = 'SIGNUP'",
             updates={"event_id": "source.event_id", "event_type": "'first'"}),
    M.Clause("when_not_matched_insert_all", predicate="source.event_type <> 'ERROR'"),
    M.Clause("when_not_matched_by_source_delete", predicate="target.value < 5"),
]


@register("upsert_clause_order", f"""
WITH j AS (SELECT t.*, s.event_id AS s_event_id, s.user_id AS s_user_id, s.session_id AS s_session_id,
                  s.event_type AS s_event_type, s.event_timestamp AS s_event_timestamp, s.value AS s_value, s._s
           FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.event_id = t.event_id)
SELECT event_id, user_id, session_id, event_type, event_timestamp,
       CASE WHEN s_value > 40 THEN -1.0 ELSE value END AS value
FROM j WHERE _t IS NOT NULL AND _s IS NOT NULL AND s_event_type <> 'ERROR' AND s_value > 40
UNION ALL
SELECT s_event_id, s_user_id, s_session_id, s_event_type, s_event_timestamp, s_value
FROM j WHERE _t IS NOT NULL AND _s IS NOT NULL AND s_event_type <> 'ERROR' AND NOT (s_value > 40)
UNION ALL
SELECT s_event_id, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'first', CAST(NULL AS TIMESTAMP), CAST(NULL AS DOUBLE)
FROM j WHERE _t IS NULL AND s_event_type = 'SIGNUP'
UNION ALL
SELECT s_event_id, s_user_id, s_session_id, s_event_type, s_event_timestamp, s_value
FROM j WHERE _t IS NULL AND s_event_type <> 'SIGNUP' AND s_event_type <> 'ERROR'
UNION ALL
SELECT event_id, user_id, session_id, event_type, event_timestamp, value
FROM j WHERE _s IS NULL AND NOT (value < 5)
""", "M10")
def q_clause_order(spark, sf):
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), _ORDER_CLAUSES,
                   predicate="source.event_id = target.event_id")


@register("upsert_composite_key", f"""
SELECT {_pick("s._s IS NOT NULL")}
FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.user_id = t.user_id AND s.event_timestamp = t.event_timestamp""",
          "J4 M1")
def q_composite(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="s.user_id = t.user_id AND s.event_timestamp = t.event_timestamp",
                   source_alias="s", target_alias="t")


def _null_signups(df):
    return df.withColumn("event_id", F.when(F.upper("event_type") == "SIGNUP", F.lit(None))
                         .otherwise(F.col("event_id")))


def _null_sql(rel: str, flag: str) -> str:
    return (f"(SELECT CASE WHEN upper(event_type) = 'SIGNUP' THEN NULL ELSE event_id END AS event_id, "
            f"user_id, session_id, event_type, event_timestamp, value, {flag} FROM {rel} x)")


@register("upsert_null_keys", f"""
SELECT {_pick("s._s IS NOT NULL")}
FROM {_null_sql(T_SQL, "_t")} t FULL JOIN {_null_sql(S_SQL, "_s")} s ON s.event_id = t.event_id""",
          "J3 null keys never match")
def q_null_keys(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(_null_signups(target_clicks(spark, sf)), _null_signups(source_clicks(spark, sf)), opts,
                   predicate="source.event_id = target.event_id")


@register("upsert_theta", f"""
SELECT {_pick("s._s IS NOT NULL")}
FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.event_id = t.event_id AND s.value >= t.value + 5""", "J5")
def q_theta(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts,
                   predicate="source.event_id = target.event_id AND source.value >= target.value + 5")


# Only rows that differ are updated; the rest of the overlap matches nothing, so it comes in beside the old row.
@register("upsert_not_predicate", f"""
SELECT {_pick("s._s IS NOT NULL")}
FROM {T_SQL} t FULL JOIN {S_SQL} s ON s.event_id = t.event_id AND NOT (s.user_id = t.user_id AND s.value < 20)""", "J5 NOT over a conjunction")
def q_not_predicate(spark, sf):
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(target_clicks(spark, sf), source_clicks(spark, sf), opts, on=["event_id"],
                   predicate="NOT (source.user_id = target.user_id AND source.value < 20)")


# lineitem: (l_orderkey, l_linenumber) repeats, the duplicate-key fixture.
L_T_CUT = "1997-01-01 00:00:00"
L_S_CUT = "1995-01-01 00:00:00"
L_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
          "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _lineitem_sides(spark, sf):
    li = E.table(spark, sf, "lineitem")
    t = li.where(F.col("l_shipdate") < F.lit(L_T_CUT).cast("timestamp_ntz"))
    s = li.where(F.col("l_shipdate") >= F.lit(L_S_CUT).cast("timestamp_ntz")).withColumn(
        "l_quantity", F.col("l_quantity") + 1)
    return t, s


_LT = f"(SELECT *, 1 AS _t FROM lineitem WHERE l_shipdate < TIMESTAMP '{L_T_CUT}')"
_LS = (f"(SELECT * REPLACE (l_quantity + 1 AS l_quantity), 1 AS _s FROM lineitem "
       f"WHERE l_shipdate >= TIMESTAMP '{L_S_CUT}')")


@register("upsert_dup_expand", f"""
SELECT {_pick("s._s IS NOT NULL", L_COLS)}
FROM {_LT} t FULL JOIN {_LS} s ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber""",
          "M12 expand")
def q_dup_expand(spark, sf):
    t, s = _lineitem_sides(spark, sf)
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(t, s, opts, on=["l_orderkey", "l_linenumber"], on_duplicate="expand")


_LS_LATEST = f"""(SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC,
         {", ".join(f"{c} DESC" for c in L_COLS)}) AS rn FROM {_LS} x) y WHERE rn = 1)"""


@register("upsert_dup_latest", f"""
SELECT {_pick("s._s IS NOT NULL", L_COLS)}
FROM {_LT} t FULL JOIN {_LS_LATEST} s ON s.l_orderkey = t.l_orderkey AND s.l_linenumber = t.l_linenumber""",
          "M12 latest")
def q_dup_latest(spark, sf):
    t, s = _lineitem_sides(spark, sf)
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    return M.merge(t, s, opts, on=["l_orderkey", "l_linenumber"], on_duplicate="latest",
                   latest_by=["l_shipdate"])
