"""Streaming queries (M11, ST1-ST8).

Inputs are replays of the events table: either the table file itself as a
file stream, or week-ordered chunks that Spark writes from it (one micro-batch
per file), so that state is handed from batch to batch.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timestamps import to_utc_ntz, utc_instant
from tidemark.operators import fanout as FO
from tidemark.plans import entities as E
from tidemark.plans import q_asof as QA
from tidemark.plans import q_star_kpi as QK
from tidemark.plans.registry import register
from tidemark.session import scratch_dir
from tidemark.streaming import journey as J
from tidemark.streaming import late as LA
from tidemark.streaming import sessions as SS
from tidemark.streaming import sources as SRC
from tidemark.streaming import trailing as TR
from tidemark.streaming import upsert as UP
from tidemark.table import VersionedTable


def _run_to_end(query):
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


@register("stream_upsert", f"""
SELECT event_id, user_id, session_id, event_type, event_timestamp,
       CASE WHEN event_type = 'purchase' THEN value * 10 ELSE value END AS value
FROM ({E.CLICKSTREAM_SQL}) c""", "M11 ST2 ST6 re-sent events, one MERGE per micro-batch")
def q_stream_upsert(spark, sf):
    clicks = E.clickstream(spark, sf)
    week = F.date_trunc("week", F.col("event_timestamp"))
    sent = clicks.withColumn("seq", week)
    # Purchases are delivered again one week later with a corrected value.
    resent = (clicks.where(F.col("event_type") == "purchase")
              .withColumn("value", F.col("value") * 10)
              .withColumn("seq", week + F.expr("INTERVAL 7 DAYS")))
    deliveries = sent.unionByName(resent)
    root = scratch_dir(spark, "stream_upsert")
    # The update is conditional on seq, so arrival order does not matter: one write.
    SRC.stage_chunks(deliveries, f"{root}/in", F.date_format("seq", "yyyyMMdd"))
    table = VersionedTable(spark, f"{root}/table")
    table.write(spark.createDataFrame([], deliveries.schema), bucket_by="event_id", num_buckets=16)
    # The update is conditional on seq, so batches may take several files.
    stream = SRC.chunk_stream(spark, f"{root}/in", deliveries.schema, max_files=8)
    _run_to_end(UP.start_upsert_stream(stream, table, "event_id", f"{root}/ckpt", order_by="seq"))
    return table.read().drop("seq")


def _envelope_upsert(spark, sf):
    """All events as JSON messages, purchases sent again with a corrected value, and messages that cannot be read among them."""
    clicks = E.clickstream(spark, sf).withColumn("seq", F.lit(0))
    sent = clicks.unionByName(clicks.where(F.col("event_type") == "purchase").withColumn("value", F.col("value") * 10).withColumn("seq", F.lit(1)))
    n = F.col("event_id").cast("bigint")
    messages = FO.encode(sent, key="user_id").select("value")
    messages = messages.union(clicks.where(n % 10 == 0).select(F.concat(F.lit("not json "), "event_id")))
    messages = messages.union(clicks.where(n % 25 == 0).select(F.concat(F.lit('{"event_id":"'), "event_id", F.lit('","event_timestamp":"yesterday"}'))))
    messages = messages.union(clicks.where(n % 30 == 0).select(F.concat(F.lit('{"user_id":"'), "event_id", F.lit('"}'))))
    root = scratch_dir(spark, "envelope_upsert")
    messages.repartition(6, F.xxhash64("value")).write.parquet(f"{root}/topic")
    table = VersionedTable(spark, f"{root}/table")
    table.write(spark.createDataFrame([], clicks.schema), bucket_by="event_id", num_buckets=16)
    stream = SRC.chunk_stream(spark, f"{root}/topic", messages.schema, max_files=3)
    _run_to_end(UP.start_envelope_upsert(stream, clicks.schema, table, "event_id", f"{root}/ckpt", f"{root}/dead", order_by="seq"))
    return table.read().drop("seq"), spark.read.schema("value string").parquet(f"{root}/dead").select("value")


@register("stream_envelope_upsert", f"""
SELECT event_id, user_id, session_id, event_type, event_timestamp,
       CASE WHEN event_type = 'purchase' THEN value * 10 ELSE value END AS value
FROM ({E.CLICKSTREAM_SQL}) c""", "S20 M11 topic messages, bad ones among them, upserted")
def q_envelope_upsert(spark, sf):
    return _envelope_upsert(spark, sf)[0]


@register("stream_dead_letters", """
SELECT 'not json ' || event_id AS value FROM events WHERE event_id % 10 = 0
UNION ALL SELECT '{"event_id":"' || event_id || '","event_timestamp":"yesterday"}' FROM events WHERE event_id % 25 = 0
UNION ALL SELECT '{"user_id":"' || event_id || '"}' FROM events WHERE event_id % 30 = 0""", "S20 messages that cannot be read")
def q_dead_letters(spark, sf):
    return _envelope_upsert(spark, sf)[1]


@register("stream_sessions_daily", f"""
WITH c AS ({E.CLICKSTREAM_SQL}),
d AS (SELECT date_trunc('day', event_timestamp) AS window_start, count(DISTINCT session_id) AS active_sessions
      FROM c GROUP BY 1)
SELECT window_start, active_sessions FROM d WHERE window_start IS NOT NULL""",
          "ST8 ST5 every daily window: the end of the input closes the last ones")
def q_stream_sessions(spark, sf):
    root = scratch_dir(spark, "stream_sessions")
    batch = E.table(spark, sf, "events").select("user_id", "ts")
    batch.write.parquet(f"{root}/in")
    # End of the bounded replay: a time past all others closes their windows; its own never closes.
    batch.agg(F.lit(None).cast("bigint").alias("user_id"), (F.max("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts")).write.mode("append").parquet(f"{root}/in")
    events = spark.readStream.schema(batch.schema).parquet(f"{root}/in")
    clicks = events.select(
        F.concat(F.col("user_id").cast("string"), F.lit("-"), F.col("ts").cast("date").cast("string"))
        .alias("session_id"), utc_instant(F.col("ts")).alias("event_time"))
    agg = SS.sessions_per_window(clicks, "event_time", "1 day", "1 day")
    out = agg.select(to_utc_ntz(F.col("window.start")).alias("window_start"), "active_sessions")
    q = (out.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    _run_to_end(q)
    return spark.read.schema(out.schema).parquet(f"{root}/out")


def _tagged(spark, sf):
    ts_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("timestamp"))
    return (J.tag_views(E.product_views(spark, sf), ts_us)
            .unionByName(J.tag_carts(E.carts(spark, sf), ts_us))
            .unionByName(J.tag_purchases(E.purchases(spark, sf), ts_us)))


def _weeks(sent, week):
    """The weeks of the rows in order, the last time among them, and slices of some 20,000 rows for their users: one pass."""
    found = sent.groupBy(week.alias("w")).agg(F.max("ts_us").alias("last"), F.count("*").alias("n")).collect()
    weeks = sorted((r["w"] for r in found), key=lambda w: (w is not None, w))
    last = max((r["last"] for r in found if r["last"] is not None), default=0)
    return weeks, last, max(J.SLICES, sum(r["n"] for r in found) // 20_000)


def _flush(spark, root, last):
    """End of the bounded replay: one row far in the future moves the watermark
    past every real row (its own user is filtered from the output)."""
    flush = spark.createDataFrame([(J.FLUSH_USER, J.VIEW, last + 366 * 86_400_000_000)], "user_id string, side int, ts_us bigint")
    J._tag(flush, J.VIEW, F.col("ts_us")).write.parquet(f"{root}/in/chunk=99999")


def _journey_stream(spark, sf, mode, to_table: bool = False, tolerance_us: int | None = None):
    tagged = _tagged(spark, sf)
    week = F.date_trunc("week", F.timestamp_micros(F.col("ts_us")))
    weeks, last, slices = _weeks(tagged, week)
    root = scratch_dir(spark, f"journey_{mode}")
    # A chunk is a micro-batch whatever its size: as many files as a trigger takes. Chunks are
    # time-ordered, and the 8-day watermark delay covers a week's chunk.
    files = spark.sparkContext.defaultParallelism
    SRC.stage_chunks(tagged, f"{root}/in", week, weeks, key="user_id" if mode == "on_arrival" else None, files=files)
    _flush(spark, root, last)
    stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema, max_files=files)
    rows = J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), mode=mode, tolerance_us=tolerance_us, slices=slices)
    if to_table:
        # The hand-off of the journey topic to the report consumer, as one query:
        # each micro-batch of journeys is merged into the gold table by event_id.
        gold = VersionedTable(spark, f"{root}/gold")
        gold.write(spark.createDataFrame([], J.journey_output(rows).schema), bucket_by="event_id", num_buckets=16)
        out = J.journey_output(rows)
        _run_to_end(UP.start_upsert_stream(out, gold, "event_id", f"{root}/ckpt", order_by="timestamp",
                                           partitions=spark.sparkContext.defaultParallelism))
        return gold.read()
    w = (rows.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True))
    # State partitions: the cluster's parallelism for this replay (a fresh checkpoint).
    _run_to_end(SRC.start_with_partitions(w, spark, spark.sparkContext.defaultParallelism))
    return J.journey_output(spark.read.schema(rows.schema).parquet(f"{root}/out"))


@register("customer_journey_stream", QA.JOURNEY_SQL,
          "ST3 ST1 ST4 stateful as-of over micro-batches (on_watermark)")
def q_journey_stream(spark, sf):
    return _journey_stream(spark, sf, "on_watermark")


@register("customer_journey_on_arrival", QA.JOURNEY_SQL,
          "ST3 emit on arrival: chunks come in time order, so nothing arrives too late")
def q_journey_arrival(spark, sf):
    return _journey_stream(spark, sf, "on_arrival")


@register("customer_journey_stream_grace", QA.GRACE_SQL, "ST4 seven days of grace; state of idle users is cleared")
def q_journey_grace(spark, sf):
    return _journey_stream(spark, sf, "on_watermark", tolerance_us=7 * 86_400_000_000)


@register("customer_journey_gold", QA.JOURNEY_SQL, "ST7 M11 journey stream merged into the gold table per micro-batch")
def q_journey_gold(spark, sf):
    return _journey_stream(spark, sf, "on_watermark", to_table=True)


@register("journey_handoff", QA.JOURNEY_SQL, "ST7 ST2 journey stream -> published envelopes -> second stream -> upsert, both stopped and restarted")
def q_journey_handoff(spark, sf):
    tagged = _tagged(spark, sf)
    week = F.date_trunc("week", F.timestamp_micros(F.col("ts_us")))
    weeks, last, slices = _weeks(tagged, week)
    root = scratch_dir(spark, "journey_handoff")
    half = len(weeks) // 2
    files = spark.sparkContext.defaultParallelism  # of a chunk, and of a micro-batch
    gold = None
    # Each half is a run of both queries, which go on from their checkpoints.
    for first, part in ((0, weeks[:half]), (half, weeks[half:])):
        SRC.stage_chunks(tagged, f"{root}/in", week, part, files=files, first=first)
        if first == half:
            _flush(spark, root, last)
        stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema, max_files=files)
        rows = J.journey_output(J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), slices=slices))
        _run_to_end(UP.start_publish(rows, f"{root}/topic", "user_id", f"{root}/ckpt_publish", partitions=spark.sparkContext.defaultParallelism))
        if gold is None:
            gold = VersionedTable(spark, f"{root}/gold")
            gold.write(spark.createDataFrame([], rows.schema), bucket_by="event_id", num_buckets=16)
        _run_to_end(UP.start_envelope_upsert(UP.published(spark, f"{root}/topic"), rows.schema, gold, "event_id",
                                             f"{root}/ckpt_upsert", f"{root}/dead", order_by="timestamp"))
    return gold.read()


@register("journey_dedup_stream", QA.JOURNEY_SQL, "ST6 three tenths of the events delivered again, dropped within the watermark")
def q_journey_dedup(spark, sf):
    tagged = _tagged(spark, sf)
    week = F.date_trunc("week", F.timestamp_micros(F.col("ts_us")))
    again = F.pmod(F.xxhash64("event_id"), F.lit(10))
    # One tenth comes again in its own week's chunk, two in the next one's.
    sent = tagged.withColumn("sent", week).union(tagged.where(again == 0).withColumn("sent", week))
    sent = sent.union(tagged.where(again.isin(1, 2)).withColumn("sent", week + F.expr("INTERVAL 7 DAYS")))
    weeks, last, slices = _weeks(sent, F.col("sent"))
    root = scratch_dir(spark, "journey_dedup")
    files = spark.sparkContext.defaultParallelism  # of a chunk, and of a micro-batch
    SRC.stage_chunks(sent, f"{root}/in", F.col("sent"), weeks, files=files)
    _flush(spark, root, last)
    stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema, max_files=files)
    rows = J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), dedup=True, slices=slices)
    w = (rows.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True))
    _run_to_end(SRC.start_with_partitions(w, spark, spark.sparkContext.defaultParallelism))
    return J.journey_output(spark.read.schema(rows.schema).parquet(f"{root}/out"))


@register("stream_late_rows", f"""
WITH c AS (SELECT event_id, user_id, event_timestamp FROM ({E.CLICKSTREAM_SQL}) c),
d AS (SELECT *, date_trunc('week', event_timestamp + CASE WHEN CAST(event_id AS BIGINT) % 20 = 0 THEN INTERVAL 21 DAYS ELSE INTERVAL 0 DAYS END) AS sent FROM c),
m AS (SELECT sent, max(event_timestamp) AS top FROM d GROUP BY sent),
w AS (SELECT sent, max(top) OVER (ORDER BY sent ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 8 DAYS AS mark FROM m)
SELECT event_id, user_id, event_timestamp, coalesce(event_timestamp < mark, false) AS late
FROM d LEFT JOIN w ON d.sent = w.sent""", "ST5 rows behind the watermark leave on a side channel; on-time and late rows are all rows")
def q_late_rows(spark, sf):
    clicks = E.clickstream(spark, sf).select("event_id", "user_id", "event_timestamp")
    held = F.col("event_id").cast("bigint") % 20 == 0
    sent = F.date_trunc("week", F.when(held, F.col("event_timestamp") + F.expr("INTERVAL 21 DAYS")).otherwise(F.col("event_timestamp")))
    weeks = sorted((r[0] for r in clicks.select(sent.alias("w")).distinct().collect()), key=lambda w: (w is not None, w))
    root = scratch_dir(spark, "late_rows")
    # A run a week, so that each week's delivery is one micro-batch.
    for i, w in enumerate(weeks):
        SRC.stage_chunks(clicks, f"{root}/in", sent, [w], first=i)
        stream = SRC.chunk_stream(spark, f"{root}/in", clicks.schema, max_files=1_000_000)
        _run_to_end(LA.start_late_split(stream, "event_timestamp", "8 days", f"{root}/out", f"{root}/ckpt"))
    return LA.split_rows(spark, f"{root}/out", clicks.schema)


def _session_minutes(spark, sf):
    """Every event through the stream, in two runs that go on from one checkpoint: the first half of the days, then the rest."""
    root = scratch_dir(spark, "session_minutes")
    clicks = E.clickstream(spark, sf).select("session_id", utc_instant(F.col("event_timestamp")).alias("event_time"))
    times = clicks.agg(F.min("event_time").alias("first"), F.max("event_time").alias("last")).first()
    half = times["first"] + (times["last"] - times["first"]) / 2 if times["first"] else None
    early = F.coalesce(F.col("event_time") < F.lit(half), F.lit(False))
    # End of the bounded replay: a time past all others closes their minutes; its own never closes.
    end = clicks.agg(F.lit(None).cast("string").alias("session_id"), (F.max("event_time") + F.expr("INTERVAL 1 DAY")).alias("event_time"))
    for i, part in enumerate((clicks.where(early), clicks.where(~early).union(end))):
        part.write.parquet(f"{root}/in/chunk={i:05d}")
        stream = SRC.chunk_stream(spark, f"{root}/in", clicks.schema, max_files=1_000_000)
        _run_to_end(TR.start_minutes(stream, f"{root}/minutes", f"{root}/ckpt"))
    return f"{root}/minutes"


@register("stream_active_sessions_15min", QK._sessions_sql("15 MINUTES"), "ST8 T8 minute sets kept up as a stream, exact")
def q_stream_sessions_15min(spark, sf):
    return TR.sessions_exact(spark, _session_minutes(spark, sf), E.EVENTS_AS_OF)


@register("stream_active_sessions_1day", f"SELECT active_sessions, true AS sketch_within_2_percent FROM ({QK._sessions_sql('1 DAY')}) s",
          "ST8 T9 the day from the minute sets, and from merged sketches within 2 %")
def q_stream_sessions_1day(spark, sf):
    folder = _session_minutes(spark, sf)
    exact = TR.sessions_exact(spark, folder, E.EVENTS_AS_OF, "1 DAY").select("active_sessions", F.lit(None).cast("bigint").alias("about"))
    about = TR.sessions_sketched(spark, folder, E.EVENTS_AS_OF, "1 DAY").select(F.lit(None).cast("bigint").alias("active_sessions"), F.col("active_sessions").alias("about"))
    both = exact.union(about).agg(F.max("active_sessions").alias("active_sessions"), F.max("about").alias("about"))
    close = F.abs(F.col("about") - F.col("active_sessions")) <= 0.02 * F.col("active_sessions")
    return both.select("active_sessions", close.alias("sketch_within_2_percent"))
