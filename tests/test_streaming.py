import datetime as dt

from pyspark.sql import functions as F

from tidemark.operators.asof import customer_journey
from tidemark.session import scratch_dir
from tidemark.streaming import journey as J
from tidemark.streaming import sources as SRC
from tidemark.streaming import trailing as TR
from tidemark.streaming import upsert as UP
from tidemark.table import VersionedTable

T0 = dt.datetime(2024, 1, 1)


def _events(spark):
    v = spark.createDataFrame([
        ("v1", "u", "p1", "A", "Books", T0), ("v2", "u", "p2", "B", "Home", T0 + dt.timedelta(hours=3)),
        ("v3", "w", "p3", "C", "Home", T0),
    ], "event_id string, user_id string, view_product_id string, view_product_name string, "
       "view_category string, timestamp timestamp_ntz")
    c = spark.createDataFrame([
        ("c1", "u", "p1", "A", 1, 5.0, T0 + dt.timedelta(hours=1)),
        ("c2", "u", "p2", "B", 2, 6.0, T0 + dt.timedelta(days=2)),
    ], "event_id string, user_id string, cart_product_id string, cart_product_name string, "
       "cart_quantity bigint, price double, timestamp timestamp_ntz")
    b = spark.createDataFrame([
        ("b1", "u", "o1", "p1", "A", 1, 7.0, T0 + dt.timedelta(hours=2), 7.0, "upi"),
        ("b2", "u", "o2", "p2", "B", 2, 8.0, T0 + dt.timedelta(days=3), 16.0, "cash"),
        ("b3", "w", "o3", "p3", "C", 1, 9.0, T0 + dt.timedelta(days=1), 9.0, "upi"),
    ], "event_id string, user_id string, order_id string, purchase_product_id string, purchase_product_name string, "
       "purchase_quantity bigint, price double, timestamp timestamp_ntz, total_amount double, payment_method string")
    return v, c, b


def _run_stream(spark, mode):
    v, c, b = _events(spark)
    ts_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("timestamp"))
    tagged = J.tag_views(v, ts_us).unionByName(J.tag_carts(c, ts_us)).unionByName(J.tag_purchases(b, ts_us))
    root = scratch_dir(spark, f"test-journey-{mode}")
    day = F.date_trunc("day", F.timestamp_micros("ts_us"))
    days = sorted(r[0] for r in tagged.select(day.alias("d")).distinct().collect())
    SRC.stage_chunks(tagged.coalesce(1), f"{root}/in", day, days)
    flush = spark.createDataFrame([(J.FLUSH_USER, J.VIEW, 7_258_118_400_000_000)], "user_id string, side int, ts_us bigint")
    J._tag(flush, J.VIEW, F.col("ts_us")).write.parquet(f"{root}/in/chunk=99999")
    stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema)
    rows = J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), mode=mode, delay="1 day")
    q = (rows.writeStream.format("parquet").outputMode("append").option("path", f"{root}/out")
         .option("checkpointLocation", f"{root}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    got = J.journey_output(spark.read.schema(rows.schema).parquet(f"{root}/out"))
    return sorted(tuple(r) for r in got.select("event_id", "cart_product_id", "view_product_id").collect())


def _batch(spark):
    v, c, b = _events(spark)
    j = customer_journey(v, c, b)
    return sorted(tuple(r) for r in j.select("event_id", "cart_product_id", "view_product_id").collect())


def test_stream_journey_equals_batch_over_micro_batches(spark):
    # b1 sees c1 (whose view is v1, not the later v2); b2 sees c2 (view v2); b3 has no cart.
    expected = [("b1", "p1", "p1"), ("b2", "p2", "p2"), ("b3", None, None)]
    assert _batch(spark) == expected
    assert _run_stream(spark, "on_watermark") == expected
    assert _run_stream(spark, "on_arrival") == expected


def test_stream_upsert_is_idempotent_under_replay(spark):
    root = scratch_dir(spark, "test-upsert")
    rows = [("k1", 1, "a"), ("k2", 1, "a"), ("k1", 2, "b")]
    df = spark.createDataFrame(rows, "k string, seq int, v string")
    df.where("seq = 1").coalesce(1).write.parquet(f"{root}/in/chunk=0")
    df.where("seq = 2").coalesce(1).write.parquet(f"{root}/in/chunk=1")
    # A stale re-delivery of k1 arrives last: it must not win.
    spark.createDataFrame([("k1", 1, "stale")], df.schema).write.parquet(f"{root}/in/chunk=2")
    table = VersionedTable(spark, f"{root}/table")
    table.write(spark.createDataFrame([], df.schema), bucket_by="k", num_buckets=4)
    q = UP.start_upsert_stream(SRC.chunk_stream(spark, f"{root}/in", df.schema), table, "k", f"{root}/ck",
                               order_by="seq")
    q.awaitTermination()
    assert sorted(tuple(r) for r in table.read().collect()) == [("k1", 2, "b"), ("k2", 1, "a")]


def test_envelope_upsert_again_changes_nothing(spark, tmp_table):
    from tidemark.streaming import sources as SRC
    from tidemark.streaming import upsert as UP
    from tidemark.table import VersionedTable

    root = tmp_table("envelopes")
    kind = "id string, at timestamp_ntz, n int"
    good = [f'{{"id":"{i}","at":"2024-01-0{i % 9 + 1}T00:00:00Z","n":{i}}}' for i in range(20)]
    bad = ["", "not json", '{"id":"x","at":"soon","n":1}', '{"n":5}', '{"id":"3","n":"many"}']
    for part in (good[:12] + bad[:3], good[8:] + bad[3:]):
        spark.createDataFrame([(m,) for m in part], "value string").coalesce(1).write.mode("append").parquet(f"{root}/topic")
    table = VersionedTable(spark, f"{root}/table")
    table.write(spark.createDataFrame([], kind), bucket_by="id", num_buckets=2)
    seen = []
    for run in range(2):  # the second one starts from an empty checkpoint: everything is delivered again
        stream = SRC.chunk_stream(spark, f"{root}/topic", "value string")
        UP.start_envelope_upsert(stream, kind, table, "id", f"{root}/ckpt{run}", f"{root}/dead", order_by="n").awaitTermination()
        rows = sorted(map(tuple, table.read().collect()))
        seen.append((rows, sorted(r.value for r in spark.read.schema("value string").parquet(f"{root}/dead").select("value").collect())))
    assert seen[0] == seen[1] and len(seen[0][0]) == 20 and seen[0][1] == sorted(bad)


def test_late_split_is_the_same_when_a_batch_runs_again(spark, tmp_table):
    from tidemark.streaming import late as LA

    root = tmp_table("late")
    kind = "id int, at timestamp_ntz"
    schema = spark.createDataFrame([], kind).schema
    batches = [[(1, 10), (2, None), (3, 2)], [(4, 1), (5, 30)], [(6, 19), (7, 20), (8, None), (9, 21)]]
    for i, rows in enumerate(batches):
        df = spark.createDataFrame([(k, T0 + dt.timedelta(days=d) if d is not None else None) for k, d in rows], kind)
        df.coalesce(1).write.parquet(f"{root}/in/chunk={i}")
        LA.start_late_split(SRC.chunk_stream(spark, f"{root}/in", schema), "at", "10 days", f"{root}/out", f"{root}/ckpt").awaitTermination()
    want = {4: False, 6: True}  # marks: none, day 0, day 20
    read = lambda: {r.id: r.late for r in LA.split_rows(spark, f"{root}/out", schema).collect()}
    first = read()
    assert first == {i: want.get(i, False) for i in range(1, 10)}
    # A new checkpoint sends every batch again under the same ids.
    LA.start_late_split(SRC.chunk_stream(spark, f"{root}/in", schema), "at", "10 days", f"{root}/out", f"{root}/ckpt2").awaitTermination()
    assert read() == first


def test_dedup_drops_events_sent_again_and_its_state_empties(spark, tmp_table):
    v, c, b = _events(spark)
    ts_us = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col("timestamp"))
    tagged = J.tag_views(v, ts_us).unionByName(J.tag_carts(c, ts_us)).unionByName(J.tag_purchases(b, ts_us))
    # Without an id, equal rows are one event; rows that differ are not.
    nameless = tagged.where("event_id = 'b1'").withColumn("event_id", F.lit(None).cast("string"))
    tagged = tagged.union(nameless).union(nameless.withColumn("order_id", F.lit("o9")))
    root = tmp_table("dedup")
    for i in range(2):
        tagged.coalesce(1).write.parquet(f"{root}/in/chunk={i}")
    flush = spark.createDataFrame([(J.FLUSH_USER, J.VIEW, 7_258_118_400_000_000)], "user_id string, side int, ts_us bigint")
    J._tag(flush, J.VIEW, F.col("ts_us")).write.parquet(f"{root}/in/chunk=9")
    stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema)
    rows = J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), delay="30 days", dedup=True)
    q = (rows.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    got = J.journey_output(spark.read.schema(rows.schema).parquet(f"{root}/out"))
    want = [("None", "o1", "p1"), ("None", "o9", "p1"), ("b1", "o1", "p1"), ("b2", "o2", "p2"), ("b3", "o3", None)]
    assert sorted((str(r.event_id), r.order_id, r.cart_product_id) for r in got.collect()) == want
    seen = [o.numRowsTotal for o in q.lastProgress.stateOperators if "dedup" in o.operatorName.lower()]
    assert seen == [1]  # only the flush row's own id


def test_handoff_goes_on_after_both_queries_were_stopped(spark, tmp_table):
    root = tmp_table("handoff")
    kind = "event_id string, user_id string, timestamp timestamp_ntz, n double"
    schema = spark.createDataFrame([], kind).schema
    gold = VersionedTable(spark, f"{root}/gold")
    gold.write(spark.createDataFrame([], schema), bucket_by="event_id", num_buckets=2)
    for run in range(3):
        rows = [(str(i), "u", T0 + dt.timedelta(hours=run), float(run)) for i in range(run, run + 3)]
        spark.createDataFrame(rows, kind).coalesce(1).write.parquet(f"{root}/in/chunk={run}")
        UP.start_publish(SRC.chunk_stream(spark, f"{root}/in", schema), f"{root}/topic", "user_id", f"{root}/one").awaitTermination()
        if run != 1:  # the second query misses a run
            UP.start_envelope_upsert(UP.published(spark, f"{root}/topic"), schema, gold, "event_id", f"{root}/two", f"{root}/dead",
                                     order_by="timestamp").awaitTermination()
    assert sorted((r.event_id, r.n) for r in gold.read().collect()) == [("0", 0.0), ("1", 1.0), ("2", 2.0), ("3", 2.0), ("4", 2.0)]
    assert spark.read.parquet(f"{root}/topic").count() == 9


def test_trailing_sessions_from_minutes(spark):
    import random

    r = random.Random(3)
    schema = "session_id string, event_time timestamp"
    at = lambda x: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=x)
    rows = [(r.choice([None, *(f"s{i}" for i in range(4000))]), at(r.randrange(0, 30 * 3600))) for _ in range(9000)]
    rows += [("unseen", None), ("s1", at(100)), ("s1", at(100))]
    root = scratch_dir(spark, "test-trailing")
    early = [x for x in rows if x[1] and x[1] < at(50_000)]
    late = [x for x in rows if x not in early] + [("flush", at(40 * 3600))]
    for i, part in enumerate((early, late)):
        spark.createDataFrame(part, schema).repartition(2).write.parquet(f"{root}/in/chunk={i}")
        q = TR.start_minutes(SRC.chunk_stream(spark, f"{root}/in", "session_id string, event_time timestamp", max_files=100), f"{root}/out", f"{root}/ckpt")
        q.awaitTermination()
        assert q.exception() is None
    ends = [(30 * 3600, "15 MINUTES", 900), (30 * 3600 - 17, "15 MINUTES", 900), (30 * 3600 - 17, "1 DAY", 86_400), (90 * 3600, "15 MINUTES", 900)]
    for end, window, size in ends:
        want = len({s for s, t in rows if t and t >= at(end - size)})
        as_of = str(at(end).replace(tzinfo=None))
        assert TR.sessions_exact(spark, f"{root}/out", as_of, window).first()[0] == want
        assert abs(TR.sessions_sketched(spark, f"{root}/out", as_of, window).first()[0] - want) <= 0.02 * want
    # A figure reads only the days in its range.
    plan = TR.sessions_exact(spark, f"{root}/out", "2024-01-02 06:00:00")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def _brute_journey(rows, tolerance):
    """Purchases by (id, cart payload, view payload), each held against all rows of its user."""
    def latest(side, user, ts):
        near = [r for r in rows if r[1] == side and r[0] == user and r[2] <= ts and (tolerance is None or r[2] >= ts - tolerance)]
        return max(near, key=lambda r: (r[2], r[3])) if near else None

    out = []
    for user, side, ts, name in rows:
        if side == J.PURCHASE:
            cart = latest(J.CART, user, ts)
            view = latest(J.VIEW, user, cart[2]) if cart else None
            out.append((name, cart and cart[3], view and view[3]))
    return sorted(out, key=str)


def test_slices_hold_the_state_of_all_their_users(spark, tmp_table):
    import random

    r = random.Random(5)
    day = 86_400_000_000
    start = 1_704_067_200_000_000
    for mode, tolerance in (("on_watermark", None), ("on_watermark", day), ("on_arrival", None), ("on_arrival", day)):
        # Times repeat within a user and kind; the rows of a user are in every batch or in one.
        rows = [(f"u{r.randrange(400)}", r.randrange(3), start + r.randrange(40) * day // 8, f"e{i:05d}") for i in range(3000)]
        root = tmp_table(f"slices_{mode}_{tolerance}")
        for i in range(5):
            part = [(u, s, t, n, n if s == J.VIEW else None, n if s == J.CART else None) for u, s, t, n in rows if (t - start) // day == i]
            df = spark.createDataFrame(part, "user_id string, side int, ts_us bigint, event_id string, view_product_id string, cart_product_id string")
            tagged = df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(k).alias(c) for c, k in (x.split() for x in J.INPUT_SCHEMA.split(", "))])
            tagged.coalesce(1).write.parquet(f"{root}/in/chunk={i}")
        flush = spark.createDataFrame([(J.FLUSH_USER, J.VIEW, start + 400 * day)], "user_id string, side int, ts_us bigint")
        J._tag(flush, J.VIEW, F.col("ts_us")).coalesce(1).write.parquet(f"{root}/in/chunk=9")
        stream = SRC.chunk_stream(spark, f"{root}/in", tagged.schema)
        out = J.journey_stream(stream.withColumn("event_time", F.timestamp_micros("ts_us")), mode=mode, tolerance_us=tolerance, delay="1 day")
        q = (out.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
             .trigger(availableNow=True).start())
        q.awaitTermination()
        got = spark.read.schema(out.schema).parquet(f"{root}/out").select("event_id", "cart_product_id", "view_product_id").collect()
        assert sorted(map(tuple, got), key=str) == _brute_journey(rows, tolerance)
        held = q.lastProgress.stateOperators[0].numRowsTotal
        # With a tolerance only the flush row's slice is left, else one value per slice, not per user.
        assert held <= (1 if tolerance and mode == "on_watermark" else J.SLICES)


def test_a_chunk_is_at_most_so_many_files(spark, tmp_table):
    root = tmp_table("chunk_files")
    for path in SRC.stage_chunks(spark.range(1000, numPartitions=40), root, F.col("id") % 2, [0, 1], files=4):
        assert spark.read.parquet(path).count() == 500
        assert len(spark.read.parquet(path).inputFiles()) <= 4


def _many_files(spark, root):
    """``events`` of four weeks in 24 files, which Spark reads as more splits than a micro-batch takes files."""
    rows = [(i, T0 + dt.timedelta(hours=i * 5 % 600), i % 30, ("view", "click", "purchase")[i % 7 % 3], float(i), f'{{"k": {i % 9}}}') for i in range(1200)]
    df = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    df.repartition(24).write.parquet(f"{root}/events.parquet")


def _batches(spark, root, monkeypatch, query, checkpoints=("ckpt",)):
    from tidemark.operators.asof import customer_journey
    from tidemark.plans import entities as E
    from tidemark.plans import q_stream as Q

    _many_files(spark, root)
    monkeypatch.setattr(Q, "scratch_dir", lambda spark, name: f"{root}/scratch")
    got = getattr(Q, query)(spark, root)
    want = customer_journey(E.product_views(spark, root), E.carts(spark, root), E.purchases(spark, root))
    both = [sorted(map(tuple, x.select(*want.columns).collect()), key=str) for x in (got, want)]
    assert both[0] == both[1] and len(both[0]) > 100
    from tidemark.session import list_files
    return sum(len([f for f in list_files(spark, f"{root}/scratch/{c}/commits") if f.rsplit("/", 1)[1].isdigit()]) for c in checkpoints)


# Four weeks, the flush row and the batches without rows that close the watermark's steps.
def test_journey_stream_takes_a_batch_a_week(spark, tmp_table, monkeypatch):
    assert _batches(spark, tmp_table("many_stream"), monkeypatch, "q_journey_stream") <= 4 + 1 + 2


def test_journey_dedup_takes_a_batch_a_week(spark, tmp_table, monkeypatch):
    # A fifth week brings what is sent again.
    assert _batches(spark, tmp_table("many_dedup"), monkeypatch, "q_journey_dedup") <= 5 + 1 + 2


def test_journey_handoff_takes_a_batch_a_week(spark, tmp_table, monkeypatch):
    # Each of its two runs closes its watermark's steps.
    assert _batches(spark, tmp_table("many_handoff"), monkeypatch, "q_journey_handoff", ("ckpt_publish",)) <= 4 + 1 + 4
