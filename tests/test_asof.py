import datetime as dt
import random

from tidemark.operators.asof import asof_join

T0 = dt.datetime(2024, 1, 1)


def ts(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def brute(left, right, tol=None):
    out = []
    for (lk, lt, lv) in left:
        cands = [r for r in right if r[0] is not None and r[0] == lk and r[1] <= lt]
        best = max(cands, key=lambda r: (r[1], r[3])) if cands else None
        if best is not None and tol is not None and best[1] < lt - tol:
            best = None
        out.append((lk, lt, lv, best[2] if best else None))
    return sorted(out, key=repr)


def run(spark, left, right, tol=None, bucket="hour"):
    l = spark.createDataFrame(left, "user string, t timestamp_ntz, lv string")
    r = spark.createDataFrame(right, "user string, t timestamp_ntz, rv string, rid string")
    tol_s = f"{int(tol.total_seconds())} SECONDS" if tol else None
    got = asof_join(l, r, "user", "t", tolerance=tol_s, tiebreak="rid", bucket=bucket)
    return sorted((tuple(x) for x in got.select("user", "t", "lv", "rv").collect()), key=repr)


def test_edge_cases(spark):
    left = [("u", ts(10), "l1"), ("u", ts(0), "l0"), ("v", ts(5), "lv"), (None, ts(5), "ln")]
    right = [("u", ts(10), "equal", "b"), ("u", ts(10), "equal-lower-id", "a"), ("u", ts(3), "before", "c"),
             ("u", ts(11), "after", "d"), (None, ts(1), "null-key", "e")]
    assert run(spark, left, right) == brute(left, right)
    # Equal time matches (inclusive) and the greatest tiebreak wins.
    assert ("u", ts(10), "l1", "equal") in run(spark, left, right)


def test_tolerance(spark):
    left = [("u", ts(600), "late"), ("u", ts(65), "near")]
    right = [("u", ts(0), "old", "a"), ("u", ts(60), "fresh", "b")]
    tol = dt.timedelta(minutes=30)
    assert run(spark, left, right, tol) == brute(left, right, tol)


def test_left_value_wins_on_shared_names_even_null(spark):
    l = spark.createDataFrame([("u", ts(5), None)], "user string, t timestamp_ntz, price double")
    r = spark.createDataFrame([("u", ts(1), 9.0, "x")], "user string, t timestamp_ntz, price double, item string")
    got = asof_join(l, r, "user", "t").collect()[0]
    assert got["price"] is None and got["item"] == "x"
    assert asof_join(l, r, "user", "t").columns == ["user", "t", "price", "item"]


def test_random_against_brute_force_across_buckets(spark):
    rnd = random.Random(7)
    users = ["a", "b", "c", None]
    left = [(rnd.choice(users), ts(rnd.randrange(0, 3000)), f"l{i}") for i in range(300)]
    right = [(rnd.choice(users), ts(rnd.randrange(0, 3000)), f"r{i}", f"{i:04d}") for i in range(300)]
    for bucket in ("minute", "hour", "day"):
        assert run(spark, left, right, bucket=bucket) == brute(left, right)
    tol = dt.timedelta(minutes=90)
    assert run(spark, left, right, tol) == brute(left, right, tol)


def test_plan_shuffles_the_big_side_once(spark):
    import contextlib
    import io
    import re

    left = [("u", ts(i), f"l{i}") for i in range(5)]
    right = [("u", ts(i), f"r{i}", f"{i}") for i in range(5)]
    l = spark.createDataFrame(left, "user string, t timestamp_ntz, lv string")
    r = spark.createDataFrame(right, "user string, t timestamp_ntz, rv string, rid string")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            asof_join(l, r, "user", "t", tiebreak="rid").explain("formatted")
        plan = buf.getvalue()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    by_key_bucket = [e for e in exchanges if "__ao_bucket" in e]
    # Big side once (window), the small summary once (aggregate) and once more
    # to meet the join: never a second shuffle of the windowed rows.
    assert "SortMergeJoin" in plan
    assert len(by_key_bucket) == 3 and len(exchanges) == 4


KINDS = {"view": "user_id string, timestamp timestamp_ntz, event_id string, price double, view_item string",
         "cart": "user_id string, timestamp timestamp_ntz, event_id string, price double, cart_item string",
         "buy": "user_id string, timestamp timestamp_ntz, event_id string, price double, order_id string"}


def _journeys(spark, rows, **options):
    from tidemark.operators.asof import customer_journey
    return customer_journey(*[spark.createDataFrame(rows[k], KINDS[k]) for k in ("view", "cart", "buy")], **options)


def test_journey_in_one_pass_against_brute_force(spark):
    rnd = random.Random(11)
    users = ["a", "b", "c", None]
    rows = {k: [(rnd.choice(users), rnd.choice([None, *[ts(rnd.randrange(0, 3000)) for _ in range(12)]]), f"{i:04d}", float(i), f"{k}{i}") for i in range(200)]
            for k in KINDS}
    rows["buy"] += rows["buy"][:3]

    def last(events, user, at, tol):
        able = [e for e in events if user is not None and at is not None and e[0] == user and e[1] is not None and e[1] <= at]
        best = max(able, key=lambda e: (e[1], e[2]), default=None)
        return best if best and (tol is None or best[1] >= at - tol) else None

    for tol in (None, dt.timedelta(minutes=40)):
        want = []
        for b in rows["buy"]:
            c = last(rows["cart"], b[0], b[1], tol)
            v = last(rows["view"], c[0], c[1], tol) if c else None
            want.append((*b[:4], v and v[4], c and c[4], b[4]))
        for bucket in ("minute", "hour", "month"):
            got = _journeys(spark, rows, bucket=bucket, tolerance=tol and "40 MINUTES")
            assert got.columns == ["user_id", "timestamp", "event_id", "price", "view_item", "cart_item", "order_id"]
            assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_journey_scans_each_input_once(spark, tmp_path):
    import contextlib
    import io
    import re

    from tidemark.operators.asof import customer_journey
    for k, kind in KINDS.items():
        spark.createDataFrame([("u", ts(i), f"{i}", 1.0, "x") for i in range(5)], kind).write.parquet(f"{tmp_path}/{k}")
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in keys.items():
            spark.conf.set(k, v)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            customer_journey(*[spark.read.parquet(f"{tmp_path}/{k}") for k in KINDS]).explain("formatted")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    tree = buf.getvalue().split("\n\n")[0]
    assert len(re.findall(r"Scan parquet", tree)) == 3
    assert len(re.findall(r"\bExchange\b", tree)) == 3 and len(re.findall(r"ReusedExchange", tree)) == 1
