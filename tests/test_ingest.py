import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timestamps import parse_utc
from tidemark.operators import fanout as FO
from tidemark.operators.tail import tail_n
from tidemark.operators.union import supertype, union_diagonal, union_relaxed


def test_supertypes():
    assert supertype(T.NullType(), T.StringType()) == T.StringType()
    assert supertype(T.IntegerType(), T.LongType()) == T.LongType()
    assert supertype(T.IntegerType(), T.DoubleType()) == T.DoubleType()
    assert supertype(T.IntegerType(), T.StringType()) == T.StringType()
    assert supertype(T.TimestampNTZType(), T.TimestampType()) == T.TimestampType()


def test_union_relaxed_and_diagonal(spark):
    a = spark.createDataFrame([(1, None)], "x int, y void")
    b = spark.createDataFrame([("two", "s")], "x string, y string")
    u = union_relaxed(a, b)
    assert [f.dataType for f in u.schema.fields] == [T.StringType(), T.StringType()]
    assert sorted(tuple(r) for r in u.collect()) == [("1", None), ("two", "s")]
    c = spark.createDataFrame([(1.5, "z")], "x double, z string")
    d = union_diagonal(spark.createDataFrame([(1,)], "x int"), c)
    assert d.columns == ["x", "z"] and d.schema["x"].dataType == T.DoubleType()
    assert sorted(tuple(r) for r in d.collect()) == [(1.0, None), (1.5, "z")]
    with pytest.raises(ValueError):
        union_relaxed(a, c)
    with pytest.raises(ValueError):
        union_diagonal()


def test_parse_utc_formats(spark):
    texts = ["2024-01-01T05:30:00+05:30", "2024-01-01T05:30:00+0530", "2024-01-01T00:00:00Z",
             "2024-01-01T00:00:00+00:00", "2024-01-01 00:00:00"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(parse_utc("s")).collect()]
    assert got == [dt.datetime(2024, 1, 1)] * 5


def test_parse_utc_strict_vs_lenient(spark):
    df = spark.createDataFrame([("not a time",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_utc("s", strict=False)).collect()] == [None, None]
    with pytest.raises(Exception):
        df.select(parse_utc("s")).collect()


def test_tail_fewer_than_n_and_ties(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (0, "c")], "t int, id string")
    assert [tuple(r) for r in tail_n(df, 2, ["t", "id"]).collect()] == [(1, "b"), (1, "a")]
    assert tail_n(df, 50, "t").count() == 3


def test_fan_out_members(spark):
    from tidemark import schemas
    view = (("e1", "u1", "p", "P", "C", dt.datetime(2024, 1, 1)))
    cart = ("e2", "u1", "p", "P", 2, 3.0, dt.datetime(2024, 1, 1))
    df = spark.createDataFrame([(view, None, None), (view, cart, None)], schemas.EVENT_BUNDLE)
    msgs = FO.fan_out(df).groupBy("topic").count().collect()
    assert dict((r["topic"], r["count"]) for r in msgs) == {FO.VIEW_TOPIC: 2, FO.CART_TOPIC: 1}


def test_encode_quoted_key_and_nulls(spark):
    df = spark.createDataFrame([("u1", None)], "user_id string, v double")
    row = FO.encode(df, key="user_id", quote_key=True).first()
    assert row["key"] == '"u1"' and row["value"] == '{"user_id":"u1","v":null}'


def test_time_functions_ignore_session_zone(spark):
    from tidemark.functions.timestamps import micros_to_ntz, to_utc_ntz, utc_instant
    key = "spark.sql.session.timeZone"
    old = spark.conf.get(key)
    try:
        for zone in ("America/Los_Angeles", "Asia/Kolkata"):
            spark.conf.set(key, zone)
            df = spark.createDataFrame([("2024-01-01T05:30:00+05:30", "2024-01-01 00:00:00")], "a string, n string")
            row = df.select(parse_utc("a").alias("p"),
                            to_utc_ntz(utc_instant(F.col("n").cast("timestamp_ntz"))).alias("r"),
                            micros_to_ntz(F.lit(0)).alias("e")).first()
            assert row["p"] == dt.datetime(2024, 1, 1) and row["r"] == dt.datetime(2024, 1, 1)
            assert row["e"] == dt.datetime(1970, 1, 1)
    finally:
        spark.conf.set(key, old)


def test_exact_numbers_keep_their_digits(spark):
    from decimal import Decimal
    a = spark.sql("SELECT 12345678901234567.89BD AS x, 9007199254740993L AS n")
    b = spark.sql("SELECT 1234567.891BD AS x, 0.5BD AS n")
    got = union_relaxed(a, b)
    assert {r.x for r in got.collect()} == {Decimal("12345678901234567.890"), Decimal("1234567.891")}
    assert {r.n for r in got.collect()} == {Decimal("9007199254740993.0"), Decimal("0.5")}
    assert supertype(T.DecimalType(38, 0), T.DecimalType(38, 10)) == T.DecimalType(38, 0)
    assert supertype(T.DecimalType(20, 2), T.IntegerType()) == T.DecimalType(20, 2)
    assert supertype(T.DecimalType(20, 2), T.DoubleType()) == T.DoubleType()


def test_drain_returns_what_an_earlier_one_failed_to_return(spark, tmp_path):
    from pyspark.sql import functions as F
    from tidemark.sources.kafka import drain

    for k in range(4):
        spark.range(10 * k, 10 * k + 10).coalesce(1).write.mode("append").parquet(f"{tmp_path}/topic")
    bad = F.udf(lambda x: 1 / 0 if x == 25 else x, "bigint")

    def rows(fail):
        read = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(f"{tmp_path}/topic")
        return read.select((bad("id") if fail else F.col("id")).alias("id"))

    paths = (f"{tmp_path}/sink", f"{tmp_path}/checkpoint")
    import pytest
    with pytest.raises(Exception):
        drain(rows(True), *paths)
    assert sorted(r.id for r in drain(rows(False), *paths).collect()) == list(range(40))
    empty = drain(rows(False), *paths)
    assert empty.columns == ["id"] and empty.count() == 0
    spark.range(100, 105).coalesce(1).write.mode("append").parquet(f"{tmp_path}/topic")
    assert sorted(r.id for r in drain(rows(False), *paths).collect()) == list(range(100, 105))
