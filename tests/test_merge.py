import pytest
from pyspark.sql import functions as F

from tidemark.errors import DataWriterError
from tidemark.operators import merge as M

UPSERT = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
PRED = "source.k = target.k"


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)


def test_update_insert_copy(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "N")], "k int, v string")
    out = M.merge(t, s, UPSERT, predicate=PRED)
    # NULL keys never match: both NULL rows survive, the source one inserted.
    assert rows(out, "k", "v") == sorted([(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")], key=repr)


def test_metrics(spark):
    t = spark.createDataFrame([(i, "x") for i in range(10)], "k int, v string")
    s = spark.createDataFrame([(i, "y") for i in range(5, 15)], "k int, v string")
    m = M.merge_plan(t, s, UPSERT, predicate=PRED).metrics().first().asDict()
    assert m == {"num_source_rows": 10, "num_target_rows_inserted": 5, "num_target_rows_updated": 5,
                 "num_target_rows_deleted": 0, "num_target_rows_copied": 5, "num_output_rows": 15}


def test_missing_and_extra_source_columns(spark):
    t = spark.createDataFrame([(1, "a", 1.0)], "k int, v string, w double")
    s = spark.createDataFrame([(1, "A", "x"), (2, "B", "y")], "k int, v string, extra string")
    out = M.merge(t, s, UPSERT, predicate=PRED)
    assert out.columns == ["k", "v", "w"]
    # update_all keeps a column the source lacks; insert_all leaves it NULL.
    assert rows(out) == [(1, "A", 1.0), (2, "B", None)]


def test_empty_sides(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    e = spark.createDataFrame([], "k int, v string")
    assert rows(M.merge(t, e, UPSERT, predicate=PRED)) == [(1, "a")]
    assert rows(M.merge(e, t, UPSERT, predicate=PRED)) == [(1, "a")]


def test_duplicate_source_keys_error_latest_expand(spark):
    t = spark.createDataFrame([(1, "a", 0)], "k int, v string, o int")
    s = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "k int, v string, o int")
    with pytest.raises(DataWriterError):
        M.merge(t, s, UPSERT, predicate=PRED).collect()
    assert rows(M.merge(t, s, UPSERT, predicate=PRED, on_duplicate="latest", latest_by=["o"])) == [(1, "y", 2)]
    assert rows(M.merge(t, s, UPSERT, predicate=PRED, on_duplicate="expand")) == [(1, "x", 1), (1, "y", 2)]


def test_duplicates_only_on_insert_side_are_allowed(spark):
    t = spark.createDataFrame([(1, "a")], "k int, v string")
    s = spark.createDataFrame([(2, "x"), (2, "y")], "k int, v string")
    assert len(rows(M.merge(t, s, UPSERT, predicate=PRED))) == 3


def test_multiplicity_expand_matches_reference_log(spark):
    # 50 rows: 22 keys once, 6 twice, 4 three times, 1 four times. Merged into
    # itself with expand: 98, then 242, then 698 (with 50 extra inserts).
    keys = list(range(22)) + [k for k in range(22, 28) for _ in range(2)] + \
        [k for k in range(28, 32) for _ in range(3)] + [32] * 4
    assert len(keys) == 50
    batch = spark.createDataFrame([(k, "v") for k in keys], "k int, v string")
    table = M.merge(batch, batch, UPSERT, predicate=PRED, on_duplicate="expand")
    assert table.count() == 98
    table = M.merge(table, batch, UPSERT, predicate=PRED, on_duplicate="expand")
    assert table.count() == 242
    fresh = spark.createDataFrame([(1000 + i, "n") for i in range(50)], "k int, v string")
    table = M.merge(table, batch.unionByName(fresh), UPSERT, predicate=PRED, on_duplicate="expand")
    assert table.count() == 698 + 50


def test_clause_order_first_match_wins(spark):
    t = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], "k int, v int")
    s = spark.createDataFrame([(1, 1), (2, 2), (4, 4), (5, 5)], "k int, v int")
    clauses = [
        M.Clause("when_matched_delete", predicate="source.v = 1"),
        M.Clause("when_matched_update", updates={"v": "target.v + 100"}),
        M.Clause("when_matched_update_all"),  # never reached: the clause above takes all
        M.Clause("when_not_matched_insert", predicate="source.v = 4", updates={"k": "source.k", "v": "-4"}),
        M.Clause("when_not_matched_by_source_update", updates={"v": "0"}),
    ]
    assert rows(M.merge(t, s, clauses, predicate=PRED)) == [(2, 120), (3, 0), (4, -4)]


def test_by_source_delete_and_composite_aliases(spark):
    t = spark.createDataFrame([("a", 1.0, "x"), ("a", 2.0, "y"), ("b", 1.0, "z")], "p string, price double, c string")
    s = spark.createDataFrame([("a", 2.0, "Y")], "p string, price double, c string")
    opts = M.merge_options(when_matched_update_all=True, when_not_matched_by_source_delete=True)
    out = M.merge(t, s, opts, predicate="s.p = t.p AND s.price = t.price", source_alias="s", target_alias="t")
    assert rows(out) == [("a", 2.0, "Y")]


def test_theta_predicate(spark):
    t = spark.createDataFrame([(1, 5)], "k int, v int")
    s = spark.createDataFrame([(1, 3), (1, 9)], "k int, v int")
    out = M.merge(t, s, UPSERT, predicate="source.k = target.k AND source.v > target.v")
    assert rows(out) == [(1, 3), (1, 9)]


def test_options_builder_validation():
    with pytest.raises(DataWriterError):
        M.merge_options(when_matched_update=True)
    with pytest.raises(DataWriterError):
        M.merge_options(when_not_matched_insert=True)
    with pytest.raises(DataWriterError):
        M.clauses_from_options({"when_matched_upsert": {}})
    opts = M.merge_options(when_not_matched_insert_all=True, when_matched_delete=True, when_matched_update_all=True)
    assert list(opts) == ["when_matched_delete", "when_matched_update_all", "when_not_matched_insert_all"]


def test_equi_key_extraction():
    assert M.equi_keys("source.a = target.b AND s2 > 1", "source", "target") == ([("b", "a")], False)
    assert M.equi_keys("t.x = s.x AND s.y = t.y", "s", "t") == ([("x", "x"), ("y", "y")], True)
    assert M.equi_keys("s.a = t.a OR s.b = t.b", "s", "t") == ([], False)
    assert M.equi_keys("s.a <=> t.a", "s", "t") == ([], False)


def test_null_keys_are_salted_not_skewed(spark):
    t = spark.createDataFrame([(None, i) for i in range(200)] + [(1, -1)], "k int, v int")
    s = spark.createDataFrame([(None, i) for i in range(200)] + [(1, 1)], "k int, v int")
    out = M.merge(t, s, UPSERT, predicate=PRED)
    assert out.count() == 401
    assert out.where(F.col("k") == 1).first()["v"] == 1


def test_dedupe_latest_keeps_every_null_key_row(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (1, 1), (1, 3)], "k int, o int")
    out = M.dedupe_latest(df, ["k"], ["o"])
    assert rows(out) == sorted([(None, 1), (None, 1), (1, 3)], key=repr)


def test_large_source_meets_the_target_in_one_join(spark, tmp_path):
    import contextlib
    import io
    import random

    from tidemark.operators import merge as M
    r = random.Random(2)
    t = [(r.choice([None, *range(40)]), f"t{i}", i) for i in range(60)]
    s = [(k, f"s{k}", -k) for k in range(20, 70)] + [(None, "null", 0), (None, "null", 1)]
    spark.createDataFrame(t, "k int, v string, n int").write.parquet(f"{tmp_path}/t")
    spark.createDataFrame(s, "k int, v string, n int").write.parquet(f"{tmp_path}/s")
    target, source = spark.read.parquet(f"{tmp_path}/t"), spark.read.parquet(f"{tmp_path}/s")
    options = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    by_key = {x[0]: x for x in s if x[0] is not None}
    want = [by_key.get(x[0], x) for x in t] + [x for x in s if x[0] is None or x[0] not in {y[0] for y in t}]
    keys = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in keys}
    try:
        small = M.merge(target, source, options, on=["k"])
        assert sorted(map(tuple, small.collect()), key=repr) == sorted(want, key=repr)
        for k, v in keys.items():
            spark.conf.set(k, v)
        large = M.merge(target, source, options, on=["k"])
        assert sorted(map(tuple, large.collect()), key=repr) == sorted(want, key=repr)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            large.explain("formatted")
        tree = buf.getvalue().split("\n\n")[0]
        assert tree.count("Scan parquet") == 2 and tree.count("Exchange") == 2 and tree.count("SortMergeJoin") == 1
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
