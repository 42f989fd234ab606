import pytest
from pyspark.sql import functions as F

from tidemark.errors import DataLoaderError, DataWriterError
from tidemark.operators import merge as M
from tidemark.sinks import files as W
from tidemark.sources import files as R
from tidemark.table import VersionedTable

UPSERT = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)


def frame(spark, lo, hi, tag):
    return spark.range(lo, hi).select(F.col("id").cast("string").alias("k"), F.lit(tag).alias("v"))


def test_write_modes_and_schema(spark, tmp_table):
    t = VersionedTable(spark, tmp_table("modes"))
    t.write(frame(spark, 0, 10, "a"))
    with pytest.raises(DataWriterError):
        t.write(frame(spark, 0, 10, "a"))
    assert t.write(frame(spark, 0, 10, "a"), mode="ignore") is None
    t.write(frame(spark, 10, 20, "b"), mode="append")
    assert t.read().count() == 20
    with pytest.raises(DataWriterError):
        t.write(spark.range(3), mode="append")
    with pytest.raises(DataWriterError):
        t.write(spark.range(3), mode="overwrite")
    with pytest.raises(DataWriterError):
        t.write(spark.range(3), mode="merge")
    t.write(spark.range(3), mode="overwrite", overwrite_schema=True)
    assert t.read().columns == ["id"] and t.read(version=1).count() == 20


def test_merge_stats_like_reference_log(spark, tmp_table):
    t = VersionedTable(spark, tmp_table("stats"))
    t.write(frame(spark, 0, 50, "a"), bucket_by="k", num_buckets=8)
    m = t.merge(frame(spark, 0, 50, "a"), UPSERT, predicate="source.k = target.k")
    assert (m["num_target_rows_updated"], m["num_target_rows_inserted"]) == (50, 0)
    m = t.merge(frame(spark, 50, 100, "b"), UPSERT, predicate="source.k = target.k")
    assert (m["num_target_rows_updated"], m["num_target_rows_inserted"]) == (0, 50)
    m = t.merge(frame(spark, 99, 100, "c"), UPSERT, predicate="source.k = target.k")
    # One key touches one bucket: only that bucket is read and rewritten.
    assert m["num_buckets_read"] == 1 and m["num_target_rows_updated"] == 1
    assert m["num_output_rows"] == m["num_target_rows_inserted"] + m["num_target_rows_updated"] + \
        m["num_target_rows_copied"]
    assert t.read().count() == 100 and t.read().where("v = 'c'").count() == 1
    assert t.read(version=0).count() == 50


def test_time_travel_by_timestamp(spark, tmp_table):
    t = VersionedTable(spark, tmp_table("tt"))
    t.write(frame(spark, 0, 5, "a"))
    ts0 = t.log()[0]["timestamp"]
    t.write(frame(spark, 5, 6, "b"), mode="append")
    assert t.read(timestamp=ts0).count() == 5
    with pytest.raises(DataWriterError):
        t.read(timestamp="2000-01-01T00:00:00")


def test_compaction_keeps_rows_and_cuts_files(spark, tmp_table):
    t = VersionedTable(spark, tmp_table("compact"))
    t.write(frame(spark, 0, 100, "a").repartition(10))
    for i in range(3):
        t.write(frame(spark, 100 * (i + 1), 100 * (i + 2), "b").repartition(10), mode="append")
    before = t.file_sizes().count()
    m = t.compact()
    assert t.read().count() == 400 and m["num_files_added"] < before
    assert t.log()[-1]["data_change"] is False


def test_reader_writer_option_rules(spark, tmp_table):
    df = frame(spark, 0, 3, "a")
    with pytest.raises(FileNotFoundError):
        W.write_csv(df, tmp_table("x") + ".txt")
    with pytest.raises(FileNotFoundError):
        W.write_ndjson(df, tmp_table("x") + ".json")
    with pytest.raises(DataLoaderError):
        R.read_csv(spark, "/nowhere.csv", storage_option={"a": "b"})
    with pytest.raises(DataLoaderError):
        R.latest_path(spark, _empty_dir(spark, tmp_table), "*.csv")


def _empty_dir(spark, tmp_table):
    path = tmp_table("emptydir")
    spark.range(1).write.parquet(path)
    return path


def test_ndjson_writes_nulls(spark, tmp_table):
    path = tmp_table("nulls") + ".ndjson"
    W.write_ndjson(spark.createDataFrame([("a", None)], "k string, v string"), path)
    assert R.read_text(spark, path).first()[0] == '{"k":"a","v":null}'


def test_merge_deletes_and_insert_only_append(spark, tmp_table):
    t = VersionedTable(spark, tmp_table("del"))
    t.write(frame(spark, 0, 20, "a"), bucket_by="k", num_buckets=4)
    m = t.merge(frame(spark, 0, 5, "x"), M.merge_options(when_matched_delete=True), predicate="source.k = target.k")
    assert m["num_target_rows_deleted"] == 5 and t.read().count() == 15
    parts_before = t.log()[-1]["parts"]
    m = t.merge(frame(spark, 15, 30, "n"), M.merge_options(when_not_matched_insert_all=True),
                predicate="source.k = target.k")
    # Insert-only: new folders are appended, none of the earlier ones is replaced.
    parts_after = t.log()[-1]["parts"]
    assert all(set(v) <= set(parts_after[k]) for k, v in parts_before.items())
    assert m["num_target_rows_inserted"] == 10 and m["num_target_rows_copied"] == 0
    assert t.read().count() == 25 and [e["version"] for e in t.log()] == [0, 1, 2]


def test_json_documents_are_bounded_and_one_per_file(spark, tmp_table):
    path = tmp_table("docs") + ".json"
    W.write_json_documents(spark.range(0, 250).repartition(3), path, rows_per_document=40)
    docs = R.read_text(spark, path, whole=True, recursiveFileLookup=True).select(F.col("value")).collect()
    import json
    sizes = [len(json.loads(d["value"])) for d in docs]
    assert sum(sizes) == 250 and max(sizes) <= 40
    assert R.read_json(spark, path, schema="id bigint", recursiveFileLookup=True).count() == 250


def test_merge_counts_no_source_keys_and_still_refuses_double_matches(spark, tmp_table, monkeypatch):
    import pytest
    from tidemark.errors import DataWriterError
    from tidemark.operators import merge as M
    from tidemark.table import VersionedTable

    kind = "k string, v int"
    upsert = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)
    monkeypatch.setattr(M, "source_duplicate_keys", None)  # not called: no pass of its own over the source's keys
    table = VersionedTable(spark, tmp_table("twice"))
    table.write(spark.createDataFrame([], kind), bucket_by="k", num_buckets=2)
    plans = []
    made = M.merge_plan
    monkeypatch.setattr(M, "merge_plan", lambda *a, **kw: plans.append(made(*a, **kw)) or plans[-1])
    # Copies of a key that the table lacks are rows like others; NULL keys too.
    got = table.merge(spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4), (None, 5)], kind), upsert, on=["k"])
    assert got["num_target_rows_inserted"] == got["num_source_rows"] == 5
    assert "Join" not in plans[0].rows()._jdf.queryExecution().optimizedPlan().toString()  # the table was empty
    before = sorted(map(str, table.read().collect()))
    with pytest.raises(DataWriterError):
        table.merge(spark.createDataFrame([("a", 6), ("a", 7)], kind), upsert, on=["k"])
    assert sorted(map(str, table.read().collect())) == before
    got = table.merge(spark.createDataFrame([("b", 8), ("c", 9), (None, 10)], kind), upsert, on=["k"])
    assert (got["num_target_rows_updated"], got["num_target_rows_inserted"]) == (2, 2)
    assert sorted(map(str, (tuple(r) for r in table.read().collect()))) == sorted(map(str, [("a", 1), ("b", 8), ("b", 8), ("c", 9), (None, 4), (None, 5), (None, 10)]))
