import json

import pytest
from pyspark.sql import functions as F

from tidemark.errors import DataWriterError
from tidemark.folder import compact_folder, merge_folder
from tidemark.operators import merge as M
from tidemark.session import list_files, list_folders, write_new_file
from tidemark.sources.files import file_inventory

UPSERT = M.merge_options(when_matched_update_all=True, when_not_matched_insert_all=True)


def _rows(spark, folder):
    return sorted((tuple(r) for r in spark.read.parquet(folder).select("k", "v", "p").collect()), key=str)


def _table(spark, folder, rows):
    df = spark.createDataFrame(rows, "k int, v string, p string")
    df.write.partitionBy("p").parquet(folder)
    return df.schema


def _files(spark, folder):
    return {r.path: r.modificationTime for r in file_inventory(spark, folder, "*.parquet").collect()}


def test_merge_rewrites_the_partitions_of_the_batch_only(spark, tmp_table):
    folder = tmp_table("folder")
    schema = _table(spark, folder, [(1, "a", "x/1"), (2, "b", "x/1"), (3, "c", "y"), (4, "d", None)])
    before = _files(spark, folder)
    source = spark.createDataFrame([(1, "A", "x/1"), (9, "N", "z"), (4, "D", None)], schema)
    got = merge_folder(spark, folder, source, UPSERT, "p", on=["k", "p"])
    # A null partition matches nothing: its row is inserted beside the one that was there.
    assert _rows(spark, folder) == sorted([(1, "A", "x/1"), (2, "b", "x/1"), (3, "c", "y"), (4, "d", None), (4, "D", None), (9, "N", "z")], key=str)
    assert got["num_source_rows"] == 3 and got["num_target_rows_updated"] == 1 and got["num_target_rows_inserted"] == 2 and got["num_target_rows_copied"] == 2
    same = {f for f in before if "/p=y/" in f}
    assert {f: t for f, t in _files(spark, folder).items() if "/p=y/" in f} == {f: before[f] for f in same}


def test_merge_removes_partitions_left_empty(spark, tmp_table):
    folder = tmp_table("folder")
    schema = _table(spark, folder, [(1, "a", "x 1"), (2, "b", "y"), (3, "c", "y")])
    gone = spark.createDataFrame([(1, "", "x 1"), (2, "", "y")], schema)
    got = merge_folder(spark, folder, gone, M.merge_options(when_matched_delete=True), "p", on=["k", "p"])
    assert _rows(spark, folder) == [(3, "c", "y")]
    assert (got["num_target_rows_deleted"], got["num_partitions_removed"]) == (2, 1)
    assert [f.rsplit("/", 1)[1] for f in list_folders(spark, folder)] == ["p=y"]


def test_by_source_clause_reaches_every_partition(spark, tmp_table):
    folder = tmp_table("folder")
    schema = _table(spark, folder, [(1, "a", "x"), (2, "b", "y")])
    merge_folder(spark, folder, spark.createDataFrame([(1, "A", "x")], schema),
                 M.merge_options(when_matched_update_all=True, when_not_matched_by_source_delete=True), "p", on=["k", "p"])
    assert _rows(spark, folder) == [(1, "A", "x")]


def test_empty_source_repeated_merge_and_refusals(spark, tmp_table):
    folder = tmp_table("folder")
    schema = _table(spark, folder, [(1, "a", "x")])
    merge_folder(spark, folder, spark.createDataFrame([], schema), UPSERT, "p", on=["k", "p"])
    assert _rows(spark, folder) == [(1, "a", "x")]
    batch = spark.createDataFrame([(1, "b", "x"), (2, "c", "x")], schema)
    for _ in range(2):
        merge_folder(spark, folder, batch, UPSERT, "p", on=["k", "p"])
        assert _rows(spark, folder) == [(1, "b", "x"), (2, "c", "x")]
    with pytest.raises(DataWriterError, match="partition column"):
        merge_folder(spark, folder, batch, UPSERT, "p", on=["k"])
    with pytest.raises(DataWriterError, match="more than one source row"):
        merge_folder(spark, folder, batch.union(batch), UPSERT, "p", on=["k", "p"])
    with pytest.raises(DataWriterError, match="no folder"):
        merge_folder(spark, folder + "-none", batch, UPSERT, "p", on=["k", "p"])
    assert _rows(spark, folder) == [(1, "b", "x"), (2, "c", "x")]


def _small_files(spark, folder):
    """Twelve small files in two partitions, one of them named 01, and a large one."""
    rows = spark.range(6000).select(F.col("id").cast("int").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"), F.lit("01").alias("p"))
    for i in range(6):
        part = rows.where(F.col("k") % 6 == i).coalesce(1)
        part.where("k < 1200").unionByName(part.where("k >= 1200 AND k < 1800").withColumn("p", F.lit("b"))).write.mode("append").partitionBy("p").parquet(folder)
    rows.where("k >= 1800").withColumn("p", F.lit("b")).coalesce(1).write.mode("append").partitionBy("p").parquet(folder)
    return rows


def test_compaction_packs_small_files_and_leaves_large_ones(spark, tmp_table):
    folder = tmp_table("compact")
    rows = _small_files(spark, folder)
    sizes = {r.path: r.length for r in file_inventory(spark, folder, "*.parquet").collect()}
    limit = 50_000
    large = {f: t for f, t in _files(spark, folder).items() if sizes[f] >= limit}
    small_of = {d: sum(s for f, s in sizes.items() if s < limit and f"/{d}/" in f) for d in ("p=01", "p=b")}
    assert len(large) == 1 and len(sizes) == 13
    want = sorted(map(tuple, spark.read.parquet(folder).select("k", "v").collect()))
    got = compact_folder(spark, folder, target_bytes=limit, files_at_once=6)
    after = _files(spark, folder)
    for d, total in small_of.items():
        assert sum(f"/{d}/" in f for f in after if f not in large) == -(-total // limit)
    assert {f: after[f] for f in large} == large
    assert (got["num_files_removed"], got["num_rows"]) == (12, 1800)
    assert sorted(map(tuple, spark.read.parquet(folder).select("k", "v").collect())) == want
    assert sorted(f.rsplit("/", 1)[1] for f in list_folders(spark, folder)) == ["p=01", "p=b"]
    assert compact_folder(spark, folder, target_bytes=limit)["num_files_removed"] == 0  # nothing left to do
    assert rows.count() == len(want)


def test_compaction_finishes_a_turn_that_failed(spark, tmp_table):
    folder = tmp_table("compact")
    spark.range(10).coalesce(1).write.parquet(folder)
    spark.range(10, 20).coalesce(1).write.mode("append").parquet(folder)
    old = sorted(_files(spark, folder))
    hidden = f"{folder}/_compacting-x"
    spark.range(20).coalesce(1).write.parquet(hidden)
    new = [f for f in list_files(spark, hidden) if f.endswith(".parquet")]
    # The plan was written, and the run died before its first step.
    write_new_file(spark, f"{folder}/_compaction-x.json", json.dumps({"hidden": hidden, "moves": [[new[0], f"{folder}/n.parquet"]], "old": old}))
    compact_folder(spark, folder)
    assert sorted(r.id for r in spark.read.parquet(folder).collect()) == list(range(20))
    assert [f.rsplit("/", 1)[1] for f in _files(spark, folder)] == ["n.parquet"]
    assert not [f for f in list_files(spark, folder) if "_compaction-" in f]
