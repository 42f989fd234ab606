"""Plain partitioned Parquet folders: MERGE by partition, and compaction by file size.

A folder is what any engine reads: ``<folder>/<column>=<value>/*.parquet``, with
no log beside it. Both functions write elsewhere first and touch the folder only
once the new files are whole; what they replace is named by Spark's own
partition overwrite or by a small plan file, so that a run that failed can be
run again.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import DataWriterError
from tidemark.operators import merge as M
from tidemark.session import delete_path, list_files, list_folders, move_file, path_exists, read_small_file, scratch_dir, write_new_file
from tidemark.sources.files import file_inventory


def merge_folder(spark: SparkSession, folder: str, source: DataFrame, clauses, partition_by: str, predicate: str | None = None,
                 on: list[str] | None = None, source_alias: str = "source", target_alias: str = "target",
                 on_duplicate: str = "error", latest_by: list[str] | None = None) -> dict:
    """MERGE ``source`` into a folder partitioned by ``partition_by``; returns the statistics.

    Only the partitions that the source has rows of are read and rewritten, all
    of them if a by-source clause is given. For that the partition column has to
    be among the merge's equal columns, or a row could match in a partition that
    is not read. The new partitions are written to the shared scratch folder and
    then overwrite the old ones; one left without rows is removed. A merge that
    failed while it overwrote has replaced some partitions wholly and others not
    at all: run it again with the same source. Source rows with a null in
    ``partition_by`` match nothing and are inserted beside the other such rows.
    An empty source changes nothing unless there are by-source clauses.
    """
    if not path_exists(spark, folder):
        raise DataWriterError(f"no folder at {folder}; write it first")
    clauses = M.clauses_from_options(clauses)
    keys, _, predicate = M.merge_keys(predicate, on, source_alias, target_alias)
    target = spark.read.parquet(folder)
    if (paired := dict(keys).get(partition_by)) is None:
        raise DataWriterError(f"the merge has to hold {partition_by} equal on both sides: it is the folder's partition column")
    work = scratch_dir(spark, "merge_folder")
    # Read more than once below: written first, so that every pass sees the same rows.
    source.write.parquet(f"{work}/source")
    source = spark.read.schema(source.schema).parquet(f"{work}/source")
    kind = target.schema[partition_by].dataType
    # One row a partition of the batch, fewer than the files that the reader lists.
    touched = [r.p for r in source.select(F.col(f"`{paired}`").cast(kind).alias("p")).distinct().collect()]
    if not any(c.method in M._BY_SOURCE for c in clauses):
        some = F.col(partition_by).isin([p for p in touched if p is not None])
        target = target.where(some | F.col(partition_by).isNull() if None in touched else some)
    plan = M.merge_plan(target, source, clauses, predicate=predicate, source_alias=source_alias, target_alias=target_alias,
                        on_duplicate=on_duplicate, latest_by=latest_by)
    rows = plan.rows()
    rows.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(f"{work}/rows")
    written = spark.read.schema(rows.schema).parquet(f"{work}/rows")
    # Counted from the files, so tasks that ran twice count once; partitions x clauses at most.
    counted = written.groupBy(F.col(partition_by).alias("p"), F.col(M.ACTION).alias("a")).count().collect()
    count = lambda kinds: sum(r["count"] for r in counted if r.a in M._codes(plan.clauses, kinds))
    deleted = 0
    if any(c.method in M._DELETES for c in plan.clauses):  # rows that are not written: counted from the plan, before the folder changes
        deleted = plan.tagged.agg(*M.metric_columns(plan.clauses)).first()["num_target_rows_deleted"] or 0
    before = {r.p for r in target.select(F.col(partition_by).alias("p")).distinct().collect()}
    n_source, after = source.count(), {r.p for r in counted}
    if after:
        (written.select(*target.columns).hint("rebalance", partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(partition_by).parquet(folder))
    for gone in sorted(before - after, key=str):
        delete_path(spark, f"{folder.rstrip('/')}/{_partition_path(spark, partition_by, gone, kind)}")
    delete_path(spark, work)
    inserted, updated = count(M._INSERTS), count(M._UPDATES)
    copied = sum(r["count"] for r in counted if r.a == M.COPY)
    return {"num_source_rows": n_source, "num_target_rows_inserted": inserted, "num_target_rows_updated": updated,
            "num_target_rows_deleted": int(deleted), "num_target_rows_copied": copied, "num_output_rows": inserted + updated + copied,
            "num_partitions_written": len(after), "num_partitions_removed": len(before - after)}


def _partition_path(spark: SparkSession, column: str, value, kind: T.DataType) -> str:
    text = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", kind)])).select(F.col("v").cast("string")).first()[0]
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.getPartitionPathString(column, text)


def compact_folder(spark: SparkSession, folder: str, target_bytes: int = 134_217_728, files_at_once: int = 10_000) -> dict:
    """Rewrite the small files of each partition folder as files of about ``target_bytes``.

    A file of ``target_bytes`` or more is left as it is. The others of a
    partition, ``b`` bytes in all, become ``ceil(b / target_bytes)`` files; where
    that is no fewer than there are, they are left as well. Rows are dealt by a
    hash of their file and place, so equal rows and hot keys spread evenly and a
    task that runs again deals them alike. Columns and rows stay the same.

    Partitions are done in turns of about ``files_at_once`` files. A turn writes the
    new files to a hidden folder, counts them against the old ones, notes what
    replaces what in a plan file, moves the new files in and deletes the old
    ones. A turn that failed after its plan was written is finished by the next
    call; before that it has changed nothing. A reader during a turn's moves may
    see rows of both generations, as on any folder without a log.
    """
    folder = folder.rstrip("/")
    for plan in [f for f in list_files(spark, folder) if "/_compaction-" in f]:
        _replace(spark, plan)
    stats = {"num_files_removed": 0, "num_files_added": 0, "num_removed_bytes": 0, "num_rows": 0}
    for turn in _turns(spark, folder, target_bytes, files_at_once):
        hidden = f"{folder}/_compacting-{uuid.uuid4().hex[:12]}"
        old = [path for d in turn for path in d["paths"]]
        # No partition columns here: folders are told apart by number, so their names stay as they are.
        rows = spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*old)
        place = F.regexp_replace(F.regexp_replace("_metadata.file_path", "/[^/]*$", ""), "^file:/+", "file:/")
        numbers = spark.createDataFrame([(i, d["folder"], d["bins"]) for i, d in enumerate(turn)], "_dir int, _place string, _bins int")
        dealt = rows.select("*", place.alias("_place"), F.xxhash64("_metadata.file_name", "_metadata.row_index").alias("_hash"))
        dealt = dealt.join(numbers, "_place").withColumn("_bin", F.pmod("_hash", F.col("_bins").cast("bigint"))).drop("_place", "_bins", "_hash")
        n_new = sum(d["bins"] for d in turn)
        dealt.repartition(n_new, "_dir", "_bin").write.partitionBy("_dir", "_bin").parquet(hidden)
        n_rows = spark.read.parquet(*old).count()
        if (got := spark.read.parquet(hidden).count()) != n_rows:
            raise DataWriterError(f"compaction of {folder} wrote {got} of {n_rows} rows to {hidden}; nothing was replaced")
        moves = [(file, f"{d['folder']}/{uuid.uuid4().hex}.parquet")
                 for i, d in enumerate(turn) for b in list_folders(spark, f"{hidden}/_dir={i}") for file in list_files(spark, b) if file.endswith(".parquet")]
        plan = f"{folder}/_compaction-{uuid.uuid4().hex[:12]}.json"
        write_new_file(spark, plan, json.dumps({"hidden": hidden, "moves": moves, "old": old}))
        _replace(spark, plan)
        stats["num_files_removed"] += len(old)
        stats["num_files_added"] += len(moves)
        stats["num_removed_bytes"] += sum(d["bytes"] for d in turn)
        stats["num_rows"] += n_rows
    return stats


def _turns(spark: SparkSession, folder: str, target_bytes: int, files_at_once: int) -> Iterator[list[dict]]:
    """Partition folders worth compacting, in turns: folder, paths of its small files, their bytes, files to be."""
    small = file_inventory(spark, folder, "*.parquet").where(F.col("length") < target_bytes)
    by_folder = small.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.sort_array(F.collect_list("path")).alias("paths"), F.sum("length").alias("bytes"))
    turn: list[dict] = []
    for r in by_folder.orderBy("folder").collect():  # names of files, which the reader's listing holds as well
        bins = max(1, math.ceil(r.bytes / target_bytes))
        if bins < len(r.paths):
            turn.append({"folder": r.folder, "paths": r.paths, "bytes": r.bytes, "bins": bins})
            if sum(len(d["paths"]) for d in turn) >= files_at_once:
                yield turn
                turn = []
    if turn:
        yield turn


def _replace(spark: SparkSession, plan: str) -> None:
    """Carry out a plan file; steps that were done before are passed over."""
    todo = json.loads(read_small_file(spark, plan))
    for new, place in todo["moves"]:
        if path_exists(spark, new):
            move_file(spark, new, place)
    for old in todo["old"]:
        delete_path(spark, old)
    delete_path(spark, todo["hidden"])
    delete_path(spark, plan)
