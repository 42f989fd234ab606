"""Versioned tables on plain parquet: write modes, time travel, MERGE, compaction.

Use Delta Lake (``format("delta")``) where its package is installed; this is the
layer for when it is not, with the same user-level behaviour the reference
relies on: versions readable by number or time, an overwrite that may replace
the schema, MERGE with statistics, and compaction that keeps the rows.

Layout (every path is on the shared store; nothing is machine-local):

    <table>/_log/<N, 20 digits>.json   the commit of version N (created, never replaced)
    <table>/data/v=<N>/_bucket=<b>/    files written by version N

A commit lists, per bucket, the data folders that make up the table at that
version. Tables are hash-bucketed on a key (``pmod(xxhash64(key), buckets)``):
a MERGE whose predicate pins the key reads and rewrites only the buckets its
source keys fall in, and every other bucket is carried over by reference. An
insert-only MERGE appends and rewrites nothing. Writes use a ``rebalance`` hint
on the bucket column, so AQE splits an oversized (hot-key) bucket over several
tasks instead of one.
"""

from __future__ import annotations

import datetime as _dt
import json
import math
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import DataWriterError
from tidemark.operators import merge as M
from tidemark.session import list_files, path_exists, read_small_file, write_new_file

_BUCKET = "_bucket"
_ALL = "*"


def bucket_of(cols: list[Column], num_buckets: int) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(num_buckets)).cast("int")


def _now() -> str:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).isoformat(timespec="microseconds")


class VersionedTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = str(path).rstrip("/")

    # ---- log -------------------------------------------------------------
    def log(self) -> list[dict]:
        """All commits, oldest first (one small JSON line per version)."""
        files = [f for f in list_files(self.spark, f"{self.path}/_log") if f.endswith(".json")]
        return sorted((json.loads(read_small_file(self.spark, f)) for f in files), key=lambda e: e["version"])

    def exists(self) -> bool:
        return bool(self._log_files())

    def history(self) -> DataFrame:
        """version, timestamp, operation, mode, data_change, metrics (as a map)."""
        rows = [(e["version"], e["timestamp"], e["operation"], e.get("mode"), e.get("data_change", True),
                 {k: int(v) for k, v in e.get("metrics", {}).items()}) for e in self.log()]
        return self.spark.createDataFrame(
            rows, "version bigint, timestamp string, operation string, mode string, data_change boolean, "
                  "metrics map<string,bigint>")

    def _commit(self, entry: dict) -> None:
        # Created with overwrite=false: of two writers racing for a version, one fails.
        write_new_file(self.spark, f"{self.path}/_log/{entry['version']:020d}.json",
                       json.dumps(entry, sort_keys=True))

    def _log_files(self) -> list[str]:
        return [f for f in list_files(self.spark, f"{self.path}/_log") if f.endswith(".json")]

    def _read_entry(self, file: str) -> dict:
        return json.loads(read_small_file(self.spark, file))

    def _entry(self, version: int | None = None, timestamp=None) -> dict:
        """One commit. Every commit lists the whole table (schema and parts), so
        the latest version reads one log file, a version reads its own file, and
        a timestamp is a binary search over versions (commit times increase)."""
        files = self._log_files()
        if not files:
            raise DataWriterError(f"no table at {self.path}; write it first")
        if version is not None:
            name = f"{version:020d}.json"
            match = [f for f in files if f.endswith("/" + name)]
            if not match:
                raise DataWriterError(f"version {version} is not in the log of {self.path}")
            return self._read_entry(match[0])
        if timestamp is not None:
            ts = timestamp if isinstance(timestamp, str) else timestamp.isoformat()
            ts = _dt.datetime.fromisoformat(ts.replace("Z", "")).replace(tzinfo=None)
            lo, hi, best = 0, len(files) - 1, None
            while lo <= hi:
                mid = (lo + hi) // 2
                e = self._read_entry(files[mid])
                if _dt.datetime.fromisoformat(e["timestamp"]) <= ts:
                    best, lo = e, mid + 1
                else:
                    hi = mid - 1
            if best is None:
                raise DataWriterError(f"no version of {self.path} at or before {timestamp}")
            return best
        return self._read_entry(files[-1])

    # ---- read ------------------------------------------------------------
    def schema(self, version: int | None = None) -> T.StructType:
        return T.StructType.fromJson(self._entry(version)["schema"])

    def _read_parts(self, entry: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(entry["schema"])
        parts = entry["parts"]
        keys = parts.keys() if buckets is None else [str(b) for b in buckets if str(b) in parts]
        paths = [f"{self.path}/{d}" for k in keys for d in parts[k]]
        if not paths:
            return self.spark.createDataFrame([], schema).where(F.lit(False))  # known to be empty: a join to it is dropped
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None, timestamp=None) -> DataFrame:
        """The table at its latest version, at ``version``, or as of ``timestamp``."""
        return self._read_parts(self._entry(version, timestamp))

    # ---- write -----------------------------------------------------------
    def _write_data(self, df: DataFrame, version: int, bucket_by: list[str] | None,
                    num_buckets: int | None) -> tuple[dict[str, list[str]], dict[int | None, int]]:
        """Write ``df`` in a folder of its own; return its parts and row counts by action code.

        Each attempt has a new folder, so one that failed half-way is in nobody's
        way. Counts are taken from the files that were written: tasks that Spark
        ran again count once.
        """
        rel = f"data/v={version}-{uuid.uuid4().hex[:12]}"
        path, out = f"{self.path}/{rel}", df
        if bucket_by:
            out = df.withColumn(_BUCKET, bucket_of([F.col(c) for c in bucket_by], num_buckets))
            out.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(path)
        else:
            out.write.parquet(path)
        if not path_exists(self.spark, path):
            return {}, {}
        action = F.col(M.ACTION) if M.ACTION in df.columns else F.lit(None).cast("int")
        written = self.spark.read.schema(out.schema).parquet(path)
        bucket = F.col(_BUCKET) if bucket_by else F.lit(None).cast("int")
        rows = written.groupBy(bucket.alias("b"), action.alias("a")).count().collect()  # buckets x clauses at most
        counts: dict[int | None, int] = {}
        for r in rows:
            counts[r.a] = counts.get(r.a, 0) + r["count"]
        parts = {str(b): [f"{rel}/{_BUCKET}={b}"] for b in sorted({r.b for r in rows})} if bucket_by else {_ALL: [rel]}
        return parts, counts

    def write(self, df: DataFrame, mode: str = "errorifexists", overwrite_schema: bool = False,
              bucket_by: list[str] | str | None = None, num_buckets: int = 64) -> dict | None:
        """Write a version. Modes: errorifexists (default), append, overwrite, ignore.

        ``overwrite`` with a different schema needs ``overwrite_schema=True``;
        ``append`` needs the current schema. Returns the commit.
        """
        if mode == "merge":
            raise DataWriterError("mode 'merge' is not a write mode; use VersionedTable.merge")
        if mode == "error":
            mode = "errorifexists"
        if mode not in ("errorifexists", "append", "overwrite", "ignore"):
            raise DataWriterError(f"unknown write mode {mode!r}")
        if isinstance(bucket_by, str):
            bucket_by = [bucket_by]
        files = self._log_files()
        cur = self._read_entry(files[-1]) if files else None
        if cur is not None:
            if mode == "errorifexists":
                raise DataWriterError(f"table {self.path} already exists")
            if mode == "ignore":
                return None
            same = T.StructType.fromJson(cur["schema"]) == df.schema
            if mode == "append" and not same:
                raise DataWriterError("append needs the table's schema; overwrite with overwrite_schema=True")
            if mode == "overwrite" and not same and not overwrite_schema:
                raise DataWriterError("schema differs; pass overwrite_schema=True to replace it")
            if mode == "append" and bucket_by is not None and (list(bucket_by), num_buckets) != (cur.get("bucket_by"), cur.get("num_buckets")):
                raise DataWriterError("append must keep the table's buckets; overwrite it to change them")
            if bucket_by is None and mode in ("append", "overwrite") and cur.get("bucket_by"):
                if all(c in df.columns for c in cur["bucket_by"]):
                    bucket_by, num_buckets = cur["bucket_by"], cur["num_buckets"]
        version = cur["version"] + 1 if cur else 0
        parts, counts = self._write_data(df, version, bucket_by, num_buckets)
        rows = sum(counts.values())
        if mode == "append" and cur is not None:
            merged = {k: list(v) for k, v in cur["parts"].items()}
            for k, v in parts.items():
                merged.setdefault(k, []).extend(v)
            parts = merged
        entry = {"version": version, "timestamp": _now(), "operation": "WRITE", "mode": mode,
                 "schema": json.loads(df.schema.json()), "bucket_by": bucket_by,
                 "num_buckets": num_buckets if bucket_by else None, "parts": parts,
                 "metrics": {"num_added_rows": rows}, "data_change": True}
        self._commit(entry)
        return entry

    # ---- merge -----------------------------------------------------------
    def merge(self, source: DataFrame, clauses, predicate: str | None = None, on: list[str] | None = None,
              source_alias: str = "source", target_alias: str = "target", on_duplicate: str = "error",
              latest_by: list[str] | None = None) -> dict:
        """MERGE ``source`` into the table and commit the next version.

        Returns the statistics: num_source_rows, num_target_rows_inserted,
        _updated, _deleted, _copied, num_output_rows, plus the buckets read.
        """
        cur = self._entry()
        clauses = M.clauses_from_options(clauses)
        keys, whole, predicate = M.merge_keys(predicate, on, source_alias, target_alias)
        schema = T.StructType.fromJson(cur["schema"])
        bucket_by, nb = cur.get("bucket_by"), cur.get("num_buckets")

        touched: list[int] | None = None
        by_source = any(c.method in M._BY_SOURCE for c in clauses)
        kmap = dict(keys)
        prune = bool(bucket_by) and not by_source and all(b in kmap for b in bucket_by)
        # A target row matched twice is written twice: where no clause deletes, the rows written
        # tell it, and the source's keys need not be counted. Nothing is committed then.
        kinds = {c.method for c in clauses}
        check_after = on_duplicate == "error" and bool(keys) and whole and bool(kinds & M._MATCHED) and not kinds & M._DELETES
        n_source = None
        # Read more than once below: written first, so that every pass sees the same rows.
        staged = f"{self.path}/staged/{uuid.uuid4().hex[:12]}"
        source.write.parquet(staged)
        source = self.spark.read.schema(source.schema).parquet(staged)
        if keys:
            # The source's row count and the buckets its keys hash to (at most num_buckets ints).
            aggs = [F.count(F.lit(1)).alias("rows")]
            if prune:
                bcols = [F.col(f"`{kmap[b]}`").cast(schema[b].dataType) for b in bucket_by]
                aggs.append(F.collect_set(bucket_of(bcols, nb)).alias("buckets"))
            prof = source.agg(*aggs).first()
            n_source = int(prof["rows"])
            if prune:
                touched = sorted(prof["buckets"])

        target = self._read_parts(cur, touched)
        plan = M.merge_plan(target, source, clauses, predicate=predicate,
                            source_alias=source_alias, target_alias=target_alias,
                            on_duplicate=on_duplicate, latest_by=latest_by,
                            source_has_duplicate_keys=False if check_after else None)
        version = cur["version"] + 1
        parts = {k: list(v) for k, v in cur["parts"].items()}
        if plan.only_inserts:
            new_parts, counts = self._write_data(plan.inserted_rows(), version, bucket_by, nb)
            for k, v in new_parts.items():
                parts.setdefault(k, []).extend(v)
        else:
            new_parts, counts = self._write_data(plan.rows(), version, bucket_by, nb)
            replaced = list(parts.keys()) if touched is None else [str(b) for b in touched]
            for k in replaced:
                parts.pop(k, None)
            for k, v in new_parts.items():
                if k in replaced:
                    parts[k] = v
                else:
                    parts.setdefault(k, []).extend(v)
        if check_after:
            held = sum(n for code, n in counts.items() if code not in M._codes(plan.clauses, M._INSERTS))
            if held != (target.count() if cur["parts"] else 0):
                raise DataWriterError(M.MATCHED_TWICE)
        made = lambda kinds: sum(counts.get(i, 0) for i in M._codes(plan.clauses, kinds))
        m = {"num_target_rows_inserted": made(M._INSERTS), "num_target_rows_updated": made(M._UPDATES),
             "num_target_rows_copied": counts.get(M.COPY, 0), "num_target_rows_deleted": 0}
        if any(c.method in M._DELETES for c in plan.clauses):  # rows that are not written: counted from the plan
            m["num_target_rows_deleted"] = plan.tagged.agg(*M.metric_columns(plan.clauses)).first()["num_target_rows_deleted"]
        metrics = {
            "num_source_rows": n_source if n_source is not None else int(source.count()),
            "num_target_rows_inserted": int(m["num_target_rows_inserted"]),
            "num_target_rows_updated": int(m["num_target_rows_updated"]),
            "num_target_rows_deleted": int(m["num_target_rows_deleted"]),
            "num_target_rows_copied": 0 if plan.only_inserts else int(m["num_target_rows_copied"]),
            "num_buckets_read": len(touched) if touched is not None else len(cur["parts"]),
        }
        metrics["num_output_rows"] = (metrics["num_target_rows_inserted"] + metrics["num_target_rows_updated"]
                                      + metrics["num_target_rows_copied"])
        entry = {"version": version, "timestamp": _now(), "operation": "MERGE", "mode": None,
                 "schema": cur["schema"], "bucket_by": bucket_by, "num_buckets": nb, "parts": parts,
                 "predicate": predicate, "metrics": metrics, "data_change": True}
        self._commit(entry)
        return metrics

    # ---- maintenance -----------------------------------------------------
    def file_sizes(self, version: int | None = None) -> DataFrame:
        """path, length of the data files of a version (listing only)."""
        e = self._entry(version)
        paths = [f"{self.path}/{d}" for v in e["parts"].values() for d in v]
        return (self.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                .load(paths).select("path", "length"))

    def compact(self, target_bytes: int = 104_857_600) -> dict:
        """Rewrite the current version into fewer files; rows and schema unchanged.

        Files after: about ceil(total bytes / target_bytes), and at most one
        per bucket unless AQE splits an oversized bucket.
        """
        cur = self._entry()
        sizes = self.file_sizes().agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b")).first()
        n_before, bytes_before = int(sizes["n"]), int(sizes["b"] or 0)
        n_target = max(1, math.ceil(bytes_before / target_bytes))
        df = self._read_parts(cur)
        bucket_by, nb = cur.get("bucket_by"), cur.get("num_buckets")
        if not bucket_by:
            df = df.repartition(n_target)
        version = cur["version"] + 1
        parts, counts = self._write_data(df, version, bucket_by, nb)
        rows = sum(counts.values())
        entry = {"version": version, "timestamp": _now(), "operation": "OPTIMIZE", "mode": None,
                 "schema": cur["schema"], "bucket_by": bucket_by, "num_buckets": nb, "parts": parts,
                 "metrics": {"num_files_removed": n_before, "num_removed_bytes": bytes_before,
                             "num_rows": rows}, "data_change": False}
        self._commit(entry)
        after = self.file_sizes().agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b")).first()
        entry["metrics"].update({"num_files_added": int(after["n"]), "num_added_bytes": int(after["b"] or 0)})
        return entry["metrics"]
