"""File readers: CSV, JSON document, NDJSON, Parquet, text, and file listings.

Local disk and object stores differ only in the URI (``file:/``, ``abfss://``,
``s3a://``...); credentials live in the session's Hadoop configuration (see
``configure_azure_account``), never in these calls, so a reader that is handed
``storage_option`` refuses it like the reference does. Nothing is downloaded to
a temporary file first: executors read the store directly, which keeps
predicate pushdown and column pruning.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.errors import DataLoaderError


def _reject_storage_options(kwargs: dict, what: str) -> None:
    for k in ("storage_option", "storage_options"):
        if k in kwargs:
            raise DataLoaderError(
                f"{k} is not taken by {what}; set the store's credentials on the session "
                f"(configure_azure_account) and pass its URI")


def configure_azure_account(spark: SparkSession, account: str, key: str | None = None,
                            sas_token: str | None = None) -> None:
    """Bind blob-store credentials once, on the session (hadoop-azure options)."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    host = f"{account}.dfs.core.windows.net"
    if key:
        conf.set(f"fs.azure.account.key.{host}", key)
    if sas_token:
        conf.set(f"fs.azure.sas.fixed.token.{host}", sas_token)
        conf.set(f"fs.azure.account.auth.type.{host}", "SAS")


def _paths(path) -> list[str]:
    return [str(p) for p in path] if isinstance(path, (list, tuple)) else [str(path)]


def read_csv(spark: SparkSession, path, schema: T.StructType | str | None = None, header: bool = True,
             **options) -> DataFrame:
    """CSV with a header row. Types come from ``schema``; without one they are
    inferred (an extra pass over the data: avoid at scale)."""
    _reject_storage_options(options, "read_csv")
    r = spark.read.option("header", header)
    if schema is not None:
        r = r.schema(schema)
    else:
        r = r.option("inferSchema", True)
    return r.options(**options).csv(_paths(path))


def read_json(spark: SparkSession, path, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """One JSON document per file; an array document gives one row per element."""
    _reject_storage_options(options, "read_json")
    r = spark.read.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return r.options(**options).json(_paths(path))


def read_ndjson(spark: SparkSession, path, schema: T.StructType | str | None = None, **options) -> DataFrame:
    """One JSON object per line (splittable: one task per file block)."""
    _reject_storage_options(options, "read_ndjson")
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.options(**options).json(_paths(path))


def read_parquet(spark: SparkSession, path, **options) -> DataFrame:
    """One path or a list of paths."""
    _reject_storage_options(options, "read_parquet")
    return spark.read.options(**options).parquet(*_paths(path))


def read_text(spark: SparkSession, path, whole: bool = False, **options) -> DataFrame:
    """``whole``: one row per file (column ``value``); else one row per line.

    Spark strips the line separator; the reference's line generator kept it.
    """
    _reject_storage_options(options, "read_text")
    return spark.read.options(**options).text(_paths(path), wholetext=whole)


def file_inventory(spark: SparkSession, root: str, pattern: str | None = None,
                   recursive: bool = True) -> DataFrame:
    """``path, modificationTime, length`` of the files under ``root``.

    ``pattern`` is a file-name glob (``*.csv``), or a path glob below ``root``
    (``2024-*/**/x*.csv``; ``**`` stands for any folders). The listing is Spark's own
    (parallel for large trees); the ``content`` column is never selected, so
    files are not read.
    """
    r = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if pattern:
        r = r.option("pathGlobFilter", pattern.rsplit("/", 1)[-1])
    files = r.load(root).select("path", "modificationTime", "length")
    return files.where(F.col("path").rlike(_path_regex(pattern))) if pattern and "/" in pattern else files


def _path_regex(pattern: str) -> str:
    """A glob of folders and a file name as a regular expression on the end of a path."""
    out = ""
    for part in re.split(r"(\*\*/|\*|\?)", pattern):
        out += {"**/": "(?:[^/]+/)*", "*": "[^/]*", "?": "[^/]"}.get(part, re.escape(part))
    return f"/{out}$"


def latest_file(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """The lexicographically greatest path (names embed an ISO timestamp), as a
    1-row DataFrame; empty when nothing matches."""
    inv = file_inventory(spark, root, pattern)
    return inv.agg(F.max("path").alias("path")).where(F.col("path").isNotNull())


def latest_path(spark: SparkSession, root: str, pattern: str | None = None) -> str:
    """``latest_file`` as a string; ``DataLoaderError`` when nothing matches."""
    row = latest_file(spark, root, pattern).first()
    if row is None:
        raise DataLoaderError(f"no file matches {pattern or '*'} under {root}")
    return row["path"]
