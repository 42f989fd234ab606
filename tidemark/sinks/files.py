"""File writers: CSV, JSON, NDJSON, Parquet and text.

Spark writes a directory of part files, one per task; the suffix rules of the
reference apply to the directory name. JSON output is line-delimited, or array
documents of bounded size (``write_json_documents``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.errors import DataWriterError


def _suffix(path: str, suffix: str) -> None:
    if not str(path).rstrip("/").endswith(suffix):
        raise FileNotFoundError(f"{path} must end with {suffix}")


def _reject_storage_options(kwargs: dict, what: str) -> None:
    for k in ("storage_option", "storage_options"):
        if k in kwargs:
            raise DataWriterError(f"{k} is not taken by {what}; set credentials on the session")


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    _suffix(path, ".csv")
    _reject_storage_options(options, "write_csv")
    df.write.mode(mode).option("header", True).options(**options).csv(str(path))


def write_json(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    _suffix(path, ".json")
    df.write.mode(mode).option("ignoreNullFields", False).options(**options).json(str(path))


def write_ndjson(df: DataFrame, path: str, mode: str = "errorifexists", **options) -> None:
    """NULL fields are written (``ignoreNullFields=false``)."""
    _suffix(path, ".ndjson")
    df.write.mode(mode).option("ignoreNullFields", False).options(**options).json(str(path))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "snappy",
                  **options) -> None:
    _reject_storage_options(options, "write_parquet")
    df.write.mode(mode).option("compression", compression).options(**options).parquet(str(path))


def write_text(data: DataFrame | Column | str, path: str, mode: str = "overwrite", sep: str = "\n",
               spark=None) -> None:
    """Text lines from a one-string-column DataFrame; ``mode="append"`` adds files."""
    _suffix(path, ".txt")
    if isinstance(data, str):
        if spark is None:
            raise ValueError("a literal string needs the spark session")
        data = spark.createDataFrame([(data,)], "value string")
    data.write.mode(mode).option("lineSep", sep).text(str(path))


def append_text(data: DataFrame, path: str, sep: str = "\n") -> None:
    write_text(data, path, mode="append", sep=sep)


def write_json_documents(df: DataFrame, path: str, mode: str = "errorifexists",
                         rows_per_document: int = 10_000) -> None:
    """JSON array documents of at most ``rows_per_document`` rows each (the
    reference's ``json_to_disk(list)`` layout, split so that no document, task
    or aggregate buffer grows with the table). Read back with ``read_json``.

    The document number comes from ``monotonically_increasing_id`` (partition
    id in the high bits, row index in the low 33), so it needs no window. Each
    document goes to its own file (a JSON-document reader reads one document
    per file); read the folder back with ``recursiveFileLookup``.
    """
    _suffix(path, ".json")
    row_id = F.monotonically_increasing_id()
    doc = F.shiftright(row_id, 33) * F.lit(1 << 20) + F.floor((row_id % F.lit(1 << 33)) / rows_per_document)
    docs = (df.withColumn("__doc", doc)
            .groupBy("__doc").agg(F.to_json(F.collect_list(F.struct(*[F.col(f"`{c}`") for c in df.columns])),
                                            {"ignoreNullFields": "false"}).alias("value")))
    docs.select("__doc", "value").write.mode(mode).partitionBy("__doc").text(str(path))
