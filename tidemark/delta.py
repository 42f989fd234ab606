"""Delta Lake path for the same operations, used where the delta-spark package
is installed (it is not in this environment, so this module is import-guarded
and untested here).

``merge_into_delta`` maps the clause list of ``operators.merge`` onto
``DeltaTable.merge``; Delta then rewrites only the files that hold matched
rows. ``read_delta`` passes time travel through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.errors import DataWriterError
from tidemark.operators import merge as M


def delta_available() -> bool:
    try:
        import delta.tables  # noqa: F401
    except ImportError:
        return False
    return True


def read_delta(spark: SparkSession, path: str, version: int | None = None, timestamp: str | None = None) -> DataFrame:
    r = spark.read.format("delta")
    if version is not None:
        r = r.option("versionAsOf", version)
    if timestamp is not None:
        r = r.option("timestampAsOf", timestamp)
    return r.load(path)


def write_delta(df: DataFrame, path: str, mode: str = "errorifexists", overwrite_schema: bool = False) -> None:
    if mode == "merge":
        raise DataWriterError("mode 'merge' is not a write mode; use merge_into_delta")
    w = df.write.format("delta").mode(mode)
    if overwrite_schema:
        w = w.option("overwriteSchema", "true")
    w.save(path)


def merge_into_delta(spark: SparkSession, path: str, source: DataFrame, clauses, predicate: str,
                     source_alias: str = "source", target_alias: str = "target") -> DataFrame:
    """Run the clauses as a Delta MERGE; returns Delta's operation metrics row."""
    from delta.tables import DeltaTable

    clauses = M.clauses_from_options(clauses)
    builder = (DeltaTable.forPath(spark, path).alias(target_alias)
               .merge(source.alias(source_alias), predicate))
    for c in clauses:
        cond = c.predicate
        if c.method == "when_matched_delete":
            builder = builder.whenMatchedDelete(condition=cond)
        elif c.method == "when_matched_update":
            builder = builder.whenMatchedUpdate(condition=cond, set=c.updates)
        elif c.method == "when_matched_update_all":
            builder = builder.whenMatchedUpdateAll(condition=cond)
        elif c.method == "when_not_matched_insert":
            builder = builder.whenNotMatchedInsert(condition=cond, values=c.updates)
        elif c.method == "when_not_matched_insert_all":
            builder = builder.whenNotMatchedInsertAll(condition=cond)
        elif c.method == "when_not_matched_by_source_update":
            builder = builder.whenNotMatchedBySourceUpdate(condition=cond, set=c.updates)
        elif c.method == "when_not_matched_by_source_delete":
            builder = builder.whenNotMatchedBySourceDelete(condition=cond)
    return builder.execute()
