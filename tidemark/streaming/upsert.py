"""Stream upsert: one MERGE per micro-batch (``foreachBatch``).

Each micro-batch is first reduced to the newest row per key (``dedupe_latest``,
map-side combined), then merged. With ``newer_only`` the matched update applies
only when the incoming row's order column is not older than the stored one, so
replaying a batch after a failure, or receiving a re-sent event late, leaves
the same table: at-least-once delivery becomes an idempotent result. Without an
order column a key may come once in a batch only; more fail the merge rather
than multiply rows with every replay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import merge as M
from tidemark.operators.fanout import decode, encode
from tidemark.table import VersionedTable


def upsert_batch(table: VersionedTable, batch: DataFrame, key: str, order_by: str | None = None,
                 newer_only: bool = True) -> dict:
    """Merge one micro-batch. The batch is persisted for the merge's few passes
    (bucket list, duplicate check, the merge itself) and released after."""
    batch = batch.persist()
    try:
        return _upsert(table, batch, key, order_by, newer_only)
    finally:
        batch.unpersist()


def _upsert(table: VersionedTable, batch: DataFrame, key: str, order_by: str | None,
            newer_only: bool) -> dict:
    if order_by:
        batch = M.dedupe_latest(batch, [key], [order_by])
    pred = f"source.`{key}` = target.`{key}`"
    update = (M.Clause("when_matched_update_all",
                       predicate=f"source.`{order_by}` >= target.`{order_by}`")
              if (order_by and newer_only) else M.Clause("when_matched_update_all"))
    clauses = [update, M.Clause("when_not_matched_insert_all")]
    return table.merge(batch, clauses, predicate=pred, on_duplicate="error")


def start_envelope_upsert(envelopes: DataFrame, schema, table: VersionedTable, key: str, checkpoint: str, dead_letters: str,
                          order_by: str | None = None, partitions: int | None = None):
    """Upsert a topic's JSON messages; those that cannot be read go to ``dead_letters`` and end nothing.

    Per micro-batch the readable rows are merged, and the text of the others
    (no JSON of ``schema``, a time that is none, no ``key``) is written to a
    Parquet folder named by the batch's id. A batch that is run again
    overwrites its folder and merges the same rows, so both outputs stay the same.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        text = F.col("value").cast("string").alias("__message")  # a message's own fields may be called value
        rows = decode(batch.select("value", text), schema, keep=("__message",), on_malformed="keep")
        bad = F.col("malformed").isNotNull() | F.col(key).isNull()
        rows.where(bad).select(F.col("__message").alias("value")).write.mode("overwrite").parquet(f"{dead_letters}/batch={batch_id}")
        upsert_batch(table, rows.where(~bad).drop("__message", "malformed"), key, order_by)

    w = envelopes.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    from tidemark.streaming.sources import start_with_partitions
    return start_with_partitions(w, envelopes.sparkSession, partitions)


def start_publish(rows: DataFrame, folder: str, key: str, checkpoint: str, partitions: int | None = None):
    """Publish a stream's rows as envelopes (``key``, JSON ``value``) in a folder, the first of two chained queries.

    ``published`` reads it by the file sink's commit log: files of a micro-batch
    that did not commit are not seen, so each row is handed on once however
    often either query is stopped and started again from its checkpoint.
    """
    w = (encode(rows, key=key).writeStream.format("parquet").outputMode("append").option("path", folder)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True))
    from tidemark.streaming.sources import start_with_partitions
    return start_with_partitions(w, rows.sparkSession, partitions)


def published(spark, folder: str, max_files: int | None = None) -> DataFrame:
    """The envelopes of ``start_publish`` as a stream, for a query with a checkpoint of its own."""
    r = spark.readStream.schema("key string, value string")
    return (r if max_files is None else r.option("maxFilesPerTrigger", max_files)).parquet(folder)


def start_upsert_stream(stream: DataFrame, table: VersionedTable, key: str, checkpoint: str,
                        order_by: str | None = None, available_now: bool = True,
                        processing_time: str | None = None, partitions: int | None = None):
    """Start the query; the checkpoint is the consumer position (the group)."""
    def each(batch: DataFrame, batch_id: int) -> None:
        upsert_batch(table, batch, key, order_by)

    w = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    from tidemark.streaming.sources import start_with_partitions
    return start_with_partitions(w, stream.sparkSession, partitions)
