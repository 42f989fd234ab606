"""File streams for bounded replays of table data.

``stage_chunks`` lands a table as time-ordered chunk folders (one write per
chunk, so file modification order follows time), and ``chunk_stream`` reads
them back as a stream, one file per micro-batch. Real deployments read Kafka
(``tidemark.sources.kafka.kafka_stream``) instead; the operators downstream are
the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def stage_chunks(df: DataFrame, root: str, chunk_of: Column, chunks: list | None = None,
                 key: str | None = None, files: int | None = None, first: int = 0) -> list[str]:
    """Write ``df`` rows with ``chunk_of == c`` into ``root/chunk=<i>`` in the order
    of ``chunks``, numbered from ``first``; returns the folders.

    Without ``chunks`` (consumers that do not depend on arrival order) all
    chunks are staged by one partitioned write: one scan of ``df``. With ``files``
    each chunk is that many files at most, however large it is. With ``key`` it
    is ``files`` (8) files and a key's rows are in one of them, so that a
    micro-batch of any files has all of a key's rows of a chunk.
    """
    if chunks is None:
        df.withColumn("chunk", chunk_of).write.partitionBy("chunk").parquet(root)
        return [root]
    out = []
    for i, c in enumerate(chunks, first):
        path = f"{root}/chunk={i:05d}"
        rows = df.where(chunk_of.eqNullSafe(F.lit(c)))
        if key or files:
            rows = rows.repartition(files or 8, *([key] if key else []))
        rows.write.parquet(path)
        out.append(path)
    return out


def chunk_stream(spark: SparkSession, root: str, schema, max_files: int = 1) -> DataFrame:
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
            .option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root))


def start_with_partitions(writer, spark: SparkSession, partitions: int | None):
    """``writer.start()`` with ``partitions`` state/shuffle partitions.

    A stateful query fixes its partition count when its checkpoint is created
    (the session is cloned at start), so the setting is applied for the start
    only and the caller's value restored afterwards.
    """
    if partitions is None:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)
