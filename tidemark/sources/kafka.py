"""Kafka topics as DataFrames (batch drain and stream).

Needs the spark-sql-kafka package on the classpath. The drain reads from the
group's committed position (checkpoint) or the earliest offset, stops at the
offsets present when it starts (``availableNow``), and decodes JSON values with
the given schema; an empty topic yields an empty frame *with* that schema.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark.operators.fanout import decode, encode
from tidemark.session import list_files, list_folders, write_new_file


def kafka_stream(spark: SparkSession, servers: str, topics: str | list[str],
                 starting: str = "earliest", options: dict | None = None) -> DataFrame:
    """The raw envelope stream: key, value, topic, partition, offset, timestamp."""
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", subscribe).option("startingOffsets", starting))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def kafka_batch(spark: SparkSession, servers: str, topics: str | list[str],
                options: dict | None = None) -> DataFrame:
    """Everything currently in the topics, as a batch DataFrame."""
    subscribe = topics if isinstance(topics, str) else ",".join(topics)
    r = (spark.read.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", subscribe).option("startingOffsets", "earliest")
         .option("endingOffsets", "latest"))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    return r.load()


def drain_topic(spark: SparkSession, servers: str, topic: str, schema: T.StructType, sink_path: str,
                checkpoint: str, options: dict | None = None) -> DataFrame:
    """What came to ``topic`` since the last drain that ended well; see ``drain``."""
    env = kafka_stream(spark, servers, topic, options=options)
    return drain(decode(env, schema, keep=("key", "timestamp")), sink_path, checkpoint)


def drain(rows: DataFrame, sink_path: str, checkpoint: str) -> DataFrame:
    """Run the stream ``rows`` to its present end and return what no drain has returned yet.

    The checkpoint is the consumer group: ``sink_path`` belongs to it alone. Each
    micro-batch lands in a Parquet folder named by its id in the checkpoint, so
    one that is run again overwrites itself. A marker file says up to which batch
    rows were returned, and is written only after the stream has ended well. A
    drain that fails in a later batch therefore loses nothing: the next one
    returns the earlier batches too. Nothing new gives an empty frame with the schema.
    """
    spark, here = rows.sparkSession, sink_path.rstrip("/")

    def land(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{here}/batch={batch_id}")

    # foreachBatch rather than a file sink, whose log would tie the folder to the checkpoint.
    q = rows.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    done = max([-1, *(int(name.rsplit("=", 1)[1]) for name in list_files(spark, f"{here}/_returned"))])
    new = sorted(n for n in (int(f.rsplit("=", 1)[1]) for f in list_folders(spark, here) if "/batch=" in f) if n > done)
    if not new:
        return spark.createDataFrame([], rows.schema)
    write_new_file(spark, f"{here}/_returned/upto={new[-1]}", "")
    return spark.read.schema(rows.schema).parquet(*[f"{here}/batch={n}" for n in new]).select(*rows.columns)


def write_kafka_stream(rows: DataFrame, servers: str, topic: str, checkpoint: str, key: str | None = None,
                       options: dict | None = None):
    """Start a stream that publishes ``rows`` to ``topic`` as JSON, keyed by ``key`` (needs a broker)."""
    w = (encode(rows, key=key).writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("topic", topic).option("checkpointLocation", checkpoint))
    for k, v in (options or {}).items():
        w = w.option(k, v)
    return w.start()


def write_kafka(envelope: DataFrame, servers: str, topic: str | None = None,
                options: dict | None = None) -> None:
    """Publish ``key, value[, topic]`` rows (see ``operators.fanout.encode``);
    without ``topic`` each row's ``topic`` column routes it."""
    w = envelope.write.format("kafka").option("kafka.bootstrap.servers", servers)
    if topic:
        w = w.option("topic", topic)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    w.save()
