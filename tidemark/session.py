"""Session defaults and the shared scratch folder.

Nothing here hides Spark: ``build_session`` is the builder a user would write
(UTC, AQE, UI off, RocksDB state store for the stateful stream), and
``scratch_dir`` resolves the shared folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(master: str = "local[*]", app: str = "tidemark", shuffle_partitions: int = 8,
                  extra: dict | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.streaming.stateStore.providerClass", _ROCKSDB)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Where
    the session names none, a local run gets a temp folder; on a cluster, whose
    executors would each write to a disk of their own, that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    elif not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the checkpoint root for one job's output."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on its file system (local, HDFS or object store)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def write_new_file(spark: SparkSession, path: str, text: str) -> None:
    """Create ``path`` with ``text`` (ASCII); fails if it exists (first writer wins)."""
    p, fs = _fs(spark, path)
    out = fs.create(p, False)
    try:
        out.writeBytes(text)
    finally:
        out.close()


def list_files(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isFile())


def list_folders(spark: SparkSession, folder: str) -> list[str]:
    p, fs = _fs(spark, folder)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().toString() for st in fs.listStatus(p) if st.isDirectory())


def read_small_file(spark: SparkSession, path: str) -> str:
    """A small metadata file's text (for the table log; data never goes this way)."""
    jvm = spark.sparkContext._jvm
    p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all in it; nothing if it is not there."""
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move_file(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file within its file system; fails rather than replace another."""
    p, fs = _fs(spark, path)
    if not fs.rename(p, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be moved to {to}")
