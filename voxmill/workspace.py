"""Folders in the storage that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one where a local session has none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again, for tables that several jobs use."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of a batch of texts that Spark hands to Python. Spark's own 64 MB become several times as much
#: there, in each worker of an executor.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have the session hand rows to Python in batches of BATCH_BYTES or its own smaller size."""
    if int(spark.conf.get(BATCH_CONF).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is something at ``path``, in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether anything matches a path with wildcards."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target))


def _store(spark: SparkSession, *paths: str) -> tuple:
    """The store of the first path, and the paths as it knows them."""
    found = [spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths]
    return found[0].getFileSystem(spark._jsc.hadoopConfiguration()), *found


def _renamed(store, source, target) -> None:
    if not store.rename(source, target):
        raise OSError(f"can't rename {source} to {target}")


def replace(spark: SparkSession, new: str, old: str) -> None:
    """Put what is at ``new`` in the place of ``old``.

    The old one is renamed aside, the new one renamed in, and only then the old one deleted. If the
    second step fails, the old one is put back; if the process dies between them, ``recover`` does.
    """
    recover(spark, old)
    store, source, target, aside = _store(spark, new, old, f"{old}.replaced")
    if store.exists(target):
        _renamed(store, target, aside)
    try:
        _renamed(store, source, target)
    except Exception:
        recover(spark, old)
        raise
    store.delete(aside, True)


def recover(spark: SparkSession, path: str) -> None:
    """End what a ``replace`` of ``path`` that broke off has left: the old one comes back if the new one isn't there."""
    store, target, aside = _store(spark, path, f"{path}.replaced")
    if store.exists(aside):
        if store.exists(target):
            store.delete(aside, True)
        else:
            _renamed(store, aside, target)
