"""Tables and folders in the storage that driver and executors share.

Writing a table cuts the lineage: what follows starts again from files that outlive any
executor. The folder is the one named by ``spark.checkpoint.dir``. Only a session whose driver
and executors are one process (tests, a laptop) may have none: a temporary folder stands in for
it there, while on a cluster every executor would write to a disk of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The shared folder of this session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing else uses; Spark or a task makes it."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"


#: Bytes of a batch that Spark hands to Python. Spark's own 64 MB fill each executor with
#: buffers that are never given back.
BATCH_BYTES = 4 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession) -> None:
    """Have the session hand texts to Python in batches of BATCH_BYTES or its own smaller size."""
    if int(spark.conf.get(BATCH_CONF).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(BATCH_CONF, f"{BATCH_BYTES}b")


#: Lets Spark delete a write's shuffle files once the table is there. A query that starts while
#: it is set has its files deleted at its own end too, and no execution reads those of another.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Tables to delete at the end of the innermost ``temporary``.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Delete the tables that ``save`` writes inside, at the end, whether it is reached or not."""
    token = _passing.set([])
    try:
        yield
    finally:
        for path in _passing.get():
            _delete(spark, path)
        _passing.reset(token)


def _delete(spark: SparkSession, path: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def save(df: DataFrame, name: str, passing: bool = True) -> DataFrame:
    """Write ``df`` as a table in the shared folder and return what reads it.

    The shuffle files of the write are deleted with its end: nothing reads them any more. Inside
    ``temporary`` the table is deleted with that, unless it isn't ``passing``.
    """
    spark = df.sparkSession
    path, before = new_folder(spark, name), spark.conf.get(CLEANUP)
    if passing and _passing.get() is not None:
        _passing.get().append(path)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete a table that ``save`` wrote and that nothing reads any more."""
    for file in df.inputFiles()[:1]:
        _delete(df.sparkSession, file.rsplit("/", 1)[0])
