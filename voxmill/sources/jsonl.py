"""Manifests and ledgers in JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workspace


#: The ledger's name in a folder of downloads.
LEDGER = "ledger.jsonl"


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The records of a manifest; blank and corrupt lines are left out, no file is no rows."""
    if not workspace.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def tail(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """New records as a stream. Every commit must be a new file: Spark reads a file once."""
    reader = spark.readStream.schema(schema).option("mode", "DROPMALFORMED")
    return (reader.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else reader).json(path)


def ledgers(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """The ledger of a folder and of its direct subfolders; relative paths become absolute."""
    root = root.rstrip("/")
    places = [p for p in (f"{root}/{LEDGER}", f"{root}/*/{LEDGER}") if workspace.matches(spark, p)]
    if not places:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(places)
    return rows.withColumn("path", F.when(F.startswith("path", F.lit("/")), F.col("path")).otherwise(F.concat(F.lit(root + "/"), F.col("path"))))
