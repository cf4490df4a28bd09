"""Media files with their sidecars, found by folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx


def scan(spark: SparkSession, root: str, extensions: tuple[str, ...] = tx.AUDIO_EXTENSIONS) -> DataFrame:
    """path, modificationTime, length and content of audio files below ``root``.

    Columns that are not selected are not read: a listing never opens the files.
    """
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return found.filter(F.lower(F.regexp_extract("path", r"(\.[^./]+)$", 1)).isin(*extensions))


def sidecars(spark: SparkSession, root: str) -> DataFrame:
    """base (path without extension) and source_meta of the JSON files; null if it can't be read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").load(root)
    text = F.decode("content", "UTF-8")
    return found.select(_base("path").alias("base"), F.when(F.try_parse_json(text).isNotNull(), text).alias("source_meta"))


def _base(path: str):
    return F.regexp_replace(path, r"\.[^./]+$", "")


def ingest(spark: SparkSession, root: str, settle_seconds: int | None = None) -> DataFrame:
    """New files: id, hash, source_path, length, source_meta.

    With ``settle_seconds`` a file without a sidecar must have rested that long.
    """
    files = scan(spark, root).select("path", "modificationTime", "length", F.sha1("content").alias("hash"))
    met = files.withColumn("base", _base("path")).join(sidecars(spark, root), "base", "left")
    if settle_seconds is not None:
        rested = F.col("modificationTime") < F.current_timestamp() - F.make_interval(secs=F.lit(settle_seconds))
        met = met.filter(F.col("source_meta").isNotNull() | rested)
    return met.select(F.substring("hash", 1, 12).alias("id"), "hash", F.col("path").alias("source_path"), "length", "source_meta")


def staged_name(source, subdir, path):
    """source__subdir__name, without empty parts."""
    parts = [F.nullif(source, F.lit("")), F.nullif(subdir, F.lit("")), tx.basename(path)]
    return F.concat_ws("__", *parts)


def directory_bytes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"))


