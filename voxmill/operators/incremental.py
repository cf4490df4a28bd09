"""Work that is left, complete files, and first-come deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pending(upstream: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows of ``upstream`` whose key is not in ``done``."""
    return upstream.join(done.select(key).distinct(), key, "left_anti")


def of_pending_files(upstream: DataFrame, done: DataFrame, key: str = "id", file: str = "file_id") -> DataFrame:
    """All rows of every file that has a pending row, so that a file is worked on whole."""
    files = pending(upstream, done, key).select(file).distinct()
    return upstream.join(files, file, "left_semi")


def complete_files(segments: DataFrame) -> DataFrame:
    """file_id and n of files with as many segments as their last row says, or that says none."""
    expected = F.max_by("n_segments", F.struct("seg_index", "id"))
    files = segments.groupBy("file_id").agg(F.count("*").alias("n"), expected.alias("expected"))
    return files.filter(F.col("expected").isNull() | (F.col("n") >= F.col("expected"))).select("file_id", "n", "expected")


def done_by_file(segments: DataFrame) -> DataFrame:
    """file_id, rows done, and the largest speaker number in use (-1 if none)."""
    number = F.nullif(F.regexp_extract("speaker_id", r"_spk(\d+)$", 1), F.lit("")).try_cast("int")
    return segments.groupBy("file_id").agg(F.count("*").alias("n_done"), F.coalesce(F.max(number), F.lit(-1)).alias("max_label"))


def first_by(rows: DataFrame, key: Column, order: list) -> DataFrame:
    """``rows`` with ``key``, ``first_of`` (the order's first row of the key) and ``is_first``.

    The first row is found by an aggregate, which is combined before its shuffle, so a key
    with very many rows is no problem; ``order`` must be unique within a key.
    """
    held = rows.withColumn("key", key).withColumn("_o", F.struct(*order))
    first = held.groupBy("key").agg(F.min("_o").alias("_first"))
    met = held.join(first, "key")
    return met.withColumn("is_first", F.col("_o") == F.col("_first")).drop("_o", "_first")


def unique_in_order(rows: DataFrame, value: str, position: str) -> DataFrame:
    """Each value once, with the first position it had."""
    return rows.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(position).alias(position))


def first_n(rows: DataFrame, group: str, order: list, n: int) -> DataFrame:
    """The first ``n`` rows of each group."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_place", place).filter(F.col("_place") <= n).drop("_place")


def finalised(infos: DataFrame, media: DataFrame, ledger: DataFrame, key: str = "id") -> DataFrame:
    """Downloads to take into the ledger: those whose media is there and that it doesn't have."""
    there = infos.join(media.select(key).distinct(), key, "left_semi")
    return there.join(ledger.select(key).distinct(), key, "left_anti")


def verified(primary: DataFrame, other: DataFrame | None, rate, key: str = "id") -> DataFrame:
    """``primary`` (key, text) with ``text_verify`` and ``cer`` to four places, null without one.

    ``rate`` gives the error rate of two columns. ``other`` (key, text) has one row per key.
    """
    if other is None:
        return primary.withColumns({"text_verify": F.lit(None).cast("string"), "cer": F.lit(None).cast("double")})
    met = primary.join(other.select(key, F.col("text").alias("text_verify")), key, "left")
    return met.withColumn("cer", F.when(F.col("text_verify").isNotNull(), F.round(rate(F.col("text"), F.col("text_verify")), 4)))
