"""What may be deleted once it has served, and the deletion itself."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx


def batch_files(ingested: DataFrame, staged: DataFrame, raw: DataFrame, segments: DataFrame, work: str) -> DataFrame:
    """category and path of what a batch leaves behind once it went through all stages.

    ``ingested`` (id, source_path) says which files the batch's ``staged`` names (name) became;
    theirs are the wavs of the first two stages under ``work`` and those of their ``segments``
    (file_id, path). ``raw`` (path) are the batch's downloads.
    """
    files = ingested.withColumn("name", tx.basename(F.col("source_path"))).join(staged.select("name").distinct(), "name", "left_semi").select("id")
    stages = F.explode(F.array(*[F.lit(f"{work.rstrip('/')}/{s}/audio/") for s in ("s0_ingest", "s1_separate")])).alias("folder")
    whole = files.select("id", stages).select(F.lit("work").alias("category"), F.concat("folder", F.col("id").cast("string"), F.lit(".wav")).alias("path"))
    cut = segments.join(files.select(F.col("id").alias("file_id")), "file_id", "left_semi").select(F.lit("work").alias("category"), "path")
    return raw.select(F.lit("raw").alias("category"), "path").unionByName(whole).unionByName(cut)


def rejected_files(packaged: DataFrame, root: str, tier: str = "C") -> DataFrame:
    """category and path of the media of a tier that no dataset holds, inside ``root`` only."""
    return packaged.filter((F.col("tier") == tier) & F.startswith("audio_path", F.lit(root.rstrip("/") + "/"))).select(F.lit(f"tier_{tier.lower()}").alias("category"), F.col("audio_path").alias("path"))


def remove(files: DataFrame) -> DataFrame:
    """Delete the files of ``files`` (category, path URIs) on the executors; category and n of those that were there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = []
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(path)
                there = store.get_file_info(name).type == fs.FileType.File
                if there:
                    store.delete_file(name)
                gone.append(int(there))
            yield pa.RecordBatch.from_arrays([batch.column("category"), pa.array(gone, pa.int64())], names=["category", "n"])

    return files.distinct().mapInArrow(run, "category string, n long").groupBy("category").agg(F.sum("n").alias("n"))
