"""Media out of parquet rows: columns found by their shape, names made safe, files written."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workspace
from ..functions import text as tx
from ..sources import tail

# Names of transcript columns in the order of preference, and the first bytes of
# audio formats.
TEXT_COLUMNS = ("text", "transcription", "transcript", "sentence", "caption")
FIRST_BYTES = (("52494646", ".wav"), ("664C6143", ".flac"), ("4F676753", ".ogg"), ("494433", ".mp3"), ("FFFB", ".mp3"), ("FFF3", ".mp3"), ("FFF2", ".mp3"))


def audio_column(schema: T.StructType) -> str:
    """The first struct with a ``bytes`` field."""
    for field in schema.fields:
        if isinstance(field.dataType, T.StructType) and "bytes" in field.dataType.names:
            return field.name
    raise ValueError(f"no struct with a bytes field among {schema.names}")


def text_column(schema: T.StructType) -> str | None:
    """The preferred transcript column that is there."""
    return next((name for name in TEXT_COLUMNS if name in schema.names), None)


def sniffed_extension(content: Column) -> Column:
    """The extension that the first bytes tell."""
    start = F.hex(F.substring(content, 1, 4))
    out = F.when(F.lit(False), F.lit(""))
    for first, ext in FIRST_BYTES:
        out = out.when(F.startswith(start, F.lit(first)), F.lit(ext))
    return out.otherwise(F.lit(".bin"))


def safe_name(path: Column, shard: Column, row: Column) -> Column:
    """A name from the stored path, or from the row's place if there is none."""
    name = F.regexp_replace(tx.stem(path), r"[^\p{L}\p{N}\-_.]", "_")
    return F.coalesce(F.nullif(name, F.lit("")), F.format_string("shard%05d_row%06d", shard, row))


def parquet_files(spark: SparkSession, root: str, first: int | None = None) -> DataFrame:
    """The parquet files below ``root`` by path, the first few where asked; none of them is opened."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(root).select("path").orderBy("path")
    return found if first is None else found.limit(first)


def planned(rows: DataFrame, shard: str = "shard", row: str = "row", limit: int | None = None) -> DataFrame:
    """file_name, text, content and place of ``rows`` that have media; only the columns named are read.

    ``limit`` takes the first rows that have media, by their place. Of rows with the same name the first
    keeps it, and the others have their place added to it, so none is written over another.
    """
    audio, text = audio_column(rows.schema), text_column(rows.schema)
    path = F.col(f"{audio}.path") if "path" in rows.schema[audio].dataType.names else F.lit(None).cast("string")
    content = F.col(f"{audio}.bytes")
    base, ext = safe_name(path, F.col(shard), F.col(row)), sniffed_extension(content)
    held = rows.filter(F.octet_length(content) > 0)
    place = F.struct(F.col(shard).cast("long").alias("shard"), F.col(row).cast("long").alias("row"))
    told = (F.coalesce(F.col(text), F.lit("")) if text else F.lit("")).alias("text")
    if limit is not None:
        last = held.select(place.alias("p")).orderBy("p").limit(limit).agg(F.max("p").alias("last")).select("last.*").first()  # one place
        held = held.filter(place <= F.struct(F.lit(last["shard"]).cast("long").alias("shard"), F.lit(last["row"]).cast("long").alias("row")))
    named = held.select(base.alias("base"), ext.alias("ext"), told, content.alias("content"), place.alias("place"))
    names = named.select(F.concat("base", "ext").alias("file_name"), "place")
    shared = workspace.saved(names.groupBy("file_name").agg(F.count("*").alias("n"), F.min("place").alias("first")).filter("n > 1").select("file_name", "first"), "shared_names")
    met = named.withColumn("file_name", F.concat("base", "ext")).join(shared, "file_name", "left")
    other = F.concat("base", F.format_string("_shard%05d_row%06d", "place.shard", "place.row"), "ext")
    name = F.when(F.col("first").isNull() | (F.col("first") == F.col("place")), F.col("file_name")).otherwise(other)
    return met.select(name.alias("file_name"), "text", "content", "place")


def write_files(plan: DataFrame, folder: str, encode: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Write each row's content to ``folder``; returns file_name, text and ``error``.

    With ``encode`` contents become WAVs, and a row that it fails on has no file and says why. A file
    is renamed when it is whole, so a lost task leaves none in part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = tail.opened(folder)
        where.create_dir(root, recursive=True)

        def written(name: str, content: bytes) -> tuple[str, str | None]:
            try:
                if encode is not None:
                    name, content = f"{name.rsplit('.', 1)[0]}.wav", encode(content)
            except Exception as e:  # noqa: BLE001  a row's failure is its own
                return name, f"{type(e).__name__}: {e}"[:200]
            part = f"{root}/.{uuid.uuid4().hex}.part"
            with where.open_output_stream(part, compression=None) as out:
                out.write(content)
            where.move(part, f"{root}/{name}")
            return name, None

        for batch in batches:
            done = [written(name, content.as_py()) for name, content in zip(batch.column("file_name").to_pylist(), batch.column("content"), strict=True)]
            names, errors = zip(*done, strict=True) if done else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), batch.column("text"), pa.array(errors, pa.string())], ["file_name", "text", "error"])

    return plan.select("file_name", "text", "content").mapInArrow(run, "file_name string, text string, error string")


def extract(rows: DataFrame, folder: str, limit: int | None = None, encode: Callable[[bytes], bytes] | None = None) -> dict[str, int]:
    """Media of ``rows`` as files in ``folder`` beside ``metadata.csv`` (file_name, text); how many, and how many failed.

    Rows without media count as failed, as do those that can't be encoded.
    """
    done = workspace.saved(write_files(planned(rows, limit=limit), folder, encode), "extracted")
    done.filter("error is null").select("file_name", "text").write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{folder}/metadata.csv")
    n, errors = done.agg(F.count("*"), F.count("error")).first()
    empty = 0 if limit is not None else rows.count() - n
    return {"files": n - errors, "errors": errors + empty}


def video_sidecar(info: Column, source: str) -> Column:
    """The sidecar of a downloaded video from its info document, as JSON."""

    def get(name: str) -> Column:
        return F.get_json_object(info, f"$.{name}")

    video = get("id")
    return F.to_json(F.struct(
        F.coalesce(F.nullif(get("title"), F.lit("")), video, F.lit("")).alias("title"),
        F.coalesce(F.nullif(get("webpage_url"), F.lit("")), F.concat(F.lit("https://www.youtube.com/watch?v="), video)).alias("url"),
        F.lit(source).alias("source"),
        video.alias("youtube_id"),
        F.coalesce(F.nullif(get("channel"), F.lit("")), get("uploader")).alias("channel"),
        get("channel_id").alias("channel_id"),
        get("upload_date").alias("upload_date"),
        get("duration").try_cast("double").alias("duration"),
        get("language").alias("language"),
        F.left(F.coalesce(get("description"), F.lit("")), F.lit(500)).alias("description"),
    ))
