"""From speech intervals to segments of bounded length."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.window import Window

from ..functions import ids


#: Segments that a task holds before it hands them on.
BATCH = 10_000


def segments_of(intervals: DataFrame, min_s: float, max_s: float, pad_s: float = 0.1) -> DataFrame:
    """One row per segment of each file: file_id, seg_index, n_segments, start, end, id, duration.

    A file's intervals (file_id, start, end), in order, are extended while they fit, cut hard
    where one alone is too long, padded, and left out if shorter than ``min_s``. Cuts add
    ``max_s`` again and again, so times agree to the last bit with a running cutter. Intervals
    without finite bounds are left out; times so large that adding ``max_s`` changes nothing are refused.

    A task runs through its sorted rows once and holds the open segment, so a file may have any
    number of intervals; sort and count spill.
    """
    bounds = [F.col(c).cast("double").alias(c) for c in ("start", "end")]
    rows = intervals.select("file_id", *bounds).filter((F.abs("start") < float("inf")) & (F.abs("end") < float("inf")))
    key = pa.field("file_id", to_arrow_schema(rows.schema).field("file_id").type)
    schema = pa.schema([key, ("seg_index", pa.int32()), ("start", pa.float64()), ("end", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, file, start, end, index = False, None, 0.0, 0.0, 0
        out: list[tuple] = []

        def close(until: float) -> None:
            nonlocal index
            a, b = max(start - pad_s, 0.0), until + pad_s
            if b - a >= min_s:
                out.append((file, index, a, b))
                index += 1

        def told() -> pa.RecordBatch:
            ready = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out.clear()
            return ready

        for batch in batches:
            for name, a, b in zip(*(batch.column(c).to_pylist() for c in ("file_id", "start", "end")), strict=True):
                if opened and name == file and b - start <= max_s:
                    end = b
                else:
                    if opened:
                        close(end)
                    if not opened or name != file:
                        index = 0
                    opened, file, start, end = True, name, a, b
                while end - start > max_s:
                    if start + max_s == start:
                        raise ValueError(f"times near {start:g} are too coarse for segments of {max_s:g}; give them from a later origin or in a larger unit")
                    close(start + max_s)
                    start += max_s
                    if len(out) >= BATCH:
                        yield told()
            if out:
                yield told()
        if opened:
            close(end)
            if out:
                yield told()

    sorted_rows = rows.repartition("file_id").sortWithinPartitions("file_id", "start", "end")
    kind = rows.schema["file_id"].dataType.simpleString()
    found = sorted_rows.mapInArrow(run, f"file_id {kind}, seg_index int, start double, end double")
    n = F.count("*").over(Window.partitionBy("file_id")).cast("int")
    start, end = F.col("start"), F.col("end")
    return found.select("file_id", "seg_index", n.alias("n_segments"), "start", "end", ids.segment_id(F.col("file_id").cast("string"), start, end).alias("id"), (end - start).alias("duration"))


def chunk_plan(files: DataFrame, chunk_s: float) -> DataFrame:
    """``files`` (with ``duration``), one row per chunk; a rest of half a second or less goes."""
    rest = F.col("duration") - F.floor(F.col("duration") / chunk_s) * chunk_s
    n = F.floor(F.col("duration") / chunk_s) + F.when(rest > 0.5, 1).otherwise(0)
    rows = files.withColumn("n_chunks", n.cast("int")).filter("n_chunks > 0").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("n_chunks") - 1)))
    start = F.col("chunk") * F.lit(float(chunk_s))
    return rows.withColumn("chunk_start", start).withColumn("chunk_seconds", F.least(F.lit(float(chunk_s)), F.col("duration") - start))
