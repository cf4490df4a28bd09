"""Parts of recordings: cut by time, joined in order, and brought to one format."""

from __future__ import annotations

import io
import struct
import uuid
import wave
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import workspace
from ..sources import tail
from . import signals


def cut(samples: Column, rate: int, start_s: Column, seconds: Column) -> Column:
    """The samples from ``start_s`` on, ``seconds`` long, the end exclusive and never beyond the last."""
    at = F.floor(F.round(start_s, 3) * rate).cast("int")
    end = F.floor(F.round(start_s + seconds, 3) * rate).cast("int")
    return F.slice(samples, F.greatest(at, F.lit(0)) + 1, F.greatest(end - F.greatest(at, F.lit(0)), F.lit(0)))


def joined(parts: DataFrame, key: str, order: str, samples: str) -> DataFrame:
    """``key`` and its ``samples``, those of all parts in order; a key's parts are one recording."""
    held = F.array_sort(F.collect_list(F.struct(order, samples)))
    return parts.groupBy(key).agg(F.flatten(F.transform(held, lambda p: p[samples])).alias(samples))


def _frames_of(content: bytes) -> tuple[wave._wave_params, bytes] | None:
    """Format and frames of a WAV; none if it can't be read."""
    try:
        with wave.open(io.BytesIO(content)) as w:
            return w.getparams(), w.readframes(w.getnframes())
    except (wave.Error, EOFError):
        return None


def _packed(form: wave._wave_params, frames: bytes) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setparams(form)
        w.writeframes(frames)
    return out.getvalue()


@F.pandas_udf(T.BinaryType())
def wav_cut(contents: pd.Series, starts: pd.Series, seconds: pd.Series) -> pd.Series:
    """A stretch of each WAV in its own rate and channels; null where it can't be read."""

    def run(content, start, length):
        found = _frames_of(content) if content is not None and not pd.isna(start) and not pd.isna(length) else None
        if found is None:
            return None
        form, frames = found
        width = form.sampwidth * form.nchannels
        at, end = (max(0, int(round(t, 3) * form.framerate)) for t in (start, start + length))
        return _packed(form, frames[at * width : max(at, end) * width])

    return pd.Series([run(*row) for row in zip(contents, starts, seconds, strict=True)], dtype=object)


@F.pandas_udf(T.BinaryType())
def _wav_chain(parts: pd.Series) -> pd.Series:
    def run(contents):
        found = [_frames_of(c) if c is not None else None for c in contents]
        if not found or None in found or len({form[:3] for form, _ in found}) > 1:
            return None
        return _packed(found[0][0], b"".join(frames for _, frames in found))

    return parts.map(run)


def wav_joined(parts: DataFrame, key: str, order: str, content: str = "content") -> DataFrame:
    """``key`` and the WAV of its parts in order, not coded anew; null if formats differ or one is unreadable."""
    held = F.array_sort(F.collect_list(F.struct(order, content)))
    listed = parts.groupBy(key).agg(F.transform(held, lambda p: p[content]).alias("parts"))
    return listed.select(key, _wav_chain("parts").alias(content))


def recordings_written(parts: DataFrame, folder: str, key: str, order: str, content: str = "content") -> DataFrame:
    """Write the WAVs of each key, in order, as one WAV ``<key>.wav`` in ``folder``; what was written.

    Returns key, path, seconds, parts and reason: a key whose parts differ in format, or of which one
    can't be read, has no file and says why. The parts are counted first, so that a file's header
    tells its length before its frames come, and any store that takes a stream will do. A task reads
    its sorted parts once and holds one of them, whatever the length of a recording; a file is
    written under another name and renamed when it is whole, so a lost task leaves none in part.
    """
    kind = dict(parts.dtypes)[key]
    sizes = parts.select(key, _frame_bytes(content).alias("f")).groupBy(key).agg(
        F.sum("f.bytes").alias("total"), F.count("*").alias("n_parts"), F.min("f.format").alias("low"), F.max("f.format").alias("high"), F.count("f.bytes").alias("n_good"),
    )
    reason = F.when(F.col("n_good") < F.col("n_parts"), "unreadable").when(F.col("low") != F.col("high"), "formats differ").when(F.col("total") >= 2**32 - 64, "beyond 4 GB")
    sizes = workspace.saved(sizes.select(F.col(key).alias("_key"), "total", "n_parts", reason.alias("reason")), "recordings")
    good = sizes.filter("reason is null")
    rows = parts.select(key, order, content).join(good, F.col(key) == F.col("_key")).repartition(key).sortWithinPartitions(key, order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        open_file: _Recording | None = None
        for batch in batches:
            for name, total, n, wav in zip(*(batch.column(c).to_pylist() for c in (key, "total", "n_parts", content)), strict=True):
                if open_file is None or open_file.key != name:
                    open_file = _Recording(folder, name, total)
                open_file.add(wav)
                if open_file.parts == n:
                    done.append((name, open_file.close(), open_file.seconds, n))
                    open_file = None
        if done:
            columns = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(list(c)) for c in columns], [key, "path", "seconds", "parts"])

    written = rows.select(key, "total", "n_parts", content).mapInArrow(run, f"{key} {kind}, path string, seconds double, parts long")
    bad = sizes.filter("reason is not null").select(F.col("_key").alias(key), F.lit(None).cast("string").alias("path"), F.lit(None).cast("double").alias("seconds"), F.col("n_parts").alias("parts"), "reason")
    return written.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)


@F.pandas_udf(T.StructType([T.StructField("bytes", T.LongType()), T.StructField("format", T.StringType())]))
def _frame_bytes(contents: pd.Series) -> pd.DataFrame:
    """Bytes of the frames and format of a WAV; nulls if it can't be read."""

    def one(content):
        found = _frames_of(content) if content is not None else None
        return (None, None) if found is None else (len(found[1]), "/".join(map(str, found[0][:3])))

    return pd.DataFrame([one(c) for c in contents], columns=["bytes", "format"]).astype({"bytes": "Int64"})


class _Recording:
    """A WAV file whose frames come part by part."""

    def __init__(self, folder: str, key: object, total: int) -> None:
        self.key, self.total, self.parts, self.seconds = key, total, 0, 0.0
        self.store, root = tail.opened(folder.rstrip("/"))
        self.store.create_dir(root, recursive=True)
        self.path = f"{root}/{key}.wav"
        self.part = f"{root}/.{key}.{uuid.uuid4().hex}.part"
        self.out = self.store.open_output_stream(self.part, compression=None)

    def add(self, content: bytes) -> None:
        form, frames = _frames_of(content)
        if not self.parts:
            rate, channels, width = form.framerate, form.nchannels, form.sampwidth
            self.out.write(struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + self.total, b"WAVE", b"fmt ", 16, 1, channels, rate, rate * channels * width, channels * width, 8 * width, b"data", self.total))
            self.seconds = self.total / (rate * channels * width)
        self.out.write(frames)
        self.parts += 1

    def close(self) -> str:
        self.out.close()
        self.store.move(self.part, self.path)
        return self.path


def wav_at(rate: int):
    """A column function that brings 16-bit WAVs to one channel at ``rate``; null where it can't."""

    @F.pandas_udf(T.BinaryType())
    def run(contents: pd.Series) -> pd.Series:
        def one(content):
            try:
                x, own = signals.decode_wav(content)
            except (wave.Error, EOFError):
                return None
            return signals.encode_wav(signals.resample(x, own, rate), rate)

        return contents.map(one, na_action="ignore")

    return run


def converted(files: DataFrame, rate: int, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """``files`` with their WAVs at ``rate``, and the rejects: source_path and reason."""
    done = files.withColumn("wav", wav_at(rate)(content))
    rejects = done.filter("wav is null").select("source_path", F.lit("convert").alias("reason"))
    return done.filter("wav is not null").drop(content).withColumnRenamed("wav", content), rejects
