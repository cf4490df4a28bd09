"""Models in Spark: one instance a worker, fed in batches of its own size; detectors as table functions.

A host keeps rows until its model's batch is full, whatever the size of Arrow's batches, and hands
them on in order with the result beside them. Failures are handled as ``providers.Batches`` says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import _parse_datatype_string
from pyspark.sql.window import Window

from .. import providers, workspace
from ..functions import vectors
from . import signals, speakers

#: Models by name, kept as long as the worker lives.
_models: dict[str, object] = {}


def _model(name: str, make: Callable[[], object]) -> object:
    if name not in _models:
        _models[name] = make()
    return _models[name]


def hosted(rows: DataFrame, name: str, make: Callable[[], Callable[[list], list]], inputs: Sequence[str], output: str, kind: str, size: int = 16, strict: bool = False) -> DataFrame:
    """``rows`` with the column ``output`` (of type ``kind``) that a model gives for ``inputs``.

    ``make`` loads the model, once a worker for each ``name`` and only where there are rows. It is
    called with a list of inputs (tuples, if there are several) and gives as many results. Rows
    whose inputs are all null are not shown to it and get null.
    """
    result = to_arrow_type(_parse_datatype_string(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feed: providers.Batches | None = None
        held: list[pa.RecordBatch] = []
        count = 0

        def told(table: pa.Table) -> Iterator[pa.RecordBatch]:
            nonlocal feed
            if feed is None:
                feed = providers.Batches(_model(name, make), size, strict)
            columns = [table.column(c).to_pylist() for c in inputs]
            items = columns[0] if len(columns) == 1 else list(zip(*columns, strict=True))
            none = [all(c[k] is None for c in columns) for k in range(table.num_rows)]
            found = iter(feed([x for x, n in zip(items, none, strict=True) if not n]))
            out = pa.array([None if n else next(found) for n in none], result)
            yield from table.append_column(pa.field(output, result), out).combine_chunks().to_batches()

        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= size:
                table = pa.Table.from_batches(held)
                full = count // size * size
                for at in range(0, full, size):
                    yield from told(table.slice(at, size))
                held = [b for b in table.slice(full).to_batches() if b.num_rows]
                count -= full
        if count:
            yield from told(pa.Table.from_batches(held))

    shape = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema), f"`{output}` {kind}"])
    return rows.mapInArrow(run, shape)


class Windows:
    """A scorer over windows of ``seconds``: short signals are filled with zeros, a rest is left out, scores averaged.

    ``score`` gets a window at ``rate``; items are (samples, own rate).
    """

    def __init__(self, score: Callable[[np.ndarray], float], seconds: float = 9.0, rate: int = 16_000) -> None:
        self.score, self.size, self.rate = score, int(seconds * rate), rate

    def __call__(self, items: list[tuple]) -> list[float]:
        return [self.one(np.asarray(x, dtype=np.float32), rate) for x, rate in items]

    def one(self, x: np.ndarray, rate: int) -> float:
        x = signals.resample(x, rate, self.rate)
        x = np.pad(x, (0, max(0, self.size - len(x))))
        found = [self.score(x[at : at + self.size]) for at in range(0, len(x) - self.size + 1, self.size)]
        return round(sum(found) / len(found), 3)


def scored(rows: DataFrame, name: str, make: Callable[[], Callable[[np.ndarray], float]], samples: str, rate: str, output: str = "mos", seconds: float = 9.0, model_rate: int = 16_000) -> DataFrame:
    """``rows`` with the mean score of a signal's windows; null where the scorer fails."""
    return hosted(rows, name, lambda: Windows(make(), seconds, model_rate), [samples, rate], output, "double", 1)


def embedded(rows: DataFrame, name: str, make: Callable[[], Callable[[np.ndarray, int], np.ndarray]], samples: str, rate: str, output: str = "embedding", size: int = 16) -> DataFrame:
    """``rows`` with the embedding of each signal; null where the embedder fails."""

    def load():
        model = make()
        return lambda items: [[float(v) for v in model(np.asarray(x, dtype=np.float32), r)] for x, r in items]

    return hosted(rows, name, load, [samples, rate], output, "array<float>", size)


def transcribed(rows: DataFrame, name: str, make: Callable[[], providers.Transcriber], samples: str, output: str = "text", size: int = 16, strict: bool = False) -> DataFrame:
    """``rows`` with the trimmed text of each signal; ``strict`` for the transcriber that must not fail."""

    def load():
        model = make()
        return lambda items: [(t or "").strip() for t in model([np.asarray(x, dtype=np.float32) for x in items])]

    return hosted(rows, name, load, [samples], output, "string", size, strict)


# speech intervals as a table function


def speech_function(detector: providers.SpeechDetector = providers.energy_gate, keep: bool = False):
    """A table function of (samples, rate): start and end of each stretch of speech, in seconds.

    With ``keep`` a signal without speech gives one row of nulls.
    """

    class Intervals:
        def eval(self, samples: list, rate: int):
            found = detector(np.asarray(samples, dtype=np.float32), rate) if samples is not None and rate else []
            for start, end in found or ([(None, None)] if keep else []):
                yield start, end

    return F.udtf(Intervals, returnType="start double, end double")


def speech_intervals(rows: DataFrame, samples: str, rate: Column, detector: providers.SpeechDetector = providers.energy_gate, keep: bool = False) -> DataFrame:
    """``rows`` side by side with their speech: one row an interval; ``keep`` keeps what has none, with nulls."""
    held = rows.withColumn("_rate", rate)
    return held.lateralJoin(speech_function(detector, keep)(F.col(samples).outer(), F.col("_rate").outer())).drop("_rate")


# diarisation


def windows(rows: DataFrame, samples: str, rate: int, seconds: float, hop: float) -> DataFrame:
    """``rows`` once for each window of ``seconds``, every ``hop``: k, start, end and its samples; a shorter signal is one window."""
    size, step = int(seconds * rate), int(hop * rate)
    last = F.greatest(F.lit(0), F.floor((F.size(samples) - size) / step)).cast("int")
    out = rows.withColumn("k", F.explode(F.sequence(F.lit(0), last)))
    end = F.least(F.col("k") * step + size, F.size(samples))
    return out.withColumns({"start": F.col("k") * step / rate, "end": end / rate, samples: F.slice(samples, F.col("k") * step + 1, size)})


def turns(found: DataFrame, segment: str, change: float = 0.45, same: float = 0.35) -> DataFrame:
    """segment, speaker, start, end, seconds: who speaks when, from windows (segment, k, start, end, embedding).

    A turn ends where a window's embedding is further than ``change`` from the one before it, in cosine
    distance. A turn lasts until the next one starts. Turns whose mean embeddings cluster below ``same``
    are one speaker, named as ``speakers.clusters`` does, in the order of their first turns.
    """
    by = Window.partitionBy(segment).orderBy("k")
    rows = found.filter("embedding is not null").withColumn("_e", F.transform("embedding", lambda v: v.cast("double")))
    apart = vectors.cosine_distance(F.lag("_e").over(by), F.col("_e")) > change
    rows = rows.withColumn("_new", F.coalesce(apart.cast("long"), F.lit(0))).withColumn("_turn", F.sum("_new").over(by))
    spans = rows.groupBy(segment, "_turn").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    until = F.lead("start").over(Window.partitionBy(segment).orderBy("_turn"))
    spans = spans.withColumn("end", F.least(F.coalesce(until, F.col("end")), F.col("end")))
    means = rows.select(segment, "_turn", F.posexplode("_e").alias("at", "v")).groupBy(segment, "_turn", "at").agg(F.avg("v").alias("v"))
    means = means.groupBy(segment, "_turn").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda x: x["v"]).alias("embedding"))
    means = workspace.saved(means.select(F.col(segment).alias("file_id"), F.col("_turn").alias("id"), "embedding"), "turns")
    named = speakers.clusters(means, same)
    named = named.select(F.col("file_id").alias(segment), F.col("id").alias("_turn"), F.col("speaker_id").alias("speaker"))
    return spans.join(named, [segment, "_turn"]).select(F.col(segment).alias("segment"), "speaker", "start", "end", (F.col("end") - F.col("start")).alias("seconds"))


def diarised(rows: DataFrame, segment: str, samples: str, rate: int, name: str, make: Callable[[], Callable[[np.ndarray, int], np.ndarray]], seconds: float = 1.5, hop: float = 0.75, change: float = 0.45, same: float = 0.35) -> DataFrame:
    """Turns of every segment's signal, by an embedder over sliding windows; ``speakers.dominant`` sums them up."""
    cut = windows(rows.select(segment, samples), samples, rate, seconds, hop).withColumn("rate", F.lit(rate))
    found = embedded(cut, name, make, samples, "rate").drop(samples, "rate")
    return turns(workspace.saved(found, "windows"), segment, change, same)
