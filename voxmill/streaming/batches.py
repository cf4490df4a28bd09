"""Micro-batches by count or age: work comes out ``size`` rows at a time, or when it has waited.

Rows wait in keyed state, one key for each slot that works through batches. A batch comes out
once ``size`` rows are there; what is left waits for more rows until ``seconds`` after it began to
wait, by a processing-time timer, and then comes out as a smaller batch. A row that marks the
upstream's end lets everything out, and what comes after it at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "rows array<string>, since long, made long, ended boolean"


@dataclass
class Waiting:
    """What one slot has waiting; ``since`` is when the oldest of it began to wait, in ms."""

    rows: list[str] = field(default_factory=list)
    since: int | None = None
    made: int = 0
    ended: bool = False

    def take(self, new: list[str], now: int, size: int) -> Iterator[tuple[int, list[str]]]:
        """Add rows; the full batches that this makes, numbered."""
        if new and not self.rows:
            self.since = now
        self.rows += new
        while len(self.rows) >= size:
            yield self._out(size)
            self.since = now if self.rows else None

    def due(self, now: int, seconds: float) -> Iterator[tuple[int, list[str]]]:
        """What is left as one batch, if it has waited long enough or the upstream has ended."""
        if self.rows and (self.ended or now - self.since >= 1000 * seconds):
            yield self._out(len(self.rows))
            self.since = None

    def wait(self, now: int, seconds: float) -> int | None:
        """Milliseconds until what is left is due; None if nothing waits."""
        return max(1, int(self.since + 1000 * seconds - now)) if self.rows else None

    def _out(self, count: int) -> tuple[int, list[str]]:
        out, self.rows = self.rows[:count], self.rows[count:]
        self.made += 1
        return self.made - 1, out


def slot_ends(stream_of_slots: DataFrame, schema: T.StructType) -> DataFrame:
    """The upstream's end as rows of ``micro_batches``' stream: one for each slot."""
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name not in ("slot", "end")]
    return stream_of_slots.select("slot").distinct().select("slot", *nulls, F.lit(True).alias("end"))


def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState, size: int, seconds: float) -> Iterator[pd.DataFrame]:
    """One call for a slot: new rows, or a timer that went off."""
    held = Waiting(*state.get) if state.exists else Waiting()
    held.rows, held.made = list(held.rows), held.made or 0
    now = state.getCurrentProcessingTimeMs()

    def told(batches: Iterator[tuple[int, list[str]]]) -> Iterator[pd.DataFrame]:
        for number, rows in batches:
            yield pd.DataFrame({"slot": [key[0]] * len(rows), "batch": [number] * len(rows), "row": rows})

    for part in parts:
        ends = part["end"].fillna(False).astype(bool)
        held.ended = held.ended or bool(ends.any())
        yield from told(held.take(part["row"][~ends].tolist(), now, size))
    yield from told(held.due(now, seconds))
    state.update((held.rows, held.since, held.made, held.ended))
    if (ms := held.wait(now, seconds)) is not None:
        state.setTimeoutDuration(ms)


def micro_batches(stream: DataFrame, size: int, seconds: float) -> DataFrame:
    """``stream`` (slot long and what else a row has, ``end`` where the upstream tells its end) with ``batch``.

    A slot's batches are numbered from 0. Deal rows evenly over the slots: a slot's rows pass one
    task, and its state holds fewer than ``size`` of them.
    """
    rows = stream if "end" in stream.columns else stream.withColumn("end", F.lit(False))
    own = [f for f in stream.schema if f.name not in ("slot", "end")]
    packed = rows.select("slot", F.to_json(F.struct(*[f.name for f in own])).alias("row"), "end")

    def run(key, parts, state: GroupState):
        yield from step(key, parts, state, size, seconds)

    out = packed.groupBy("slot").applyInPandasWithState(run, "slot long, batch long, row string", STATE, "append", GroupStateTimeout.ProcessingTimeTimeout)
    return out.select("slot", "batch", F.from_json("row", T.StructType(own)).alias("r")).select("slot", "batch", "r.*")
