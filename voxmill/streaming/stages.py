"""Stages as streaming queries over tables, the barrier for whole files, and the gate."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .. import workspace


class Stage:
    """Reads upstream rows, drops what is done, transforms the rest and appends it.

    Each micro-batch is written to a folder of its own number and replaced if it is repeated;
    rows already in the table, of whatever batch, are not done again.
    """

    def __init__(self, spark: SparkSession, path: str, transform: Callable[[DataFrame], DataFrame], key: str = "id") -> None:
        self.spark, self.path, self.transform, self.key = spark, path.rstrip("/"), transform, key

    def table(self) -> DataFrame | None:
        return self.spark.read.parquet(f"{self.path}/rows") if workspace.exists(self.spark, f"{self.path}/rows") else None

    def take(self, batch: DataFrame, number: int) -> None:
        """One micro-batch."""
        done = self.table()
        rows = batch.dropDuplicates([self.key])
        if done is not None:
            rows = rows.join(done.filter(F.col("batch") != number).select(self.key), self.key, "left_anti")
        self.transform(rows).write.mode("overwrite").parquet(f"{self.path}/rows/batch={number}")

    def run(self, upstream: DataFrame) -> None:
        """All that is there now, then stop; call again for what comes later."""
        query = upstream.writeStream.foreachBatch(self.take).option("checkpointLocation", f"{self.path}/checkpoint").trigger(availableNow=True).start()
        query.awaitTermination()


def run_chain(source: DataFrame, stages: list[Stage], max_restarts: int = 5) -> DataFrame:
    """Run stage after stage over what is there; a stage that fails starts again from its
    checkpoint, ``max_restarts`` times at most. Returns the last table."""
    upstream = source
    for stage in stages:
        for attempt in range(max_restarts + 1):
            try:
                stage.run(upstream)
                break
            except Exception:
                if attempt == max_restarts:
                    raise
        table = stage.table()
        upstream = stage.spark.readStream.schema(table.schema).parquet(f"{stage.path}/rows")
    return stages[-1].table()


def ready_rows(pending: DataFrame, done: DataFrame, upstream_done: bool = False) -> DataFrame:
    """Rows of files that are complete: pending and done ones together as many as expected.

    ``pending``: id, file_id, n_segments; ``done``: file_id, n_done. Files that don't say how
    many they expect are always ready, and all are once the upstream is done.
    """
    if upstream_done:
        return pending
    files = pending.groupBy("file_id").agg(F.count("*").alias("n"), F.min_by("n_segments", "id").alias("expected"))
    met = files.join(done, "file_id", "left")
    ready = met.filter(F.col("expected").isNull() | (F.col("n") + F.coalesce("n_done", F.lit(0)) >= F.col("expected")))
    return pending.join(ready.select("file_id"), "file_id", "left_semi")


#: Groups that the files of a barrier are dealt to by their hash; the files of a group share a state and a call,
#: and a call costs some 10 ms whatever its rows. A checkpoint goes on with the number that it began with, and
#: fails with another.
GROUPS = 512
#: Ids that one row of a call's output has.
IDS_AT_ONCE = 1 << 16
#: Packed arrays: files and the numbers they name; files that have ended; ids with their file and whether they came out.
STATE = {"files": np.int64, "numbers": np.int64, "ended": np.int64, "owners": np.int64, "ids": np.int64, "out": np.bool_}


def file_ends(files: DataFrame) -> DataFrame:
    """The end of the upstream as rows of ``barrier``'s stream: one for each file that it has."""
    long = F.lit(None).cast("long")
    return files.select("file_id").distinct().select("file_id", long.alias("id"), long.alias("n_segments"), F.lit(True).alias("end"))


def barrier(stream: DataFrame) -> DataFrame:
    """file_id, id of complete files, as a stream, each id once.

    ``stream``: file_id, id, n_segments (all long) and, where the upstream tells its end, ``end``.
    A file is passed on when as many of its ids are there as the first row that names a number
    says, or at once while none does; what comes later follows at once if that still holds. A row
    with ``end`` passes on what waits of its file, and all that comes after. The state holds the
    ids that wait and, so that a repeated row does not come out twice, those that came out. Rows
    without an id are left out.

    Files are very many and small, and a call for each would cost far more than its few rows. So
    Spark deals them to GROUPS groups, and each call checks all files of a group that have new rows.
    """
    rows = stream if "end" in stream.columns else stream.withColumn("end", F.lit(False))
    ended, groups = F.coalesce("end", F.lit(False)), GROUPS
    group = F.when(F.col("file_id").isNull(), -1).otherwise(F.pmod(F.xxhash64("file_id"), F.lit(groups))).cast("int")
    # without nulls, as pandas would make such columns floats; the group of null has no other file
    values = [F.coalesce(c, F.lit(0)).alias(c) for c in ("file_id", "id", "n_segments")]
    held = rows.select(group.alias("group"), *values, (F.col("id").isNotNull() & ~ended).alias("given"), F.col("n_segments").isNotNull().alias("named"), ended.alias("end"))

    def run(key, parts, state: GroupState):
        *packed, dealt = state.get if state.exists else (*[b""] * len(STATE), groups)
        if dealt != groups:
            raise ValueError(f"the checkpoint began with {dealt} groups, not {groups}")
        was = {name: np.frombuffer(part, STATE[name]) for name, part in zip(STATE, packed, strict=True)}
        parts = [[part[c].to_numpy() for c in ("file_id", "id", "n_segments", "given", "named", "end")] for part in parts]
        file, row_id, number, given, named, end = (np.concatenate(column) for column in zip(*parts, strict=True))
        # what the state has comes first, and of equal keys the first stays
        files, at = np.unique(np.concatenate([was["files"], file[given & named]]), return_index=True)
        numbers = np.concatenate([was["numbers"], number[given & named]])[at]
        ended = np.union1d(was["ended"], file[end])
        owners, ids = np.concatenate([was["owners"], file[given]]), np.concatenate([was["ids"], row_id[given]])
        order = np.lexsort((ids, owners))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(owners[order]) != 0) | (np.diff(ids[order]) != 0)
        order = order[new]
        owners, ids, out = owners[order], ids[order], np.concatenate([was["out"], np.zeros(given.sum(), bool)])[order]
        _, place, count = np.unique(owners, return_inverse=True, return_counts=True)
        short = np.isin(owners, files)
        short[short] = count[place[short]] < numbers[np.searchsorted(files, owners[short])]
        passed = ~short | np.isin(owners, ended)
        now = passed & ~out
        of, which = owners[now], ids[now]
        for k in range(0, len(which), IDS_AT_ONCE):
            yield pd.DataFrame({"null": [key[0] < 0], "file_id": [of[k : k + IDS_AT_ONCE]], "id": [which[k : k + IDS_AT_ONCE]]})
        held = (files, numbers, ended, owners, ids, out | passed)
        state.update((*(np.asarray(x, kind).tobytes() for x, kind in zip(held, STATE.values(), strict=True)), groups))

    schema = ", ".join(f"{name} binary" for name in STATE) + ", groups int"
    # Spark fills up each batch of output with as many empty states, so a row of output has many ids
    out = held.filter("given or end").groupBy("group").applyInPandasWithState(run, "null boolean, file_id array<long>, id array<long>", schema, "append", GroupStateTimeout.NoTimeout)
    return out.select("null", F.inline(F.arrays_zip("file_id", "id"))).select(F.when(~F.col("null"), F.col("file_id")).alias("file_id"), "id")


class Gate:
    """Pauses work above ``high`` and lets it go on below ``low``."""

    def __init__(self, high: float, low: float) -> None:
        self.high, self.low, self.paused = high, low, False

    def blocked(self, level: float) -> bool:
        if level > self.high:
            self.paused = True
        elif level < self.low:
            self.paused = False
        return self.paused
