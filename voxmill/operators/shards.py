"""Shards of bounded size, cut greedily in order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame


def assign(rows: DataFrame, group: list[str], order: str, size: str, limit: int) -> DataFrame:
    """``group``, ``order``, ``size`` and ``shard``: a shard ends with the row that fills it.

    The cut is a fold over each group in order, and not one of sums alone, as every shard starts
    from zero. Groups are the batches of an incremental package (split and batch), so they
    are bounded; a task runs through its sorted rows once and holds two numbers.
    """
    narrow = rows.select(*group, order, size)
    schema = ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema.fields], "shard int"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, total, shard = None, 0, 0
        for batch in batches:
            keys = zip(*[batch.column(g).to_pylist() for g in group], strict=True)
            out = []
            for key, n in zip(keys, batch.column(size).to_pylist(), strict=True):
                if key != last:
                    last, total, shard = key, 0, 0
                out.append(shard)
                total += n or 0
                if total >= limit:
                    total, shard = 0, shard + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.int32())], names=[*batch.schema.names, "shard"])

    return narrow.repartition(*group).sortWithinPartitions(*group, order).mapInArrow(run, schema)
