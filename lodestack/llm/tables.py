"""Sums of fixed-size count tables over all tasks, and the bounded tables themselves."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame


def sum_tables(df: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], length: int, parts: int = 64, salts: int = 16) -> np.ndarray:
    """The sum of the int64 tables of `length` that `count` makes of each task's rows.

    Each task gives its table in `parts` pieces; pieces are added by (piece, task modulo salts) and then by piece, so
    no task holds all of them. The driver gets one table, whose size doesn't depend on the data's.
    """
    width = -(-length // parts)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(width * parts, np.int64)
        own[:length] = count(it)
        task = TaskContext.get().partitionId()
        for k in range(parts):
            piece = own[k * width : (k + 1) * width]
            if piece.any():
                kind = next(t for t in ("<i2", "<i4", "<i8") if -np.iinfo(t).max <= piece.min() and piece.max() <= np.iinfo(t).max)
                yield pa.RecordBatch.from_pydict({"part": pa.array([k], pa.int32()), "salt": pa.array([task % salts], pa.int32()), "kind": [kind], "counts": [piece.astype(kind).tobytes()]})

    def add(rows: pa.Table) -> pa.Table:
        total = np.zeros(width, np.int64)
        for kind, raw in zip(rows["kind"].to_pylist(), rows["counts"].to_pylist(), strict=True):
            total += np.frombuffer(raw, kind)
        return pa.table({"part": rows["part"][:1], "salt": pa.array([0], pa.int32()), "kind": ["<i8"], "counts": [total.tobytes()]})

    schema = "part int, salt int, kind string, counts binary"
    sums = df.mapInArrow(run, schema).groupBy("part", "salt").applyInArrow(add, schema).groupBy("part").applyInArrow(add, schema)
    out = np.zeros(width * parts, np.int64)
    for r in sums.collect():  # at most `parts` rows
        out[r.part * width : (r.part + 1) * width] = np.frombuffer(r.counts, "<i8")
    return out[:length]
