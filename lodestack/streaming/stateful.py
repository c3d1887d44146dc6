"""Stateful streams: packs from chunks as they come, how far a file is covered, and streams that end."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

PACKS = "file_id long, pack_idx long, size long, n_chunks long"
PACK_STATE = "file array<long>, due array<long>, held array<long>, n array<long>, pack array<long>, ended array<boolean>, idx array<array<long>>, sizes array<array<long>>"
EXTENTS = "file_id long, watermark long, waiting long, whole boolean"
EXTENT_STATE = "file array<long>, watermark array<long>, starts array<array<long>>, stops array<array<long>>, total array<long>"
#: 2 to this power: the ids of neighbouring files that share a group. A group costs milliseconds, however few its rows.
NEIGHBOURS = 7


def _by_neighbours(rows: DataFrame):
    return rows.withColumn("neighbours", F.shiftright("file_id", NEIGHBOURS)).groupBy("neighbours")


def _of_state(state: GroupState) -> dict:
    """What is kept of each file of a group."""
    return {file: own for file, *own in zip(*state.get, strict=True)} if state.exists else {}


def _keep(state: GroupState, files: dict) -> None:
    if files:
        state.update(tuple(map(list, zip(*((file, *own) for file, own in files.items()), strict=True))))
    elif state.exists:
        state.remove()


def _by_file(key: tuple, batches: Iterator[pd.DataFrame], *columns: str) -> dict:
    """The values of the columns in each row of a group, by file. Files without an id are a group of their own."""
    out: dict = {}
    for rows in batches:
        ids = [None] * len(rows) if pd.isna(key[0]) else rows["file_id"].tolist()
        for file, *own in zip(ids, *(rows[c].tolist() for c in columns), strict=True):
            out.setdefault(file, []).append(own)
    return out


def stream_packs(chunks: DataFrame, pack_size: int) -> DataFrame:
    """(file_id, pack_idx, size, n_chunks) of each new pack as soon as it is complete, from a stream of new chunks
    (file_id, chunk_idx, size, last): `chunk_idx` counts the new chunks of a file from 0, `last` marks its last one.

    State is kept of each file, with that of files of neighbouring ids: the open pack, and chunks that came before their
    turn. A chunk joins the open pack, which closes once it holds pack_size; the last chunk closes what is open. So what
    is given is a prefix of the plan at any time, and the whole plan in the end. A file whose end never comes keeps its
    open pack waiting.
    """

    def feed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        files, out = _of_state(state), []
        for file, rows in _by_file(key, batches, "chunk_idx", "size", "last").items():
            due, held, n, pack, _, idx, sizes = files.pop(file, (0, 0, 0, 0, False, [], []))
            waiting = dict(zip(idx, sizes, strict=True))
            for k, size, last in rows:
                waiting[k] = size
                if last:
                    waiting[-1 - k] = 0  # where the file ends
            end = next((-1 - k for k in waiting if k < 0), None)
            while due in waiting:
                held, n = held + waiting.pop(due), n + 1
                if held >= pack_size or due == end:
                    out.append((file, pack, held, n))
                    held, n, pack = 0, 0, pack + 1
                due += 1
            if end is None or due <= end:
                files[file] = (due, held, n, pack, end is not None, list(waiting), list(waiting.values()))
        _keep(state, files)
        yield pd.DataFrame(out, columns=["file_id", "pack_idx", "size", "n_chunks"])

    return _by_neighbours(chunks).applyInPandasWithState(feed, PACKS, PACK_STATE, "append", GroupStateTimeout.NoTimeout)


def stream_watermark(extents: DataFrame) -> DataFrame:
    """(file_id, watermark, waiting, whole) after each batch that touches a file, from a stream of extents (file_id,
    offset, size, total): bytes covered from its start without a gap, extents beyond a gap, and whether the file is
    whole. Extents may come in any order; what lies beyond a gap waits in the state, merged where it touches. Files of
    neighbouring ids share a state, in which each has its own."""

    def feed(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        files, out = _of_state(state), []
        for file, rows in _by_file(key, batches, "offset", "size", "total").items():
            watermark, starts, stops, _ = files.get(file, (0, [], [], -1))
            spans = [*zip(starts, stops, strict=True), *((offset, offset + size) for offset, size, _ in rows)]
            total = int(rows[0][2])
            left: list[list[int]] = []
            for a, b in sorted(spans):
                if a <= watermark:
                    watermark = max(watermark, b)
                elif left and a <= left[-1][1]:
                    left[-1][1] = max(left[-1][1], b)
                else:
                    left.append([a, b])
            files[file] = (watermark, [a for a, _ in left], [b for _, b in left], total)
            out.append((file, watermark, len(left), not left and watermark == total))
        _keep(state, files)
        yield pd.DataFrame(out, columns=["file_id", "watermark", "waiting", "whole"])

    return _by_neighbours(extents).applyInPandasWithState(feed, EXTENTS, EXTENT_STATE, "update", GroupStateTimeout.NoTimeout)


class Bounded:
    """A stream that ends: batches, then just one of `done` or `fail`. After a failure it can't be read again."""

    def __init__(self, stream: DataFrame, checkpoint: str):
        self.stream, self.checkpoint, self.said = stream, checkpoint, []

    def run(self, each: Callable[[DataFrame], None]) -> list[tuple[str, int]]:
        """Hands all there is, batch by batch, to `each`; returns what happened as (`batch`, rows), then (`done` or `fail`, batches)."""
        if any(kind == "fail" for kind, _ in self.said):
            raise RuntimeError("the stream has failed")
        n = 0

        def take(rows: DataFrame, _: int) -> None:
            nonlocal n
            size = rows.count()
            each(rows)
            n += 1
            self.said.append(("batch", size))

        query = self.stream.writeStream.foreachBatch(take).option("checkpointLocation", self.checkpoint).trigger(availableNow=True).start()
        try:
            query.awaitTermination()
        except Exception:
            self.said.append(("fail", n))
            raise
        self.said.append(("done", n))
        return self.said


def run_all(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Everything the stream has by now, written to a table and read back. In `update` mode a row of a later batch comes beside its earlier ones, told apart by `batch`."""
    if mode == "append":
        stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
        return stream.sparkSession.read.schema(stream.schema).parquet(path)

    def put(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")  # a batch tried again takes the place of the first try

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start().awaitTermination()
    return stream.sparkSession.read.schema(stream.withColumn("batch", F.lit(0)).schema).parquet(path)
