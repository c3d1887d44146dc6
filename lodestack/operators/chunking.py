"""Cutting files into chunks and hashing them."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def num_chunks(length: Column, size: Column) -> Column:
    """Chunks of `size` that cover `length`; none if either is 0."""
    return F.when((length == 0) | (size == 0), F.lit(0).cast("long")).otherwise(F.ceil(length / size).cast("long"))


def fixed_chunks(files: DataFrame, size: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(file_id, *keep, chunk_idx, offset, size, digest, payload) of each file; an empty file has no chunk.

    The chunks are cut inside one array, so no row carries the file's content beside its chunk.
    """
    n = num_chunks(F.octet_length("content").cast("long"), F.lit(size))
    piece = lambda i: F.struct(i.alias("chunk_idx"), (i * size).alias("offset"), F.substring(F.col("content"), (i * size + 1).cast("int"), F.lit(size)).alias("payload"))
    some = files.filter(F.octet_length("content") > 0).select("file_id", *keep, F.inline(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), piece)))
    return some.select("file_id", *keep, "chunk_idx", "offset", F.octet_length("payload").cast("long").alias("size"), F.sha2("payload", 256).alias("digest"), "payload")


_GEAR = np.random.default_rng(2024).integers(0, 2**63, 256, dtype=np.uint64)
#: bytes of files that are hashed together
BUFFER = 1 << 20


def gear_hashes(raw: np.ndarray) -> np.ndarray:
    """The gear hash of the last 64 bytes at each byte, by doubling; taken in blocks that stay in the CPU's cache."""
    out, block = np.empty(len(raw), np.uint64), 1 << 15
    for a in range(0, len(raw), block):
        begin = max(0, a - 63)
        h = _GEAR[raw[begin : a + block]]
        for step in (1, 2, 4, 8, 16, 32):
            h[step:] += h[:-step] << np.uint64(step)
        out[a : a + block] = h[a - begin :]
    return out


def masks(average: int) -> tuple[np.uint64, np.uint64]:
    """Bits that must be 0 where a chunk ends: more of them before the average size than after it, which draws sizes to the average."""
    bits = max(2, int(average).bit_length() - 1)
    high = lambda n: np.uint64(((1 << min(n, 63)) - 1) << (64 - min(n, 63)))  # noqa: E731 - the high bits hold the longest window
    return high(bits + 1), high(bits - 1)


def cut_points(raw: bytes | np.ndarray, average: int, hashes: np.ndarray | None = None) -> list[int]:
    """Ends of content-defined chunks with normalised sizes.

    From average / 4 bytes on, a chunk ends where the gear hash meets the strict mask; from the average on, where it meets
    the lax one; at 4 averages in any case. Only the last chunk may be shorter. The hash at a place looks at no more
    than the 64 bytes before it and none before the chunk's own least size... so the cuts are a function of the bytes.
    Empty input has none.
    """
    raw = np.frombuffer(raw, np.uint8) if isinstance(raw, (bytes, bytearray)) else raw
    n, low, high = len(raw), max(1, average // 4), average * 4
    if not n:
        return []
    h = gear_hashes(raw) if hashes is None else hashes
    strict, lax = masks(average)
    soft = np.flatnonzero(h & lax == 0) + 1
    hard = soft[h[soft - 1] & strict == 0]
    soft, hard, ends, last = soft.tolist(), hard.tolist(), [], 0
    while last < n:
        k = bisect_left(hard, last + low)
        end = hard[k] if k < len(hard) and hard[k] <= last + average else None
        if end is None:
            k = bisect_right(soft, max(last + average, last + low - 1))
            end = soft[k] if k < len(soft) else n
        last = min(end, last + high, n)
        ends.append(last)
    return ends


def content_chunks(files: DataFrame, average: int) -> DataFrame:
    """(file_id, chunk_idx, offset, size, digest, file_digest, file_size) by content-defined chunking: a pure function of the bytes.

    Chunks and whole file are hashed in the same pass. Files are taken one after the other from buffers of bounded
    size, save that a file is whole in one; a file without bytes has no chunk.
    """
    import hashlib

    names = ["file_id", "chunk_idx", "offset", "size", "digest", "file_digest", "file_size"]
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            ids, content, a = batch.column("file_id").to_pylist(), batch.column("content"), 0
            sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in content]
            while a < len(ids):
                b, held = a, 0
                while b < len(ids) and (b == a or held + sizes[b] <= BUFFER):
                    held += sizes[b]
                    b += 1
                joined = b"".join(content[k].as_buffer() if sizes[k] else b"" for k in range(a, b))
                raw, at, rows = np.frombuffer(joined, np.uint8), 0, []
                hashes = gear_hashes(raw)
                for k in range(a, b):
                    own, end_of, last = memoryview(joined)[at : at + sizes[k]], at + sizes[k], 0
                    head = gear_hashes(raw[at : min(end_of, at + 64)])  # the window doesn't reach into the file before
                    hashes[at : at + len(head)] = head
                    whole = hashlib.sha256(own).hexdigest()
                    for i, end in enumerate(cut_points(raw[at:end_of], average, hashes[at:end_of])):
                        rows.append((ids[k], i, last, end - last, hashlib.sha256(own[last:end]).hexdigest(), whole, sizes[k]))
                        last = end
                    at = end_of
                cols = list(zip(*rows, strict=True)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)
                a = b

    return files.select("file_id", "content").mapInArrow(run, "file_id long, chunk_idx long, offset long, size long, digest string, file_digest string, file_size long")


def chunk_batches(chunks: DataFrame, most: int = 64) -> DataFrame:
    """(file_id, batch, first_chunk, n_chunks, offset, size): the chunks of each file in contiguous batches of at most `most`, none empty."""
    batch = F.expr(f"chunk_idx div {most}")
    return chunks.groupBy("file_id", batch.alias("batch")).agg(F.min("chunk_idx").alias("first_chunk"), F.count("*").alias("n_chunks"), F.min("offset").alias("offset"), F.sum("size").alias("size"))


def tiling(chunks: DataFrame, lengths: DataFrame) -> DataFrame:
    """(file_id, tiles): do the chunks start at 0, touch, and end at the file's `length`? Sums and neighbours decide, in one window a file."""
    from pyspark.sql import Window

    order = Window.partitionBy("file_id").orderBy("offset", "chunk_idx")
    gap = F.col("offset") != F.lag(F.col("offset") + F.col("size"), 1, 0).over(order)
    seen = chunks.withColumn("_gap", gap).groupBy("file_id").agg(F.max("_gap").alias("_gap"), F.max(F.col("offset") + F.col("size")).alias("_end"))
    whole = lengths.join(seen, "file_id", "left")
    return whole.select("file_id", F.when(F.col("length") == 0, F.col("_end").isNull()).otherwise(F.coalesce(~F.col("_gap") & (F.col("_end") == F.col("length")), F.lit(False))).alias("tiles"))
