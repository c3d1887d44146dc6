"""Operator 3: token ids in a content-addressed chunk store with recipes and Merkle manifests.

A store is a folder of three Parquet tables:

* ``objects/kind=chunk``: one row for each distinct chunk: key (SHA-256 of its ids as little-endian unsigned 32-bit
  integers), payload (zstd of those integers; 16-bit ones where every id fits, told by `wide`);
* ``recipes``: one row for each document in ascending doc_id order (nulls first): doc_id, position, start (ids of
  all documents before it), n_tokens, root (Merkle root of its chunk digests), digests, lengths;
* ``manifest``: the Merkle tree over the recipes in order: level, node, first position, digest. Each node hashes up
  to FANOUT nodes of the level below; the last level has one node.
"""

from __future__ import annotations

import hashlib
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import default_tokenizer
from .common import batches, cut, delete, new_path, ranged, remove, table
from .kernels import mix, powers, text_buffer
from .pretokens import Encoder, classes

END_ID = 0
WINDOW, MIN_IDS, MEAN_IDS, MAX_IDS, FANOUT = 16, 128, 512, 2048, 256
BATCH_BYTES = 1 << 21


def chunk_marks(ids: np.ndarray) -> list[int]:
    """Places that the rolling hash of the WINDOW ids before them picks; which ones does not depend on where the ids lie."""
    n = len(ids)
    if n < WINDOW:
        return []
    up, down = powers(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(ids.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    rolling = mix((total[WINDOW:] - total[:-WINDOW]) * down[: n - WINDOW + 1])
    return (np.flatnonzero((rolling >> np.uint64(40)) % np.uint64(MEAN_IDS - MIN_IDS) == 0) + WINDOW).tolist()


def chunk_ends(begin: int, end: int, marks: list[int]) -> list[int]:
    """Ends of the content-defined chunks of the ids from begin to end: the marks, at least MIN_IDS and at most MAX_IDS
    apart. MIN_IDS is more than WINDOW, so no hash that counts reaches over a chunk's begin."""
    ends, last = [], begin
    while end - last > MIN_IDS:
        k = bisect_left(marks, last + MIN_IDS)
        last = min(marks[k] if k < len(marks) else end, last + MAX_IDS, end)
        ends.append(last)
    if last < end:
        ends.append(end)
    return ends


def with_ends(ids: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets) with END_ID after the ids of each document."""
    n = len(at) - 1
    out = np.full(len(ids) + n, END_ID, "<u4")
    out[np.arange(len(ids)) + np.repeat(np.arange(n), np.diff(at))] = ids
    return out, at + np.arange(n + 1)


def merkle(digests: list[bytes]) -> bytes:
    """Root of a binary Merkle tree; leaves and inner nodes are hashed apart, an odd node moves up. No leaves: SHA-256 of nothing."""
    level = [hashlib.sha256(b"\0" + d).digest() for d in digests]
    while len(level) > 1:
        level = [hashlib.sha256(b"\1" + b"".join(level[k : k + 2])).digest() if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)]
    return level[0] if level else hashlib.sha256().digest()


@lru_cache(1)
def _encoder(spec, kinds) -> Encoder:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_str(spec.value)
    tok.no_truncation()
    tok.no_padding()
    special = {t.content: i for i, t in tok.get_added_tokens_decoder().items()}
    return Encoder(lambda xs: [e.ids for e in tok.encode_batch_fast(xs, add_special_tokens=False)], special, kinds.value, keep=900_000)


class _Same:
    """A broadcast that the cache takes for equal to another of the same key."""

    def __init__(self, key: str, shared):
        self.key, self.shared = key, shared

    value = property(lambda self: self.shared.value)

    def __eq__(self, other):
        return self.key == other.key

    def __hash__(self):
        return hash(self.key)


OBJECTS = "key binary, doc_id {}, n_tokens long, root binary, digests array<binary>, lengths array<int>, payload binary, wide boolean, kind string"


def encode(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Rows of two kinds (see OBJECTS): a recipe for each document, under a key of its own, and its chunks, under their digests.

    Each distinct piece of text goes once through the tokenizers library, whose ids are then put together by
    document. A task gives a chunk once, save that its memory of chunks starts anew after many.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        spec = f.read()
    shared = _Same(hashlib.sha256(spec.encode()).hexdigest(), spark.sparkContext.broadcast(spec))
    kinds = _Same("kinds", spark.sparkContext.broadcast(classes()))
    schema = OBJECTS.format(dict(docs.dtypes)["doc_id"])
    names = [x.split()[0] for x in schema.split(", ")]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, seen, pack = _encoder(shared, kinds), set(), zstandard.ZstdCompressor(1)
        task, row = TaskContext.get().partitionId(), 0
        for batch in batches(it, BATCH_BYTES):
            ids, at = with_ends(*encoder(*text_buffer(batch.column("text"))))
            docs_of, chunks, marks, narrow = ([], [], [], [], []), ([], [], []), chunk_marks(ids), ids.astype("<u2")
            raw = memoryview(ids).cast("B")
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                last, digests, lengths = a, [], []
                for end in chunk_ends(a, b, marks):
                    part = raw[4 * last : 4 * end]
                    digest = hashlib.sha256(part).digest()
                    if digest not in seen:
                        if len(seen) > 300_000:  # a later copy is then given by this task again, and dropped with those of other tasks
                            seen.clear()
                        seen.add(digest)
                        wide = bool(ids[last:end].max() > 0xFFFF)
                        payload = pack.compress(part if wide else narrow[last:end])
                        for column, value in zip(chunks, (digest, payload, wide), strict=True):
                            column.append(value)
                    digests.append(digest)
                    lengths.append(end - last)
                    last = end
                name = b"recipe" + task.to_bytes(8, "big") + row.to_bytes(8, "big")  # shorter than a digest
                row += 1
                for column, value in zip(docs_of, (name, b - a, merkle(digests), digests, lengths), strict=True):
                    column.append(value)
            n, k = len(docs_of[0]), len(chunks[0])
            yield pa.RecordBatch.from_arrays([
                pa.array(docs_of[0] + chunks[0], pa.binary()),
                pa.concat_arrays([batch.column("doc_id"), pa.nulls(k, batch.column("doc_id").type)]),
                pa.array(docs_of[1] + [None] * k, pa.int64()),
                pa.array(docs_of[2] + [None] * k, pa.binary()),
                pa.array(docs_of[3] + [None] * k, pa.list_(pa.binary())),
                pa.array(docs_of[4] + [None] * k, pa.list_(pa.int32())),
                pa.array([None] * n + chunks[1], pa.binary()),
                pa.array([None] * n + chunks[2], pa.bool_()),
                pa.array(["recipe"] * n + ["chunk"] * k),
            ], names)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, schema)


def objects(spark: SparkSession, path: str, kind: str, id_type: str = "long") -> DataFrame:
    return spark.read.schema(OBJECTS.format(id_type)).parquet(f"{path}/objects").filter(F.col("kind") == kind)


def write_store(docs: DataFrame, path: str, tokenizer: str | None = None) -> str:
    """Encode the texts, each with END_ID after it, and write the three tables under `path`.

    Chunks and recipes come from one pass and one shuffle by key, which drops what several tasks gave; the payloads are
    written once, where they stay. The recipes, a small part of it, are then put in order.
    """
    spark, id_type = docs.sparkSession, dict(docs.dtypes)["doc_id"]
    encode(docs, tokenizer or default_tokenizer()).dropDuplicates(["key"]).write.partitionBy("kind").parquet(f"{path}/objects")

    made = objects(spark, path, "recipe", id_type).select("key", "doc_id", "n_tokens", "root", "digests", "lengths")
    order = [F.col("doc_id").asc_nulls_first(), F.col("root"), F.col("key")]  # the key splits rows that repeat
    made = ranged(made, order, "ranged")
    totals = made.groupBy("_range").agg(F.count("*").alias("_rows"), F.sum("n_tokens").alias("_ids"))
    before = Window.orderBy("_range")  # one row a range, not a document
    totals = totals.select("_range", *[(F.sum(c).over(before) - F.col(c)).alias(c) for c in ("_rows", "_ids")])
    own = Window.partitionBy("_range").orderBy(*order)
    recipes = (
        made.withColumn("position", F.row_number().over(own) - 1)
        .withColumn("start", F.sum("n_tokens").over(own.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
        .join(F.broadcast(totals), "_range")
        .select("doc_id", (F.col("position") + F.col("_rows")).alias("position"), (F.col("start") + F.col("_ids")).alias("start"), "n_tokens", "root", "digests", "lengths")
    )
    recipes.write.parquet(f"{path}/recipes")
    delete(spark, f"{path}/objects/kind=recipe")
    remove(made)
    write_manifest(spark, path)
    return path


def _parents(nodes: DataFrame) -> DataFrame:
    """The nodes (level, node, digest) above nodes of one or more levels: each hashes up to FANOUT of the level below."""
    own = nodes.groupBy((F.col("level") + 1).alias("level"), F.expr(f"node div {FANOUT}").alias("parent")).agg(F.sort_array(F.collect_list(F.struct("node", "digest"))).alias("own"))  # FANOUT entries at most
    return own.select("level", F.col("parent").alias("node"), F.sha2(F.array_join("own.digest", ""), 256).alias("digest"))


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    digest = F.sha2(F.concat("root", F.encode(F.col("n_tokens").cast("string"), "UTF-8")), 256)
    return spark.read.parquet(f"{path}/recipes").select(F.lit(-1).alias("level"), F.col("position").alias("node"), digest.alias("digest"))


def write_manifest(spark: SparkSession, path: str) -> None:
    """The tree over (root, n_tokens) of the recipes in order; each level is made from the one below until one node is left."""
    below, level = _leaves(spark, path), 0
    while True:
        nodes = _parents(below).select("level", "node", (F.col("node") * FANOUT ** (level + 1)).alias("first_position"), "digest")
        nodes.write.mode("append").parquet(f"{path}/manifest")
        below = spark.read.parquet(f"{path}/manifest").filter(F.col("level") == level).select("level", "node", "digest")
        if below.limit(2).count() < 2:
            return
        level += 1


def verify_manifest(spark: SparkSession, path: str) -> DataFrame:
    """(level, node) of the manifest's nodes that are missing, superfluous or not the hash of what lies below them: none in a sound store.

    Each level is held against the stored level below it, the lowest against the recipes, so a fault shows where it is.
    """
    stored = spark.read.parquet(f"{path}/manifest").select("level", "node", "digest")
    top = stored.groupBy("level").agg(F.count("*").alias("n")).agg(F.max(F.struct("level", "n")).alias("t")).first()["t"]
    whole = top is not None and top["n"] == 1  # then the last level is the root, with nothing above it
    below = _leaves(spark, path).unionByName(stored.filter(F.col("level") < top["level"]) if whole else stored)
    made = _parents(below).withColumnRenamed("digest", "made")
    return made.join(stored, ["level", "node"], "full_outer").filter(~F.col("made").eqNullSafe(F.col("digest"))).select("level", "node")


def unproven(spark: SparkSession, path: str) -> DataFrame:
    """(leaf) of the lowest nodes with a fault on their way to the root."""
    bad = cut(verify_manifest(spark, path), "faults")
    levels = (spark.read.parquet(f"{path}/manifest").agg(F.max("level")).first()[0] or 0) + 2
    leaves = _leaves(spark, path).select(F.expr(f"node div {FANOUT}").alias("leaf")).distinct()
    way = leaves.select("leaf", F.posexplode(F.array(*[F.expr(f"leaf div {FANOUT**k}L") for k in range(levels)])).alias("level", "node"))
    return way.join(bad, ["level", "node"], "left_semi").select("leaf").distinct()


#: the CRC-32 polynomial of zlib, bits reversed: a fixed value
CRC_POLY = np.uint64(0xEDB88320)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of polynomials modulo CRC_POLY, bit-reversed as in zlib."""
    out, b = np.zeros_like(a), b.copy()
    for k in range(31, -1, -1):
        out ^= np.where((a >> np.uint64(k)) & np.uint64(1), b, np.uint64(0))
        b = (b >> np.uint64(1)) ^ np.where(b & np.uint64(1), CRC_POLY, np.uint64(0))
    return out


@lru_cache(1)
def _squares() -> list[np.ndarray]:
    out = [np.array([1 << 23], np.uint64)]  # x to the 8th: one byte
    while len(out) < 48:
        out.append(_times(out[-1], out[-1]))
    return out


def shift_crc(crc: np.ndarray, n_bytes: np.ndarray) -> np.ndarray:
    """What each CRC-32 adds, by exclusive or, to that of a whole in which n_bytes follow it."""
    out = crc.astype(np.uint64)
    for k, power in enumerate(_squares()):
        on = (n_bytes >> k) & 1 == 1
        if on.any():
            out[on] = _times(out[on], np.broadcast_to(power, int(on.sum())))
        if not (n_bytes >> k).any():
            break
    return out


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Each chunk read from its file: digest, n, ids (little-endian unsigned 32-bit), crc, sound (the bytes have that digest)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in it:
            rows = []
            for digest, payload, wide in zip(*(batch.column(c).to_pylist() for c in ("key", "payload", "wide")), strict=True):
                ids = np.frombuffer(unpack.decompress(payload), "<u4" if wide else "<u2").astype("<u4").tobytes()
                rows.append((digest, len(ids) // 4, ids, zlib.crc32(ids), hashlib.sha256(ids).digest() == digest))
            made = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(made, (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.bool_()), strict=True)], ["digest", "n", "ids", "crc", "sound"])

    return objects(spark, path, "chunk").select("key", "payload", "wide").mapInArrow(run, "digest binary, n long, ids binary, crc long, sound boolean")


def recipe_parts(spark: SparkSession, path: str) -> DataFrame:
    """The recipes by chunk: position, idx, digest, n, after (bytes of the document's later chunks), rooted (the digests lead to the root)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            cols = {k: [] for k in ("position", "idx", "digest", "n", "after", "rooted")}
            for position, root, digests, lengths in zip(*(batch.column(c).to_pylist() for c in ("position", "root", "digests", "lengths")), strict=True):
                left, rooted = sum(lengths), merkle(digests) == root
                for k, (d, n) in enumerate(zip(digests, lengths, strict=True)):
                    left -= n
                    for c, v in zip(cols, (position, k, d, n, 4 * left, rooted), strict=True):
                        cols[c].append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(cols.values(), (pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.bool_()), strict=True)], list(cols))

    schema = "position long, idx int, digest binary, n long, after long, rooted boolean"
    return spark.read.parquet(f"{path}/recipes").select("position", "root", "digests", "lengths").mapInArrow(run, schema)


def reconstruct(spark: SparkSession, path: str, positions: DataFrame | None = None) -> DataFrame:
    """(position, doc_id, start, ids) of all documents, or of those whose `position` is in a table, put together from the chunk files."""
    recipes, parts = spark.read.parquet(f"{path}/recipes"), recipe_parts(spark, path)
    if positions is not None:
        parts, recipes = parts.join(positions, "position", "left_semi"), recipes.join(positions, "position", "left_semi")
    ids = parts.select("position", "idx", "digest").join(read_chunks(spark, path).select("digest", "ids"), "digest")
    ids = ids.groupBy("position").agg(F.array_sort(F.collect_list(F.struct("idx", F.hex("ids").alias("ids")))).alias("own"))
    return recipes.join(ids, "position").select("position", "doc_id", "start", F.unhex(F.array_join("own.ids", "")).alias("ids"))


def store_digests(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids_crc32, n_chunks, verified.

    Every chunk file is read, its bytes held against its digest, the recipe's digests against its Merkle root, and that
    root against the manifest up to its own root: a document is verified if all of these hold.
    The CRC-32 of a document is put together from those of its chunks, so no ids are shuffled.
    """

    def shift(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            crc, after = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("crc", "after"))
            yield pa.RecordBatch.from_arrays([batch.column("position"), pa.array(shift_crc(crc, after).astype(np.int64)), batch.column("n"), batch.column("good")], ["position", "term", "n", "good"])

    parts, chunks = recipe_parts(spark, path), read_chunks(spark, path).select("digest", F.col("n").alias("stored"), "crc", "sound")
    joined = parts.join(chunks, "digest").select("position", "crc", "after", "n", (F.col("sound") & F.col("rooted") & (F.col("n") == F.col("stored"))).alias("good"))
    read = joined.mapInArrow(shift, "position long, term long, n long, good boolean").groupBy("position")
    read = read.agg(F.expr("bit_xor(term)").alias("ids_crc32"), F.sum("n").alias("_n"), F.count("*").alias("n_chunks"), F.min("good").alias("_good"))
    recipes = spark.read.parquet(f"{path}/recipes").select("doc_id", "position", "start", "n_tokens", F.size("digests").alias("_size"))
    faulty = cut(unproven(spark, path), "unproven").withColumn("_faulty", F.lit(True))
    good = F.col("_good") & (F.col("_n") == F.col("n_tokens")) & (F.col("_size") == F.col("n_chunks")) & F.col("_faulty").isNull()
    recipes = recipes.withColumn("leaf", F.expr(f"position div {FANOUT}")).join(faulty, "leaf", "left")
    return recipes.join(read, "position", "left").select("doc_id", "start", F.col("_n").alias("n_tokens"), "ids_crc32", "n_chunks", F.coalesce(good, F.lit(False)).alias("verified"))


def token_store(docs: DataFrame, path: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write a store of these documents and return what is read back from its files (see store_digests).

    A null text counts as empty: END_ID alone. Rows are ordered by doc_id, nulls first; repeated rows each get their
    own place, in the order of their Merkle roots. An empty table gives an empty store. Other columns are ignored.
    """
    spark = docs.sparkSession
    return store_digests(spark, write_store(docs.select("doc_id", "text"), path or new_path(spark, "store"), tokenizer))


def op3_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store(table(spark, sf_dir, "documents"))
