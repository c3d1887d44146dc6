"""Deduplicating chunks against an index and packing the new ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import fold


def dedup_index(refs: DataFrame) -> DataFrame:
    """(digest, pack_digest, index_offset): where each digest lies, by its first reference in file then chunk order.

    `refs` has file_id, chunk_idx, digest, pack_digest and offset (in that pack).
    """
    first = F.min(F.struct("file_id", "chunk_idx", "pack_digest", "offset")).alias("f")
    return refs.groupBy("digest").agg(first).select("digest", F.col("f.pack_digest").alias("pack_digest"), F.col("f.offset").alias("index_offset"))


def pack_sizes(layers: DataFrame) -> DataFrame:
    """(pack_digest, size) of pack layers (pack_digest, layer_idx, size): the last layer of a digest counts."""
    return layers.groupBy("pack_digest").agg(F.max_by("size", "layer_idx").alias("size"))


def classify(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """Adds `reused` and the location in the index, pack_digest and index_offset. The index is only read: a new digest that occurs twice stays new twice."""
    rows = chunks.join(index.select("digest", "pack_digest", "index_offset"), "digest", "left")
    return rows.withColumn("reused", F.col("pack_digest").isNotNull())


def plan_packs(chunks: DataFrame, pack_size: int) -> DataFrame:
    """(file_id, chunk_idx, digest, size, reused, pack_digest, pack_idx, pack_offset) by file in chunk order.

    A reused chunk keeps its pack and offset of the index; a new one has the number of a new pack of its file, and its
    offset there: just one of pack_digest and pack_idx is set. A new chunk joins the open pack, which closes once it
    holds pack_size or more; what it holds above that isn't carried over, so this is a fold over the ordered chunks and
    not a running sum. The chunks of one file are folded in one task, in time proportional to their number.
    """
    item = F.struct("chunk_idx", "digest", "size", "reused", "pack_digest", "index_offset")
    ordered = chunks.groupBy("file_id").agg(F.array_sort(F.collect_list(item)).alias("items"))
    kind = "struct<chunk_idx:bigint,digest:string,size:bigint,reused:boolean,pack_digest:string,pack_idx:bigint,pack_offset:bigint>"

    def step(now: Column, x: Column) -> tuple[Column, Column]:
        full = now["held"] + x["size"] >= pack_size
        row = F.struct(
            x["chunk_idx"].alias("chunk_idx"), x["digest"].alias("digest"), x["size"].alias("size"), x["reused"].alias("reused"), x["pack_digest"].alias("pack_digest"),
            F.when(~x["reused"], now["pack"]).alias("pack_idx"), F.when(x["reused"], x["index_offset"]).otherwise(now["held"]).alias("pack_offset"),
        )
        held = F.when(x["reused"], now["held"]).when(full, F.lit(0).cast("long")).otherwise(now["held"] + x["size"])
        return F.struct(held.alias("held"), F.when(~x["reused"] & full, now["pack"] + 1).otherwise(now["pack"]).alias("pack")), F.array(row)

    zero = F.struct(F.lit(0).cast("long").alias("held"), F.lit(0).cast("long").alias("pack"))
    return ordered.select("file_id", F.inline(fold(F.col("items"), zero, "struct<held:bigint,pack:bigint>", step, kind)))


def heal(chunks: DataFrame, refs: DataFrame, lost: list[DataFrame], pack_size: int) -> DataFrame:
    """The plan after packs were found lost: each table of lost packs (pack_digest) is one failed attempt, what was lost
    before stays excluded, and the chunks that lay in lost packs are packed anew."""
    gone = lost[0].select("pack_digest")
    for more in lost[1:]:
        gone = gone.unionByName(more.select("pack_digest"))
    kept = refs.join(gone.distinct(), "pack_digest", "left_anti")
    return plan_packs(classify(chunks, dedup_index(kept)), pack_size)


def pack_contents(planned: DataFrame) -> DataFrame:
    """(file_id, pack_idx, size, n_chunks, digest, content) of each new pack, from planned chunks with their payload: the bytes in order, and their SHA-256."""
    packs = planned.groupBy("file_id", "pack_idx").agg(F.sum("size").alias("size"), F.count("*").alias("n_chunks"), F.array_sort(F.collect_list(F.struct("pack_offset", F.hex("payload").alias("hex")))).alias("parts"))
    packs = packs.select("file_id", "pack_idx", "size", "n_chunks", F.unhex(F.array_join("parts.hex", "")).alias("content"))
    return packs.withColumn("digest", F.sha2("content", 256))


def pack_digests(planned: DataFrame, payloads: DataFrame) -> DataFrame:
    """(file_id, pack_idx, size, n_chunks, digest) of each new pack."""
    new = planned.filter("pack_idx is not null").join(payloads.select("file_id", "chunk_idx", "payload"), ["file_id", "chunk_idx"])
    return pack_contents(new).drop("content")


def reassemble(chunks: DataFrame, files: DataFrame) -> DataFrame:
    """(file_id, digest, size) of each of `files` (file_id) put together from its chunks in offset order; one without chunks is empty."""
    parts = F.array_sort(F.collect_list(F.struct("offset", F.hex("payload").alias("hex"))))
    whole = chunks.groupBy("file_id").agg(parts.alias("parts"), F.sum("size").alias("size"))
    joined = files.select("file_id").join(whole, "file_id", "left")
    return joined.select("file_id", F.sha2(F.unhex(F.coalesce(F.array_join("parts.hex", ""), F.lit(""))), 256).alias("digest"), F.coalesce("size", F.lit(0)).cast("long").alias("size"))
