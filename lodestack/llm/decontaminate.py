"""Operator 7: benchmark decontamination by size-partitioned MinHash containment search."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, cut, free_name, table
from .kernels import mix, roll, text_buffer, word_hashes

WIDTH, CONTAINED = 5, 0.8
#: items of so many shingles are searched by all of them; those of larger classes by a signature, which misses one of a million contained items
WHOLE, MISSED = 32, 1e-6
#: shingles of the items searched in one pass over the documents; more items take more passes
PASS_SHINGLES = 1 << 20
BATCH_BYTES = 1 << 18


def signature(size: int, contained: float) -> tuple[int, int]:
    """(samples of an item in the class of at most `size` shingles, how many of them a document must have).

    Larger items cost more to verify, so their signatures are longer and turn more away: 8 samples for each doubling.
    An item contained to the least degree has fewer of them with a probability of at most MISSED.
    """
    n = WHOLE // 2 + 8 * (size.bit_length() - (WHOLE // 2).bit_length())
    need, tail = 0, 0.0
    while need < n:
        tail += math.comb(n, need) * contained**need * (1 - contained) ** (n - need)
        if tail > MISSED:
            break
        need += 1
    return n, max(1, need)


class Items:
    """Search structure of one block of items, by size class (powers of two of distinct shingles).

    An item's MinHash signature names the shingle that is least under each of a number of hash functions. A document's
    own signature would drown a short item, so the search asks which of the item's sampled shingles the document has:
    each is there with the probability of the item's containment, whatever the document's length. Length and threshold
    of the signature are those of the item's class. Items of fewer words than a shingle are one run of all their words,
    searched among the document's runs of as many words.
    """

    def __init__(self, ids: list[int], sets: list[np.ndarray], lengths: list[int], width: int, contained: float):
        self.ids, self.sets, self.width, self.contained, self.classes = ids, sets, width, contained, []
        of: dict[int, list[int]] = {}
        runs: dict[int, list[int]] = {}
        for k, (s, n) in enumerate(zip(sets, lengths, strict=True)):
            (runs if n < width else of).setdefault(n if n < width else max(WHOLE, 1 << int(len(s) - 1).bit_length()), []).append(k)
        self.runs = {n: (np.sort(own := np.array([sets[k][0] for k in members])), np.array(members)[np.argsort(own, kind="stable")]) for n, members in runs.items()}
        for size, members in sorted(of.items()):
            n, need = signature(size, contained)
            seeds = mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            picks = [sets[k] if size == WHOLE else sets[k][[int(mix(sets[k] ^ seed).argmin()) for seed in seeds]] for k in members]
            least = [max(1, math.ceil(contained * len(p) - 1e-9)) if size == WHOLE else need for p in picks]
            hashes = np.concatenate(picks)
            owner = np.repeat(np.arange(len(members)), [len(p) for p in picks])
            order = np.argsort(hashes, kind="stable")
            self.classes.append((np.array(members), hashes[order], owner[order], np.array(least)))
        every = np.unique(np.concatenate([c[1] for c in self.classes])) if self.classes else np.zeros(0, np.uint64)
        self.bits = max(16, int(len(every) * 16).bit_length())  # a bitmap turns nearly all other shingles away
        self.filter = np.zeros(1 << self.bits, bool)
        self.filter[every >> np.uint64(64 - self.bits)] = True

    def search_all(self, data: np.ndarray, offsets: np.ndarray) -> list[list[tuple[int, int, int]]]:
        """For each document (index of item, its shingles in the document, its shingles) of the items that it contains."""
        hashes, first = word_hashes(data, offsets)
        rolled = roll(hashes, self.width)
        short = {n: np.isin(roll(hashes, n), own) for n, (own, _) in self.runs.items()}
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            found = self._search(rolled[a : b - self.width + 1]) if b - a >= self.width else []
            for n, (own, members) in self.runs.items():
                at = np.flatnonzero(short[n][a : max(a, b - n + 1)]) + a
                if len(at):
                    found += [(int(members[k]), 1, 1) for h in np.unique(roll(hashes[a:b], n)[at - a]) for k in range(int(np.searchsorted(own, h, "left")), int(np.searchsorted(own, h, "right")))]
            out.append(found)
        return out

    def _search(self, document: np.ndarray) -> list[tuple[int, int, int]]:
        near = document[self.filter[document >> np.uint64(64 - self.bits)]]
        if not len(near):
            return []
        near, whole, out = np.unique(near), None, []
        for members, hashes, owner, need in self.classes:
            low, high = np.searchsorted(hashes, near, "left"), np.searchsorted(hashes, near, "right")
            n = high - low
            if not n.any():
                continue
            at = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            hits = np.bincount(owner[at], minlength=len(members))
            for j in np.flatnonzero(hits >= need):
                whole = np.unique(document) if whole is None else whole
                own = self.sets[members[j]]
                both = len(np.intersect1d(own, whole, assume_unique=True))
                if both >= self.contained * len(own) - 1e-9:
                    out.append((int(members[j]), both, len(own)))
        return out


def item_blocks(items: DataFrame, width: int, contained: float, most: int) -> Iterator[Items]:
    """The items in blocks of at most `most` shingles (one item at least), read by ranges of a hash so that the driver holds one block at a time.

    Items of one id count as one: all their texts are searched and the best counts. Items with a null id or text or
    without a word are not searched; one of fewer words than `width` is one run of them.
    """
    words = F.size(F.split(F.trim("text"), r"\s+"))
    rows = items.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text"))
    total = rows.agg(F.sum(words)).first()[0] or 0
    parts = max(1, -(-2 * total // most))
    rows = rows.withColumn("_part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    for part in range(parts):
        ids, sets, lengths = [], [], []
        for r in rows.filter(F.col("_part") == part).orderBy("item_id", "text").collect():
            raw = np.frombuffer(r.text.encode(), np.uint8)
            hashes, _ = word_hashes(raw, np.array([0, len(raw)]))
            if len(hashes):
                ids.append(r.item_id)
                sets.append(np.unique(roll(hashes, min(width, len(hashes)))))
                lengths.append(len(hashes))
        if ids:
            yield Items(ids, sets, lengths, width, contained)


def _search_pass(docs: DataFrame, block: Items) -> DataFrame:
    """One pass of all documents against one block: the rows with hits, with `hits` (item_id, shared, of) beside their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(block)  # at most PASS_SHINGLES shingles and their samples

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches(it, BATCH_BYTES):
            rows = []
            for found in own.search_all(*text_buffer(batch.column("text"))):
                best: dict[int, tuple[int, int]] = {}
                for k, both, of in found:
                    item = own.ids[k]
                    if item not in best or both * best[item][1] > best[item][0] * of:
                        best[item] = (both, of)
                rows.append([{"item_id": i, "shared": b, "of": n} for i, (b, n) in sorted(best.items())])
            keep = pa.array([bool(r) for r in rows])
            hits = pa.array(rows, pa.list_(pa.struct([("item_id", pa.int64()), ("shared", pa.int32()), ("of", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("key"), hits], ["doc_id", "key", "hits"]).filter(keep)

    return docs.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, key long, hits array<struct<item_id:long,shared:int,of:int>>")


def contaminated(docs: DataFrame, items: DataFrame, width: int = WIDTH, contained: float = CONTAINED, most: int = PASS_SHINGLES) -> DataFrame:
    """(doc_id, key, hits): each row whose text holds at least `contained` of the distinct shingles of an item (words of
    letters and digits, in lower case), with the items; `key` is a hash of the row's id and text."""
    rows = docs.select("doc_id", F.xxhash64(F.lit("row"), "doc_id", "text").alias("key"), F.lower("text").alias("text"))
    found = None
    for block in item_blocks(items, width, contained, most):
        own = _search_pass(rows, block)
        found = own if found is None else found.unionByName(own)
    if found is None:
        found = rows.filter("false").select("doc_id", "key", F.array().cast("array<struct<item_id:bigint,shared:int,of:int>>").alias("hits"))
    return found


def contamination_report(docs: DataFrame, items: DataFrame, width: int = WIDTH, contained: float = CONTAINED) -> DataFrame:
    """One row for each pair of a document and an item found in it: doc_id, item_id, shared, item_shingles, containment.

    Only such pairs are returned, so clean documents have no row. An item of fewer words than `width` is in a document
    if all its words stand there one after the other. Null and empty texts match nothing; repeated rows report once; a document with a null doc_id is reported under null; several
    texts under one id report the best match; an empty table gives an empty result; other columns are ignored.
    """
    pairs = contaminated(docs, items, width, contained).select("doc_id", F.explode("hits").alias("h")).select("doc_id", "h.*")
    best = pairs.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("shared") / F.col("of")).alias("containment"), "shared", "of")).alias("b"))
    return best.select("doc_id", "item_id", F.col("b.shared").alias("shared"), F.col("b.of").alias("item_shingles"), F.col("b.containment").alias("containment"))


def clean_documents(docs: DataFrame, items: DataFrame, width: int = WIDTH, contained: float = CONTAINED) -> DataFrame:
    """The documents that hold no item, with all their columns as they are: a filter inside the pass itself, one pass for each block of items.

    Null and empty texts hold nothing and stay, as do rows with a null doc_id and all of repeated rows whose text is
    clean; columns of any name are kept; an empty table stays empty.
    """
    for block in item_blocks(items, width, contained, PASS_SHINGLES):
        docs = _clean_pass(docs, block)
    return docs


def _clean_pass(docs: DataFrame, block: Items) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)
    names, lowered = docs.columns, free_name(docs.columns, "lowered")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches(it, BATCH_BYTES, lowered):
            keep = [not found for found in own.search_all(*text_buffer(batch.column(lowered)))]
            yield batch.select(names).filter(pa.array(keep))

    return docs.withColumn(lowered, F.lower("text")).mapInArrow(run, docs.schema)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), cut(table(spark, sf_dir, "benchmark").select("item_id", "text"), "items"))
