"""Operator 10: byte-level BPE encoding and decoding through a minimal acyclic transducer lexicon."""

from __future__ import annotations

import hashlib
import json
import os
import tempfile
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import batches, cut, give_back, table
from .kernels import span_hashes, text_buffer
from .pretokens import Encoder, classes, pieces, split_special
from .transducer import Transducer, compile_words

BATCH_BYTES = 1 << 20


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable bytes for themselves, the rest from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class ByteBPE:
    """The merge table of a byte-level BPE file."""

    def __init__(self, text: str):
        spec = json.loads(text)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        self.single = [0] * 256
        for letter, b in letters.items():
            self.single[b] = vocab[letter]
        self.merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.merges[(vocab[left], vocab[right])] = (rank, vocab[left + right])
        self.letter = np.array(self.single, np.int64)
        self.size = 1 + max(vocab.values())
        pairs = sorted((a * self.size + b, *to) for (a, b), to in self.merges.items())
        self.pairs, self.ranks, self.made = (np.array(c, np.int64) for c in zip(*pairs, strict=True))
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in vocab.items() if all(c in letters for c in token)}
        self.bytes_of |= {i: c.encode() for c, i in self.special.items()}

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest-ranked adjacent pair first, leftmost of equals, until none is in the table."""
        ids, merges, none = [self.single[b] for b in word], self.merges, (1 << 60, 0)
        while len(ids) > 1:
            rank, new, k = min((*merges.get(pair, none), k) for k, pair in enumerate(zip(ids, ids[1:])))  # noqa: B905
            if rank == none[0]:
                break
            ids[k : k + 2] = [new]
        return ids

    def merge_long(self, word: bytes) -> list[int]:
        """The same result for long words, with a heap of pairs in place of repeated scans."""
        import heapq

        ids, merges, n = [self.single[b] for b in word], self.merges, len(word)
        left, right, alive = [*range(-1, n - 1)], [*range(1, n + 1)], [True] * n
        heap = [(*merges[p], k, p) for k, p in enumerate(zip(ids, ids[1:])) if p in merges]  # noqa: B905
        heapq.heapify(heap)
        while heap:
            _, new, k, pair = heapq.heappop(heap)
            j = right[k] if alive[k] else n
            if j >= n or (ids[k], ids[j]) != pair:
                continue
            ids[k], alive[j], right[k] = new, False, right[j]
            if right[j] < n:
                left[right[j]] = k
            for a, b in ((left[k], k), (k, right[k])):
                if 0 <= a and b < n and (p := (ids[a], ids[b])) in merges:
                    heapq.heappush(heap, (*merges[p], a, p))
        return [i for i, on in zip(ids, alive, strict=True) if on]

    def _find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the sorted merge table, or -1."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, at, -1)

    def merge_all(self, words: list[bytes]) -> list:
        """The ids of each word. Each round makes one merge, the lowest-ranked and leftmost, in every short word at once."""
        out: list = [self.merge_long(w) if len(w) > 64 else [] for w in words]
        word = np.array([k for k, w in enumerate(words) if 0 < len(w) <= 64], np.int64)
        if not len(word):
            return out
        ids = self.letter[np.frombuffer(b"".join(words[k] for k in word.tolist()), np.uint8)]
        size, none = np.array([len(words[k]) for k in word.tolist()]), 1 << 62
        found = np.r_[self._find(ids[:-1], ids[1:]), -1]
        found[np.cumsum(size) - 1] = -1  # no pair crosses words
        while len(word):
            starts = np.cumsum(size) - size
            least = np.minimum.reduceat(np.where(found >= 0, (self.ranks[found] << 32) + np.arange(len(ids)), none), starts)
            ready = least == none
            if ready.any():
                done = np.repeat(ready, size)
                own, ends = ids[done], np.cumsum(size[ready]).tolist()
                for k, a, b in zip(word[ready].tolist(), [0, *ends], ends):  # noqa: B905
                    out[k] = own[a:b]
            at = least[~ready] & 0xFFFFFFFF
            ids[at] = self.made[found[at]]
            last = at + 2 == (starts + size)[~ready]  # the merged pair ends its word
            after = np.minimum(at + 2, len(ids) - 1)
            found[at] = np.where(last, -1, self._find(ids[at], ids[after]))
            inner = at[at > starts[~ready]]
            found[inner - 1] = self._find(ids[inner - 1], ids[inner])
            keep = np.repeat(~ready, size)
            keep[at + 1] = False
            ids, found, word, size = ids[keep], found[keep], word[~ready], size[~ready] - 1
        return out

    def decode(self, ids: list[int]) -> str:
        """Unknown ids add nothing; bytes that aren't UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.get, ids)).decode("utf-8", "replace")


def word_counts(docs: DataFrame, kinds, special: dict[str, int]) -> DataFrame:
    """(word, n) of every piece of every text; each task counts its own first."""

    def count(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.binary()), "n": pa.array(list(seen.values()), pa.int64())})

        for batch in batches(it, BATCH_BYTES):
            data, offsets = text_buffer(batch.column("text"))
            cuts, found = split_special(data, offsets, special)
            starts = pieces(data, cuts, kinds.value)
            if not len(starts):
                continue
            ends = np.r_[starts[1:], len(data)]
            where, keys = pd.factorize(span_hashes(data, starts, ends))
            first = np.empty(len(keys), np.int64)
            first[where[::-1]] = np.arange(len(where))[::-1]
            raw, counts = data.tobytes(), np.bincount(where, minlength=len(keys)).tolist()
            for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), counts, strict=True):
                if b - a <= 64:  # longer words are merged when met
                    seen[raw[a:b]] = seen.get(raw[a:b], 0) + n
            if len(seen) > 400_000:
                yield out()
                seen.clear()
        yield out()

    return docs.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, bpe: ByteBPE, kinds, size: int) -> bytes:
    """The most frequent words that occur twice or more, compiled: at most `size`, none of those whose count would make it more.

    How many words have each count settles the least count to take, so the driver gets the lexicon's words only.
    """
    counts = cut(word_counts(docs, kinds, bpe.special).filter("n > 1"), "word_counts")
    held = F.sum("words").over(Window.orderBy(F.desc("n")))  # over the distinct counts, not the words: n words in all have fewer than the root of 2n counts
    least = counts.groupBy("n").agg(F.count("*").alias("words")).select("n", held.alias("held")).filter(F.col("held") <= size).agg(F.min("n")).first()[0]
    words = [] if least is None else [bytes(r[0]) for r in counts.filter(F.col("n") >= least).select("word").collect()]
    return compile_words({w: list(map(int, ids)) for w, ids in zip(words, bpe.merge_all(words), strict=True)})


@lru_cache(1)
def _merges(spec: str) -> ByteBPE:
    """The merge table, kept by each Python worker: its size is the tokenizer's."""
    return ByteBPE(spec)


def _encoder(spec: str, lexicon: bytes, kinds: np.ndarray) -> tuple[Encoder, list[bytes]]:
    """An encoder for one task: the lexicon is mapped from a file of the worker's own. It goes with the task, as workers live on and serve later stages too."""
    bpe = _merges(spec)
    with tempfile.NamedTemporaryFile("wb", suffix=".fst", delete=False) as f:
        f.write(lexicon)
    known = Transducer(f.name)
    os.unlink(f.name)  # the map stays

    def encode(words: list[str]) -> list:
        raw = [w.encode() for w in words]
        out = known.get_all(raw)
        unseen = [k for k, ids in enumerate(out) if ids is None]
        for k, ids in zip(unseen, bpe.merge_all([raw[k] for k in unseen]), strict=True):
            out[k] = ids
        return out

    size = max(bpe.bytes_of, default=0) + 1
    return Encoder(encode, bpe.special, kinds), [bpe.bytes_of.get(i, b"") for i in range(size)]


def bpe_round_trip(docs: DataFrame, tokenizer: str | None = None, lexicon_words: int = 65_536, ids: bool = False) -> DataFrame:
    """Encode every whole text and decode the ids again.

    Returns doc_id, n_tokens, ids_sha256, decoded_sha256, and with `ids` also ids (binary, little-endian unsigned
    32-bit) and decoded (string). A null text counts as empty: no ids and empty text. Repeated rows give repeated
    rows, a null doc_id stays null, an empty table gives an empty result, other columns are ignored. Words outside
    the lexicon, of any length, are merged exactly, so the lexicon's size changes speed only.
    """
    spark = docs.sparkSession
    with open(tokenizer or default_tokenizer(), encoding="utf-8") as f:
        spec = f.read()
    bpe, kinds = ByteBPE(spec), spark.sparkContext.broadcast(classes())
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    lexicon = build_lexicon(docs, bpe, kinds, lexicon_words)
    shared = [*map(spark.sparkContext.broadcast, (spec, lexicon)), kinds]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, token = _encoder(*(x.value for x in shared))
        for batch in batches(it, BATCH_BYTES):
            all_ids, at = encoder(*text_buffer(batch.column("text")))
            all_ids, rows = all_ids.astype("<u4"), []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
                own = all_ids[a:b]
                text = b"".join(map(token.__getitem__, own.tolist())).decode("utf-8", "replace")
                raw = own.tobytes()
                rows.append((b - a, hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest(), *((raw, text) if ids else ())))
            made = list(zip(*rows, strict=True))
            kinds_of = (pa.int64(), pa.string(), pa.string(), pa.binary(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(made, kinds_of))], names)  # noqa: B905
        del encoder
        give_back()

    schema = "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string".format(dict(docs.dtypes)["doc_id"]) + ", ids binary, decoded string" * ids
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.mapInArrow(run, schema)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"))
