"""Operator 5: language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import batches, held_out, table
from .kernels import text_buffer
from .sampling import bounded_sample

#: longest context in bytes; the training sample's bounds: documents of a language, and of all languages together
ORDER, SAMPLE_DOCS, MOST_DOCS = 4, 250, 16_000
BATCH_BYTES = 1 << 17
UNDETERMINED = "und"
EDGE = 10  # the byte before a text's first: as after a line end


class PPM:
    """Context trees of several languages with frozen counts, compiled to tables of code lengths.

    Escape is by method C without exclusions: a context seen n times before d distinct bytes codes a byte seen c
    times in c / (n + d) and escapes in d / (n + d) to the context one byte shorter; the empty context escapes to
    1 / 256. A context that a language never saw costs nothing to leave. A context's branch is only in the tree if
    its own context occurred at least twice, so the order varies.

    For each order k there are the sorted grams of k + 1 bytes seen in any language, with a row of code lengths in
    bits by language (backing off where a language hasn't seen the gram), and the sorted contexts of k bytes with a
    row of escape lengths. Scoring looks a position up from the longest order down until some language has seen its
    gram; escapes on the way add up.
    """

    def __init__(self, texts: dict[str, list[bytes]]):
        self.names = sorted(texts)
        size = len(self.names)
        counts = [[self._grams(texts[name], k + 1) for name in self.names] for k in range(ORDER + 1)]
        self.tables = []
        below = None
        for k in range(ORDER + 1):
            grams = np.unique(np.concatenate([g for g, _ in counts[k]] or [np.zeros(0, np.uint64)]))
            contexts = np.unique(grams >> np.uint64(8))
            cost = np.zeros((len(grams), size))
            escape = np.zeros((len(contexts), size))
            backoff = self._cost(below, grams & np.uint64((1 << 8 * k) - 1)) if k else np.full((len(grams), size), 8.0)
            for i, (own, n) in enumerate(counts[k]):
                ctx, first = np.unique(own >> np.uint64(8), return_index=True)
                total = np.add.reduceat(n, first) if len(n) else n
                kinds = np.diff(np.r_[first, len(own)])
                deep = (total >= 2) | (k == 0)
                at = np.searchsorted(contexts, ctx)
                escape[at[deep], i] = np.log2((total + kinds) / kinds)[deep]
                cost[:, i] = backoff[:, i] + escape[np.searchsorted(contexts, grams >> np.uint64(8)), i]
                of = np.repeat(np.arange(len(ctx)), kinds)
                seen = deep[of]
                cost[np.searchsorted(grams, own[seen]), i] = np.log2((total + kinds)[of[seen]] / n[seen])
            below = [*(below or []), (grams, cost, contexts, escape)]
        self.tables = [(self._index(g), c.astype(np.float32), self._index(x), e.astype(np.float32)) for g, c, x, e in below]

    @staticmethod
    def _grams(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
        out = []
        for text in texts:
            raw = np.frombuffer(bytes([EDGE]) * (width - 1) + text, np.uint8)
            n = len(raw) - width + 1
            g = np.zeros(max(0, n), np.uint64)
            for j in range(width):
                g = (g << np.uint64(8)) | raw[j : j + n]
            out.append(g)
        return np.unique(np.concatenate(out), return_counts=True) if out else (np.zeros(0, np.uint64), np.zeros(0, np.int64))

    def _cost(self, tables: list, grams: np.ndarray) -> np.ndarray:
        """Code lengths of grams of the highest order among the tables, by each language."""
        k = len(tables) - 1
        keys, cost, contexts, escape = tables[k]
        at = np.minimum(np.searchsorted(keys, grams), len(keys) - 1) if len(keys) else np.zeros(len(grams), int)
        seen = keys[at] == grams if len(keys) else np.zeros(len(grams), bool)
        out = np.zeros((len(grams), len(self.names)))
        out[seen] = cost[at[seen]]
        rest = grams[~seen]
        if len(rest):
            add = np.full((len(rest), len(self.names)), 8.0) if k == 0 else self._cost(tables[:k], rest & np.uint64((1 << 8 * k) - 1))
            if len(contexts):
                c = np.minimum(np.searchsorted(contexts, rest >> np.uint64(8)), len(contexts) - 1)
                add += np.where((contexts[c] == rest >> np.uint64(8))[:, None], escape[c], 0)
            out[~seen] = add
        return out

    @staticmethod
    def _index(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        """A hash index of the keys: slots by the top bits of a product, collisions in the next slots."""
        bits = max(8, int(len(keys) * 3).bit_length())
        slots = np.full(1 << bits, -1, np.int32)
        shift = np.uint64(64 - bits)
        place = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64)
        left = np.arange(len(keys), dtype=np.int32)
        while len(left):
            p = place[left]
            free = slots[p] < 0
            slots[p[free]] = left[free]  # the last of several takes the slot
            left = left[slots[p] != left]
            place[left] = (place[left] + 1) & ((1 << bits) - 1)
        return keys, slots, shift

    @staticmethod
    def _find(index: tuple, keys: np.ndarray) -> np.ndarray:
        """Row of each key, or -1."""
        own, slots, shift = index
        out = np.full(len(keys), -1, np.int32)
        if not len(own):
            return out
        at, todo = ((keys * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int64), np.arange(len(keys))
        while len(todo):
            row = slots[at[todo]]
            used = row >= 0
            todo, row = todo[used], row[used]
            hit = own[row] == keys[todo]
            out[todo[hit]] = row[hit]
            todo = todo[~hit]
            at[todo] = (at[todo] + 1) & (len(slots) - 1)
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray, block: int = 1 << 16) -> np.ndarray:
        """Bits of each text under each language: an array of texts by languages. Positions are taken in blocks, so memory is bounded for texts of any length."""
        n, out = len(data), np.zeros((len(offsets) - 1, len(self.names)))
        inside = np.arange(n) - np.repeat(offsets[:-1], np.diff(offsets))
        padded = np.concatenate([np.full(ORDER, EDGE, np.uint8), data])
        for p in range(0, n, block):
            q = min(n, p + block)
            bits = self._block(padded[p : q + ORDER], inside[p:q])
            first = np.searchsorted(offsets, p, side="right") - 1
            inner = np.arange(first, np.searchsorted(offsets, q, side="left"))
            inner = inner[(np.diff(offsets)[inner] > 0)]
            out[inner] += np.add.reduceat(bits, np.maximum(offsets[inner] - p, 0), axis=0, dtype=np.float64)
        return out

    def _block(self, padded: np.ndarray, inside: np.ndarray) -> np.ndarray:
        """Bits of each position; padded has the ORDER bytes before the first one too, inside tells how far into its text a position lies."""
        n = len(inside)
        gram = np.zeros(n, np.uint64)
        for j in range(ORDER, -1, -1):
            byte = padded[ORDER - j : ORDER - j + n].astype(np.uint64)
            gram = (gram << np.uint64(8)) | (np.where(inside >= j, byte, np.uint64(EDGE)) if j else byte)
        bits, todo = np.zeros((n, len(self.names)), np.float32), np.arange(n)
        for k in range(ORDER, -1, -1):
            grams, cost, contexts, escape = self.tables[k]
            own = gram[todo] & np.uint64((1 << 8 * (k + 1)) - 1)
            row = self._find(grams, own)
            seen = row >= 0
            bits[todo[seen]] += cost[row[seen]]
            todo, own = todo[~seen], own[~seen]
            if not len(todo):
                break
            row = self._find(contexts, own >> np.uint64(8))
            known = row >= 0
            bits[todo[known]] += escape[row[known]]
        bits[todo] += 8.0
        return bits


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> PPM:
    """Context trees of every language that there is, from at most `sample_docs` documents of each (see bounded_sample), of those that may be learnt from."""
    rows = docs.filter(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    texts: dict[str, list[bytes]] = {}
    for text, lang in bounded_sample(rows, "lang", sample_docs, MOST_DOCS):
        texts.setdefault(lang, []).append(text.encode())
    return PPM(texts)


def identify(docs: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, bits_per_byte.

    The language with the least exact code length of the whole text; equal lengths go to the first by name. The score
    is that language's share if each language's weight is 2 to the minus its code length. `und` with score 0 for a
    null text, a text without a letter, and where nothing could be learnt. Learnt are all languages, from samples of
    bounded rows (SAMPLE_DOCS, MOST_DOCS) and of a long text its first 131,072 characters; predicted are whole texts. Null languages aren't learnt from; a null
    doc_id is held out; repeated rows are each predicted; other columns are ignored; an empty table gives an empty result.
    """
    model = docs.sparkSession.sparkContext.broadcast(learn(docs, sample_docs))  # bounded by the sample

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ppm = model.value
        for batch in batches(it, BATCH_BYTES):
            n = batch.num_rows
            data, offsets = text_buffer(batch.column("text"))
            named, score, rate = [UNDETERMINED] * n, np.zeros(n), [None] * n
            if ppm.names:
                bits = ppm.code_lengths(data, offsets)
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                score = 1.0 / np.exp2(np.maximum(least[:, None] - bits, -1000)).sum(axis=1)
                for k, known in enumerate(batch.column("lettered").to_pylist()):
                    if known:
                        named[k], rate[k] = ppm.names[best[k]], float(least[k] / max(1, offsets[k + 1] - offsets[k]))
                    else:
                        score[k] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(named), pa.array(score), pa.array(rate, pa.float64())], ["doc_id", "held_out", "lang_pred", "score", "bits_per_byte"])

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", F.coalesce(F.regexp_like("text", F.lit(r"\p{L}")), F.lit(False)).alias("lettered"))
    return rows.mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double, bits_per_byte double")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(table(spark, sf_dir, "documents"))
