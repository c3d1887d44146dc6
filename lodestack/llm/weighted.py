"""Weighted shingles and improved consistent weighted sampling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import batches
from .kernels import mix, shingles, text_buffer
from .tables import sum_tables

#: document counts of shingles are kept in this many hashed cells, twice over; what is counted doesn't change the size
CELLS = 1 << 17
BATCH_BYTES = 1 << 18
#: how much of a shingle's weight depends on how rare it is, and the share of all documents below which a shingle counts as rare
RARITY, RARE = 0.2, 0.001


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """(ascending distinct shingle hashes, how often each occurs) of each document."""
    return [np.unique(s, return_counts=True) for s in shingles(data, offsets, width)]


def _cells(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(47)).astype(np.int64), ((hashes >> np.uint64(20)) & np.uint64(CELLS - 1)).astype(np.int64) + CELLS


class Weights:
    """TF-IDF weights of shingles: (1 + ln tf) * (1 + RARITY * ln(N / df) / ln(1 / RARE)), the last factor 1 + RARITY at most.

    df is the smaller of two hashed cells' counts less their mean, the other shingles' part. Only shingles that a share
    of RARE or more of all N documents have weigh less than the rest; what a count must exceed is a share of N too, and
    a cell's noise shrinks against it as N grows, so weights do not drift with the size of the table.
    """

    def __init__(self, counts: np.ndarray, documents: int):
        self.documents = max(2, documents)
        idf = []
        for c in (counts[:CELLS], counts[CELLS:]):
            df = c - c.mean()
            least = max(RARE * self.documents, 4 * np.sqrt(c.mean()), 1)
            idf.append(np.where(df > least, np.log(self.documents / np.clip(df, 1, self.documents)) / np.log(1 / RARE), 1.0))
        self.idf = np.clip(np.concatenate(idf), 0, 1).astype(np.float32)

    def __call__(self, hashes: np.ndarray, tf: np.ndarray) -> np.ndarray:
        a, b = _cells(hashes)
        return (1 + np.log(tf)) * (1 + RARITY * np.maximum(self.idf[a], self.idf[b]))


def learn_weights(docs: DataFrame, width: int = 5) -> Weights:
    """Count the documents of each shingle over the whole table."""

    def count(it: Iterator[pa.RecordBatch]) -> np.ndarray:
        total = np.zeros(2 * CELLS + 1, np.int64)
        for batch in batches(it, BATCH_BYTES):
            own = [h for h, _ in shingle_sets(*text_buffer(batch.column("text")), width)]
            every = np.concatenate(own) if own else np.zeros(0, np.uint64)
            a, b = _cells(every)
            total[:-1] += np.bincount(np.concatenate([a, b]), minlength=2 * CELLS)
            total[-1] += batch.num_rows
        return total

    counts = sum_tables(docs.select("text"), count, 2 * CELLS + 1)
    return Weights(counts[:-1].astype(np.float64), int(counts[-1]))


def _quantiles() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """2**16 quantiles of Gamma(2, 1): r, 1 / r, and ln c, by bisection of its distribution function."""
    p = (np.arange(1 << 16) + 0.5) / (1 << 16)
    low, high = np.full(len(p), 1e-6), np.full(len(p), 60.0)
    for _ in range(70):
        mid = (low + high) / 2
        small = 1 - np.exp(-mid) * (1 + mid) < p
        low, high = np.where(small, mid, low), np.where(small, high, mid)
    return low.astype(np.float32), (1 / low).astype(np.float32), np.log(low).astype(np.float32)


class Sampler:
    """Improved consistent weighted sampling: two weighted sets agree in one sample with the probability of their weighted Jaccard similarity.

    For a shingle of weight w, r and c are Gamma(2, 1) and b uniform, all from a hash of the shingle; t is
    floor(ln w / r + b) and the shingle of the least ln c - r (t - b + 1) is taken, as is its t. A sample is 32 bits of
    a hash of both.
    """

    BLOCK = 1 << 13

    def __init__(self, samples: int):
        self.seeds = mix(np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.r, self.inverse, self.ln_c = _quantiles()

    def __call__(self, sets: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Samples of (hashes, weights) sets, one row a set; zeros for an empty set."""
        out = np.zeros((len(sets), len(self.seeds)), np.uint32)
        full = [k for k, (h, _) in enumerate(sets) if len(h)]
        a = 0
        while a < len(full):
            b, n = a, 0
            while b < len(full) and (b == a or n + len(sets[full[b]][0]) <= self.BLOCK):
                n += len(sets[full[b]][0])
                b += 1
            own = full[a:b]
            if n > self.BLOCK:  # one long set, in pieces: the least key of all pieces is its sample
                h, w = sets[own[0]]
                keys = np.minimum.reduce([self._keys(h[i : i + self.BLOCK], w[i : i + self.BLOCK], np.zeros(1, np.int64)) for i in range(0, n, self.BLOCK)])
            else:
                starts = np.r_[0, np.cumsum([len(sets[k][0]) for k in own])[:-1]]
                keys = self._keys(np.concatenate([sets[k][0] for k in own]), np.concatenate([sets[k][1] for k in own]), starts)
            out[own] = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32).T
            a = b
        return out

    def _keys(self, hashes: np.ndarray, weights: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """By seed and set, the least of (ln a as fixed point, hash of shingle and t)."""
        out = np.empty((len(self.seeds), len(starts)), np.uint64)
        ln_w = np.log(weights).astype(np.float32)
        for k, seed in enumerate(self.seeds):
            x = mix((hashes ^ seed) * np.uint64(0xD6E8FEB86659FD93))
            parts = x.view(np.uint16).reshape(-1, 4)  # four independent numbers
            i = parts[:, 0].astype(np.intp)
            r = self.r[i]
            beta = parts[:, 1].astype(np.float32) * np.float32(1 / 65536)
            t = np.floor(ln_w * self.inverse[i] + beta)
            ln_a = self.ln_c[parts[:, 2].astype(np.intp)] - r * (t - beta + np.float32(1))
            fixed = ((ln_a + np.float32(128)) * np.float32(1 << 23)).astype(np.uint64) << np.uint64(32)
            name = (x >> np.uint64(32)) ^ ((t.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF))
            out[k] = np.minimum.reduceat(fixed | name, starts)
        return out


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum of the lesser weights over the sum of the greater, of two (ascending hashes, weights) sets; 0 if both are empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = float(np.minimum(a[1][i], b[1][j]).sum())
    total = float(a[1].sum() + b[1].sum()) - both
    return both / total if total > 0 else 0.0
