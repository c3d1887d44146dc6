"""The byte-level tokenizer's own splitting of text into pieces, over whole Arrow batches, with ids remembered by piece."""

from __future__ import annotations

import os
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd

from .kernels import span_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: contractions that the tokenizer cuts off at an apostrophe: fixed values of its format
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


@lru_cache(1)
def classes() -> np.ndarray:
    """The class of each code point, asked of the tokenizers library's own regular expressions."""
    from tokenizers import Regex, pre_tokenizers

    points = np.r_[np.arange(0xD800), np.arange(0xE000, 0x110000)].astype("<u4")
    every, out = points.tobytes().decode("utf-32-le"), np.zeros(0x110000, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}"), (SPACE, r"\s")):
        for _, (a, b) in pre_tokenizers.Split(Regex(f"(?:{pattern})+"), "removed", invert=True).pre_tokenize_str(every):
            out[points[a:b]] = kind
    return out


def pieces(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, block: int = 1 << 17) -> np.ndarray:
    """Byte positions where pieces start; no piece crosses an offset. Taken in blocks that stay in the CPU's cache."""
    out, i = [np.zeros(0, np.int64)], 0
    while i + 1 < len(offsets):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block, side="right")) - 1)
        out.append(_pieces(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], kinds) + offsets[i])
        i = j
    return np.concatenate(out)


def _pieces(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    kind = kinds[points]
    m = len(points)
    first = np.zeros(m + 1, bool)  # of a document
    first[np.searchsorted(at, offsets)] = True
    first[0] = first[m] = True
    run = first[:m].copy()
    run[1:] |= kind[1:] != kind[:-1]
    begins = np.flatnonzero(run)
    ends = np.r_[begins[1:], m]
    start = run
    white = kind[begins] == SPACE
    last = ends[white] - 1
    last = last[~first[last + 1]]  # text follows in the same document
    start[last] = True
    joined = last[points[last] == 32] + 1  # a single space belongs to the run after it
    start[joined] = False
    # an apostrophe alone, not after such a space, before letters
    alone = begins[(kind[begins] == OTHER) & (ends - begins == 1) & (points[begins] == 39)]
    alone = alone[start[alone] & ~first[alone + 1]]
    alone = alone[kind[np.minimum(alone + 1, m - 1)] == LETTER]
    for ending in ENDINGS:
        hit = alone[alone + len(ending) < m]
        for k, c in enumerate(ending):
            hit = hit[(points[hit + 1 + k] == ord(c)) & ~first[hit + 1 + k]]
        start[hit + 1] = False
        after = hit + 1 + len(ending)
        start[after[after < m]] = True
    return at[start]


def split_special(data: np.ndarray, offsets: np.ndarray, special: dict[str, int]) -> tuple[np.ndarray, dict[int, int]]:
    """Offsets with cuts around each special token's text, and the id at each byte position where one starts."""
    raw, found, cuts = None, {}, []
    for content, i in special.items():
        mark = content.encode()
        if not mark:
            continue
        raw = data.tobytes() if raw is None else raw
        p = raw.find(mark)
        while p >= 0:
            doc_end = offsets[np.searchsorted(offsets, p, side="right")] if p < offsets[-1] else offsets[-1]
            if p + len(mark) <= doc_end:
                found[p] = i
                cuts += [p, p + len(mark)]
                p = raw.find(mark, p + len(mark))
            else:
                p = raw.find(mark, p + 1)
    return (np.unique(np.r_[offsets, cuts]).astype(np.int64) if cuts else offsets), found


class Encoder:
    """Ids of whole batches: each distinct piece is encoded once, by `encode(list of str) -> list of id lists`, and remembered.

    At most `keep` pieces are remembered; then the memory starts anew. That changes speed only.
    """

    def __init__(self, encode, special: dict[str, int], kinds: np.ndarray, keep: int = 600_000):
        self.encode, self.special, self.kinds, self.keep = encode, special, kinds, keep
        self.forget()

    def forget(self) -> None:
        self.index, self.start, self.length = {}, np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
        self.pool, self.filled = np.zeros(1 << 18, np.uint32), 0

    def learn(self, keys: list[int], ids: list) -> np.ndarray:
        """The entries that these pieces have from now on."""
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        first, n = len(self.index), len(self.index) + len(ids)
        while n > len(self.start):
            self.start, self.length = np.resize(self.start, 2 * len(self.start)), np.resize(self.length, 2 * len(self.length))
        filled = self.filled + int(sizes.sum())
        while filled > len(self.pool):
            self.pool = np.resize(self.pool, 2 * len(self.pool))
        self.pool[self.filled : filled] = np.fromiter(chain.from_iterable(ids), np.uint32, filled - self.filled)
        self.start[first:n], self.length[first:n] = self.filled + np.cumsum(sizes) - sizes, sizes
        self.filled = filled
        self.index.update(zip(keys, range(first, n), strict=True))
        return np.arange(first, n)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the whole batch, offset of each document's first id with the end)."""
        cuts, found = split_special(data, offsets, self.special)
        starts = pieces(data, cuts, self.kinds)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        ends = np.r_[starts[1:], len(data)]
        where, keys = pd.factorize(span_hashes(data, starts, ends))
        first = np.empty(len(keys), np.int64)
        first[where[::-1]] = np.arange(len(where))[::-1]
        if len(self.index) > self.keep:
            self.forget()
        own, get = np.empty(len(keys), np.int64), self.index.get
        own[:] = [get(k, -1) for k in keys.tolist()]
        new = np.flatnonzero(own < 0)
        if len(new):
            raw = data.tobytes()
            text = [raw[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
            own[new] = self.learn(keys[new].tolist(), self.encode(text))
        length, begin = self.length[own][where], self.start[own][where]
        if found:  # special tokens are pieces of their own
            for k in np.flatnonzero(np.isin(starts, list(found))).tolist():
                i = self.index.get(-1 - found[int(starts[k])])
                i = int(self.learn([-1 - found[int(starts[k])]], [[found[int(starts[k])]]])[0]) if i is None else i
                length[k], begin[k] = 1, self.start[i]
            extra = self._inside(starts, found)
            length[extra] = 0
        total = np.r_[0, np.cumsum(length)]
        ids = self.pool[np.repeat(begin - total[:-1], length) + np.arange(total[-1])]
        return ids, total[np.searchsorted(starts, offsets)]

    def _inside(self, starts: np.ndarray, found: dict[int, int]) -> np.ndarray:
        """Pieces inside a special token's text, after its first."""
        size = {i: len(c.encode()) for c, i in self.special.items()}
        return np.concatenate([np.arange(np.searchsorted(starts, p, side="right"), np.searchsorted(starts, p + size[i])) for p, i in found.items()]).astype(np.int64)
