"""Numpy helpers over the UTF-8 bytes of Arrow string columns: words, shingles, hashes."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa

_MULT, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_BYTE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: bytes of words: letters and digits of ASCII, and every byte of other characters until these are looked at
_WORD = np.zeros(256, bool)
for _lo, _hi in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _WORD[_lo:_hi] = True


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


@lru_cache(1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    p, q = np.full(n, _MULT), np.full(n, np.uint64(pow(int(_MULT), -1, 2**64)))
    p[0] = q[0] = 1
    return np.cumprod(p), np.cumprod(q)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(16, int(n + 1).bit_length()))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """A 64-bit hash of each byte span, the same wherever the span lies. Spans ascend; they are taken in blocks that stay in the CPU's cache."""
    out, i = np.empty(len(starts), np.uint64), 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + block)))
        own = data[starts[i] : ends[j - 1]]
        s, e = starts[i:j] - starts[i], ends[i:j] - starts[i]
        up, down = powers(len(own))
        total = np.zeros(len(own) + 1, np.uint64)
        np.cumsum(_BYTE[own] * up[: len(own)], out=total[1:])
        out[i:j] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        i = j
    return out


@lru_cache(1)
def _in_words() -> np.ndarray:
    """Which code points are letters, marks or numbers."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)), bool, 0x110000)


def _word_bytes(data: np.ndarray) -> np.ndarray:
    """Which bytes belong to letters, marks or numbers."""
    out = _WORD[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        size = np.where(data[lead] >= 0xF0, 4, np.where(data[lead] >= 0xE0, 3, 2))
        point = data[lead].astype(np.int64) & (0x7F >> size)
        for k in (1, 2, 3):
            more = size > k
            point[more] = (point[more] << 6) | (data[lead[more] + k] & 0x3F)
        apart = ~_in_words()[point]
        lead, size = lead[apart], size[apart]
        for k in range(4):
            out[lead[size > k] + k] = False
    return out


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, index of each document's first word, with the end): maximal runs of letters, marks and numbers inside a document."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    is_word = _word_bytes(data)
    before, after = np.empty(n, bool), np.empty(n, bool)
    before[0] = after[-1] = False
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    before[offsets[offsets < n]] = False
    after[offsets[offsets > 0] - 1] = False
    starts = np.flatnonzero(is_word & ~before)
    return starts, np.flatnonzero(is_word & ~after) + 1, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, index of each document's first word, with the end)."""
    starts, ends, first = words(data, offsets)
    return span_hashes(data, starts, ends) if len(starts) else np.zeros(0, np.uint64), first


def roll(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of `width` successive hashes."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = hashes[:n].copy()
    for k in range(1, width):
        out *= _STEP
        out += hashes[k : k + n]
    return mix(out)


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """The shingle hashes of each document, in order and with repeats.

    A document with fewer words than `width` (but some) has one shingle of all its words; one without words has none.
    """
    hashes, first = word_hashes(data, offsets)
    rolled = roll(hashes, width)
    out = []
    for a, b in zip(first[:-1], first[1:], strict=True):
        if b - a >= width:
            out.append(rolled[a : b - width + 1])
        elif b > a:
            out.append(roll(hashes[a:b], int(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
