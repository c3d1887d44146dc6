"""A minimal acyclic transducer from words to id lists, built once and read through a memory map."""

from __future__ import annotations

import numpy as np

MAGIC = 0x4C535431


class Transducer:
    """Words to id lists. States with equal futures are shared; a word's number is the count of words before it, summed along its path.

    Layout of the file, in little-endian 32-bit words: magic, counts of states, arcs, words and ids; then per state
    its first arc and whether it ends a word; per arc its byte, target and the words before it; per word the
    place of its first id; the ids.
    """

    def __init__(self, path: str):
        raw = np.asarray(np.memmap(path, "<u4", "r"))
        magic, states, arcs, n, ids = (int(x) for x in raw[:5])
        if magic != MAGIC:
            raise ValueError(f"{path} holds no transducer")
        at = 5
        self.words = n

        def part(k: int) -> np.ndarray:
            nonlocal at
            at += k
            return raw[at - k : at]

        self.first, self.final = part(states + 1), part(states)
        self.byte, self.target, self.before = part(arcs), part(arcs), part(arcs)
        self.place, self.ids = part(n + 1), part(ids)
        self.arcs = np.repeat(np.arange(states), np.diff(self.first)) * 256 + self.byte  # ascending

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the sorted lexicon, or -1. All words take a step at a time, until each has ended or left the lexicon."""
        size = np.array([len(w) for w in words], np.int64)
        data, at = np.frombuffer(b"".join(words), np.uint8), np.cumsum(size) - size
        state, number, out = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.zeros(len(words), bool)
        live, step = np.flatnonzero(size), 0
        if not len(self.arcs):
            out[live], live = True, live[:0]
        while len(live):
            arc = state[live] * 256 + data[at[live] + step]
            k = np.minimum(np.searchsorted(self.arcs, arc), len(self.arcs) - 1)
            hit = self.arcs[k] == arc
            out[live[~hit]] = True
            live, k, step = live[hit], k[hit], step + 1
            number[live] += self.before[k]
            state[live] = self.target[k]
            live = live[size[live] > step]
        return np.where(out | (self.final[state] == 0), -1, number)

    def get_all(self, words: list[bytes]) -> list[np.ndarray | None]:
        """The ids of each word, None for those outside the lexicon."""
        return [None if i < 0 else self.ids[self.place[i] : self.place[i + 1]] for i in self.numbers(words).tolist()]


def compile_words(entries: dict[bytes, list[int]]) -> bytes:
    """The file of a transducer for these words: incremental construction over the sorted words, sharing equal suffix states."""
    known: dict[tuple, int] = {}
    frozen: list[tuple] = []  # (final, ((byte, target), ...)) of each shared state
    path: list[list] = [[False, []]]  # open states along the last word: final, arcs

    def freeze(depth: int) -> None:
        while len(path) > depth + 1:
            final, arcs = path.pop()
            key = (final, tuple(arcs))
            if key not in known:
                known[key] = len(frozen)
                frozen.append(key)
            byte, _ = path[-1][1][-1]
            path[-1][1][-1] = (byte, known[key])

    last, order = b"", sorted(entries)
    for word in order:
        same = 0
        while same < min(len(word), len(last)) and word[same] == last[same]:
            same += 1
        freeze(same)
        for c in word[same:]:
            path[-1][1].append((c, -1))
            path.append([False, []])
        path[-1][0] = True
        last = word
    freeze(0)
    states = [(path[0][0], tuple(path[0][1])), *frozen]  # the root is state 0; shared state k is k + 1
    total = np.zeros(len(states), np.int64)
    for k in [*range(1, len(states)), 0]:  # targets are frozen before their sources
        total[k] = states[k][0] + sum(total[t + 1] for _, t in states[k][1])
    first, byte, target, before = [0], [], [], []
    for final, arcs in states:
        seen = int(final)
        for c, t in arcs:
            byte.append(c)
            target.append(t + 1)
            before.append(seen)
            seen += int(total[t + 1])
        first.append(len(byte))
    lists = [entries[w] for w in order]
    place = np.r_[0, np.cumsum([len(x) for x in lists])] if lists else np.zeros(1)
    flat = [i for x in lists for i in x]
    head = [MAGIC, len(states), len(byte), len(order), len(flat)]
    return np.concatenate([np.asarray(x, "<u4") for x in (head, first, [s[0] for s in states], byte, target, before, place, flat)]).tobytes()
