"""Token ids of byte strings a worker has met before, as numpy tables, and what byte-level tokenizers share."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np

from postmill.llm.arrays import word_hashes

REMEMBERED = 600_000
LONGEST = 64
INDEX_BITS = 20

# Kinds of bytes, for the places where words part.
LETTER, MARK, NEITHER, SPACE, LINE, OTHER = range(6)
KINDS = np.full(256, NEITHER, np.uint8)
KINDS[[b for b in range(128) if chr(b).isalpha()]] = LETTER
KINDS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = MARK
KINDS[[9, 11, 12, 13]] = OTHER
KINDS[32], KINDS[10] = SPACE, LINE

# Letters of ASCII and Latin-1 in UTF-8, perhaps behind one space.
WORD = re.compile(rb" ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")

# Byte-level models write a byte as itself where it is printable in Latin-1, and else as the next character from 256 on.
PRINTABLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
ALPHABET = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in PRINTABLE)}
KEEP_LINES = ALPHABET | {10: 10}

Learn = Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def words_at(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    return [data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def word_ids(model, words: list[bytes], lower: bool = False) -> tuple[list[int], list[int]]:
    """Ids of plain words straight from a byte-level model, and the number of each."""
    joined = b"\n".join(words)
    if lower:
        joined = joined.decode().lower().encode()
    pieces = joined.decode("latin-1").translate(KEEP_LINES).split("\n") if words else []
    lists = [[token.id for token in model.tokenize(piece)] for piece in pieces]
    return [i for ids in lists for i in ids], [len(ids) for ids in lists]


class KnownIds:
    """Ids by bytes: found by hash, then held byte by byte against what was learnt.

    Strings of up to LONGEST bytes are remembered, up to `most` and then anew. Longer ones, and
    those that share a hash with another, are learnt every time.
    """

    def __init__(self, learn: Learn, most: int = REMEMBERED):
        self.learn, self.most = learn, most
        self.forget()

    def forget(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.entries = np.zeros(0, np.int64)
        self.text = np.zeros(0, np.uint8)
        self.text_ends = np.zeros(1, np.int64)
        self.ids = np.zeros(0, np.uint32)
        self.id_ends = np.zeros(1, np.int64)
        self.index = np.zeros((1 << INDEX_BITS) + 1, np.int64)

    def find(self, hashes: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Entry of every span, -1 where there is none."""
        entry = np.full(len(hashes), -1, np.int64)
        bucket = (hashes >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
        at, stop = self.index[bucket], self.index[bucket + 1]
        left = np.flatnonzero(at < stop)
        while len(left):
            hit = self.hashes[at[left]] == hashes[left]
            entry[left[hit]] = self.entries[at[left[hit]]]
            left = left[~hit]
            at[left] += 1
            left = left[at[left] < stop[left]]
        found = np.flatnonzero(entry >= 0)
        own = entry[found]
        sizes = ends[found] - starts[found]
        unlike = sizes != self.text_ends[own + 1] - self.text_ends[own]
        entry[found[unlike]] = -1
        found, own, sizes = found[~unlike], own[~unlike], sizes[~unlike]
        same = data[ranges(starts[found], sizes)] == self.text[ranges(self.text_ends[own], sizes)]
        wrong = np.flatnonzero(~same)
        if len(wrong):
            entry[found[np.searchsorted(np.cumsum(sizes), wrong, side="right")]] = -1
        return entry

    def add(self, hashes: np.ndarray, words: list[bytes]) -> None:
        ids, sizes = self.learn(words)
        before = len(self.text_ends) - 1
        self.hashes = np.concatenate([self.hashes, hashes])
        self.entries = np.concatenate([self.entries, before + np.arange(len(words))])
        order = np.argsort(self.hashes, kind="stable")
        self.hashes, self.entries = self.hashes[order], self.entries[order]
        buckets = (self.hashes >> np.uint64(64 - INDEX_BITS)).astype(np.int64)
        self.index = np.concatenate([[0], np.cumsum(np.bincount(buckets, minlength=1 << INDEX_BITS))])
        self.text = np.concatenate([self.text, np.frombuffer(b"".join(words), np.uint8)])
        self.text_ends = np.concatenate([self.text_ends, self.text_ends[-1] + np.cumsum(np.array([len(w) for w in words], np.int64))])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        self.id_ends = np.concatenate([self.id_ends, self.id_ends[-1] + np.cumsum(sizes)])

    def ids_of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all spans of data in one array, and the number of each span."""
        if len(self.entries) > self.most:
            self.forget()
        hashes = word_hashes(data, starts, ends)
        entry = self.find(hashes, data, starts, ends)
        new = np.flatnonzero((entry < 0) & (ends - starts <= LONGEST))
        if len(new):
            first = new[np.unique(hashes[new], return_index=True)[1]]
            at = np.searchsorted(self.hashes, hashes[first])
            first = first[np.append(self.hashes, np.uint64(0))[at] != hashes[first]]
            if len(first):
                self.add(hashes[first], words_at(data, starts[first], ends[first]))
            entry[new] = self.find(hashes[new], data, starts[new], ends[new])
        table, id_ends = self.ids, self.id_ends
        apart = np.flatnonzero(entry < 0)
        if len(apart):
            ids, sizes = self.learn(words_at(data, starts[apart], ends[apart]))
            entry[apart] = len(id_ends) - 1 + np.arange(len(apart))
            table = np.concatenate([table, ids.astype(np.uint32)])
            id_ends = np.concatenate([id_ends, id_ends[-1] + np.cumsum(sizes)])
        sizes = id_ends[entry + 1] - id_ends[entry]
        return table[ranges(id_ends[entry], sizes)], sizes
