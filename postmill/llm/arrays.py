"""Words and shingles of the texts in an Arrow batch as numpy arrays, for code inside tasks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
ASCII_SPACE = b" \t\n\x0b\x0c\r"
ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64) * U64(ODD)) | U64(1)


def separators(also: bytes = b"") -> np.ndarray:
    """Table of 256: which bytes are part of a word; ASCII white space and `also` are not."""
    table = np.ones(256, dtype=bool)
    table[list(ASCII_SPACE + also)] = False
    return table


WHITE = separators()
PUNCTUATION = separators(bytes(b for b in range(128) if not chr(b).isalnum()))


def text_bytes(column: pa.Array | pa.ChunkedArray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """All texts as one byte array and the offsets of each; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if lower:
        column = pc.utf8_lower(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a piece holds at most `most` bytes of text, or one row."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes.astype(np.int64))
        start = 0
        while start < len(sizes):
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def word_spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of words in each text."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    word = inside[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1] | edge[1:-1]
    last[:-1] &= ~word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)
STEP = 0xD1342543DE82EF95
STEP_BACK = pow(STEP, -1, 1 << 64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = max(n, 1 << 20)
        up, down = np.full(size, STEP, np.uint64), np.full(size, STEP_BACK, np.uint64)
        up[0] = down[0] = 1
        _powers = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _powers


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word by its bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = powers(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_CODES[data] * up[: len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(words: np.ndarray, counts: np.ndarray, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words, and the number of the text of each.

    A text of 1 to size-1 words has one shingle, all its words, if `short`, else none.
    """
    bounds = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), counts)
    room = bounds[text + 1] - np.arange(len(words))
    full = np.flatnonzero(room >= size)
    value = np.full(len(full), ODD, np.uint64)
    for i in range(size):
        value = mix(value * U64(STEP) + words[full + i])
    owner = text[full]
    if short and len(few := np.flatnonzero((counts > 0) & (counts < size))):
        rest = np.full(len(few), ODD, np.uint64)
        for i in range(size - 1):
            has = counts[few] > i
            rest[has] = mix(rest[has] * U64(STEP) + words[bounds[few][has] + i])
        value, owner = np.concatenate([value, rest]), np.concatenate([owner, few])
        order = np.argsort(owner, kind="stable")
        value, owner = value[order], owner[order]
    return value, owner


def text_shingles(column: pa.Array, size: int, inside: np.ndarray = WHITE, lower: bool = False, short: bool = True):
    """shingles() of an Arrow column of texts."""
    data, offsets = text_bytes(column, lower)
    starts, ends, counts = word_spans(data, offsets, inside)
    return shingles(word_hashes(data, starts, ends), counts, size, short)


def distinct(values: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each value of each owner once, ordered by owner and value, and how often it occurs."""
    if not len(values):
        return values, owner, np.zeros(0, np.int64)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    return values[at], owner[at], np.diff(np.append(at, len(values)))
