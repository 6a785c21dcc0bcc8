"""Benchmark items inside documents: size-partitioned MinHash containment search.

A document holds a share c of an item's five-word shingles. Each hash function's
minimum over the item is one of its shingles, and lies in the document with
probability c. Items are partitioned by size; each class has its own number of hash
functions, and the minima of its items are the class's index. Whole documents, of any
length, stream past the index; the share of an item's minima found estimates c without
a signature of the long side, whose minima would rarely be the item's. Likely pairs
are verified by exact shingle containment in the same task. Documents with fewer
shingles than the smallest item needs are not looked up.

Items are read in blocks of bounded size, so what a task is sent is bounded whatever
the size of the benchmark; blocks follow one another over all documents.

Words are runs of letters and digits, lower-cased. Defined cases: null and empty texts
match nothing; an item of fewer than five words has no shingle and matches nothing;
repeated items and documents are reported each. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import PUNCTUATION, U64, distinct, mix, pieces, text_shingles

WORDS = 5
CONTAINED = 0.8
# The estimate's standard deviation is at most 0.05 with 64 functions: six are allowed.
LIKELY = 0.5
BLOCK_BYTES = 8 << 20
# Text of a batch that is worked on at once; its arrays take some forty times as much.
PIECE_BYTES = 1 << 20


def functions_for(size: int) -> int:
    """Hash functions of an item's size class: 64, and half more for each doubling beyond 64 shingles."""
    return 64 + 32 * max(0, (max(size, 1) - 1).bit_length() - 6)


class Index:
    """Minima and shingle sets of a block of items."""

    def __init__(self, texts: list[str | None]):
        values, owner = text_shingles(pa.array(texts, pa.string()), WORDS, PUNCTUATION, lower=True, short=False)
        values, owner, _ = distinct(values, owner)
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1))
        self.sets = [values[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        sizes = np.diff(bounds)
        self.functions = np.array([functions_for(int(n)) for n in sizes], np.int64)
        keys, items = [], []
        for item, own in enumerate(self.sets):
            if len(own):
                seeds = mix(np.arange(self.functions[item], dtype=np.uint64) + U64(101))
                least = np.array([int(np.argmin(mix(own ^ seed))) for seed in seeds])
                keys.append(own[least])
                items.append(np.full(len(least), item))
        key = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        item = np.concatenate(items) if items else np.zeros(0, np.int64)
        key, item, weight = distinct(key, item)
        order = np.argsort(key, kind="stable")
        key, self.item, self.weight = key[order], item[order], weight[order]
        self.keys, self.first, self.number = np.unique(key, return_index=True, return_counts=True)
        self.least = min((math.ceil(CONTAINED * len(s)) for s in self.sets if len(s)), default=0)
        self.filter = np.zeros(1 << 22, dtype=bool)
        self.filter[(self.keys >> U64(42)).astype(np.int64)] = True

    def search(self, values: np.ndarray, owner: np.ndarray, texts: int):
        """(text, item, exact containment) of a batch's shingles, given as distinct() gives them."""
        enough = np.bincount(owner, minlength=texts) >= self.least
        hit = np.flatnonzero(self.filter[(values >> U64(42)).astype(np.int64)])
        hit = hit[enough[owner[hit]]]
        if not len(hit) or not len(self.keys):
            return
        at = np.minimum(np.searchsorted(self.keys, values[hit]), len(self.keys) - 1)
        real = self.keys[at] == values[hit]
        hit, at = hit[real], at[real]
        number = self.number[at]
        entry = np.repeat(self.first[at], number) + np.arange(number.sum()) - np.repeat(np.cumsum(number) - number, number)
        pair = np.repeat(owner[hit], number) * len(self.sets) + self.item[entry]
        pairs, place = np.unique(pair, return_inverse=True)
        share = np.bincount(place, self.weight[entry]) / self.functions[pairs % len(self.sets)]
        bounds = np.searchsorted(owner, np.arange(texts + 1))
        for code in pairs[share >= LIKELY].tolist():
            text, item = divmod(code, len(self.sets))
            own = self.sets[item]
            exact = np.isin(own, values[bounds[text] : bounds[text + 1]]).mean()
            if exact >= CONTAINED:
                yield text, item, float(exact)


def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batches in pieces, each with the distinct shingles of its texts and the text of each."""
    for batch in pieces(batches, "text", PIECE_BYTES):
        values, owner = text_shingles(batch.column("text"), WORDS, PUNCTUATION, lower=True, short=False)
        values, owner, _ = distinct(values, owner)
        yield batch, values, owner


def item_blocks(benchmark: DataFrame, block_bytes: int):
    """Blocks of (item_id, text), each of about block_bytes, read one after the other."""
    size = benchmark.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    count = math.ceil(size / block_bytes)
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for i in range(count):
        rows = benchmark.where(block == i).select("item_id", "text").collect()
        if rows:
            yield [r.item_id for r in rows], [r.text for r in rows]


def contained_items(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Rows (doc_id, item_id, containment) of every item that a document holds."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    result = None
    for ids, texts in item_blocks(benchmark, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast((ids, Index(texts)))

        def search(batches, index=index):
            ids, known = index.value
            for batch, values, owner in shingled(batches):
                doc = batch.column("doc_id").to_pylist()
                rows = [(doc[t], ids[i], c) for t, i, c in known.search(values, owner, batch.num_rows)]
                if rows:
                    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.float64()), strict=True)]
                    yield pa.record_batch(columns, ["doc_id", "item_id", "containment"])

        found = given.mapInArrow(search, "doc_id long, item_id long, containment double")
        result = found if result is None else result.unionByName(found)
    if result is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, containment double")
    return result


def without_items(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents that hold no item; rows pass unchanged and are not shuffled."""
    for _, texts in item_blocks(benchmark, block_bytes):
        index = docs.sparkSession.sparkContext.broadcast(Index(texts))

        def clean(batches, index=index):
            for batch, values, owner in shingled(batches):
                bad = [t for t, _, _ in index.value.search(values, owner, batch.num_rows)]
                keep = np.ones(batch.num_rows, dtype=bool)
                keep[bad] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
