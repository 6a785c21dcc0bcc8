"""Exact removal of repeated passages by longest-previous-factor arrays.

A byte goes if a string of `length` bytes around it also starts in a document with a
smaller doc_id; the first copy stays. The search is spread over the cluster by
content: the smallest-hash gram of a window (its anchor) is the same wherever the
window's bytes occur, so windows meet by anchor.

1. Documents are dealt to chunks of a few MB. Each chunk lists its anchors' hashes
   once; a group by hash tells each chunk which of them other chunks have too.
2. For anchors met more than once, the chunk sends the bytes around them once per
   distinct context, with the smallest doc_id. Contexts of one anchor meet in a
   bucket: their windows are sorted as suffixes, neighbours' common prefixes taken,
   and for each the previous and next smaller document in suffix order give its
   longest earlier match. Windows matched over their whole length are reported back.
3. The chunk marks the bytes of the windows reported, removes and counts them.

An anchor with more than HOT contexts (distinct within their chunk) is sent window by
window, dealt by the window's own bytes, so the many contexts around the ends of a very
common passage spread over all buckets.

Defined cases: null text is empty. A row without doc_id comes after all others: it
removes nothing elsewhere. Rows with equal doc_id do not remove each other's bytes.
Other columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import BYTE_CODES, STEP, U64, distinct, mix, text_bytes, word_hashes

LENGTH = 50
GRAM = 20
CHUNK_BYTES = 4 << 20
HOT = 4000
SLAB = 1 << 17
PLACE = U64((1 << 24) - 1)
LAST = np.iinfo(np.int64).max

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
LISTED = "bucket long, chunk long, hashes binary, contexts binary"
SEEN = "chunk long, kind int, bucket long, body binary"
SENT = "bucket long, chunk long, docs binary, groups binary, sizes binary, strings binary"


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the `size` bytes from every position, by doubling."""
    have, width, built, done = BYTE_CODES[data], 1, None, 0
    rest = size
    while rest:
        if rest & 1:
            if built is None:
                built, done = have, width
            else:
                n = len(data) - done - width + 1
                built = built[:n] * U64(0xA0761D6478BD642F) + have[done : done + n]
                done += width
        rest >>= 1
        if rest:
            n = len(have) - width
            have = have[:n] * U64(STEP) + have[width : width + n]
            width *= 2
    return mix(built)


def sliding_min(keys: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        keys = np.minimum(keys[:-size], keys[size:])
        size *= 2
    return np.minimum(keys[: len(keys) - (width - size)], keys[width - size :]) if width > size else keys


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, gram: int):
    """Per run of windows with one anchor: hash of the anchor, first and last window start."""
    width = length - gram + 1
    change = np.zeros(len(data) + 1, np.int32)
    ends = np.maximum(offsets[:-1], offsets[1:] - length + 1)
    np.add.at(change, offsets[:-1], 1)
    np.add.at(change, ends, -1)
    whole = np.cumsum(change[:-1]) > 0
    hashes, firsts, lasts = [], [], []
    for base in range(0, max(0, len(data) - length + 1), SLAB):
        part = data[base : base + SLAB + length - 1]
        grams = gram_hashes(part, gram)
        least = sliding_min((grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64), width)
        at = (least & PLACE).astype(np.int64)
        starts = np.flatnonzero(whole[base : base + len(at)])
        if not len(starts):
            continue
        at = at[starts]
        new = np.ones(len(starts), dtype=bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        hashes.append(grams[at[first]])
        firsts.append(starts[first] + base)
        lasts.append(starts[np.append(first[1:], len(starts)) - 1] + base)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(firsts), np.concatenate(lasts)


class Chunk:
    """The documents of a chunk in (doc_id, text) order and their anchors."""

    def __init__(self, table: pa.Table, buckets: int, length: int, gram: int):
        table = table.set_column(table.schema.get_field_index("doc_id"), "doc_id", pc.fill_null(table["doc_id"], LAST))
        self.given = table.take(pc.sort_indices(table, [("doc_id", "ascending"), ("text", "ascending")]))
        self.length, self.buckets = length, buckets
        self.data, self.offsets = text_bytes(self.given["text"])
        self.docs = self.given["doc_id"].to_numpy()
        self.hashes, self.firsts, self.lasts = anchors(self.data, self.offsets, length, gram)
        self.owner = self.docs[np.searchsorted(self.offsets, self.firsts, side="right") - 1]
        low, high = self.hashes & U64(0xFFFFFFFF), self.hashes >> U64(32)
        self.bucket = (low % U64(buckets)).astype(np.int64)
        self.short = high.astype(np.uint32)
        # Anchors that several documents of the chunk have; order of the listed hashes.
        self.keys, self.slot = np.unique((self.bucket.astype(np.uint64) << U64(32)) | high, return_inverse=True)

    def listed(self):
        """Per bucket the hashes of this chunk's anchors and the distinct contexts of each."""
        contexts = np.ones(len(self.keys), np.int64)
        again = np.flatnonzero(np.bincount(self.slot, minlength=len(self.keys))[self.slot] > 1)
        strings = word_hashes(self.data, self.firsts[again], self.lasts[again] + self.length)
        _, slots, _ = distinct(strings, self.slot[again])
        several, number = np.unique(slots, return_counts=True)
        contexts[several] = number
        contexts = np.minimum(contexts, 65535).astype(np.uint16)
        bucket = (self.keys >> U64(32)).astype(np.int64)
        short = (self.keys & U64(0xFFFFFFFF)).astype(np.uint32)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        for start, stop in zip(edges, np.append(edges[1:], len(bucket)), strict=True):
            yield int(bucket[start]), short[start:stop].tobytes(), contexts[start:stop].tobytes()

    def contexts(self, seen: dict[int, bytes]):
        """Distinct byte strings around shared anchors, in a fixed order.

        Returns the strings' smallest doc_ids, groups, buckets and bytes, and for every
        use of one: its number, the first window start, the windows and the document.
        """
        state = np.zeros(len(self.keys), np.uint8)
        bucket = (self.keys >> U64(32)).astype(np.int64)
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        for start, stop in zip(edges, np.append(edges[1:], len(bucket)), strict=True):
            state[start:stop] = np.frombuffer(seen[int(bucket[start])], np.uint8)
        least, most = np.full(len(self.keys), LAST), np.full(len(self.keys), -LAST - 1)
        np.minimum.at(least, self.slot, self.owner)
        np.maximum.at(most, self.slot, self.owner)
        state[(state == 0) & (least < most)] = 1
        chosen = np.flatnonzero(state[self.slot] > 0)
        buffer, known, index = self.data.tobytes(), {}, []
        docs, groups, buckets, strings = [], [], [], []
        uses: list[tuple[int, int, int, int]] = []
        for first, stop, doc, home, group, hot in zip(
            self.firsts[chosen].tolist(),
            (self.lasts[chosen] + self.length).tolist(),
            self.owner[chosen].tolist(),
            self.bucket[chosen].tolist(),
            self.short[chosen].tolist(),
            (state[self.slot[chosen]] == 2).tolist(),
            strict=True,
        ):
            parts = range(first, stop - self.length + 1) if hot else (first,)
            for begin in parts:
                text = buffer[begin : begin + self.length] if hot else buffer[begin:stop]
                at = known.get(text)
                if at is None:
                    at = known[text] = len(strings)
                    if hot:
                        group = zlib.crc32(text)
                        home = group % self.buckets
                    docs.append(doc)
                    groups.append(group)
                    buckets.append(home)
                    strings.append(text)
                uses.append((at, begin, 1 if hot else stop - first - self.length + 1, doc))
        index = np.array(uses, np.int64).reshape(-1, 4)
        return np.array(docs, np.int64), np.array(groups, np.uint32), np.array(buckets, np.int64), strings, index


def previous_smaller(rank_docs: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with the nearest earlier suffix, in suffix
    order, of a smaller document (0 if none).

    common[i] is the common prefix of suffixes i-1 and i. All positions jump together:
    a neighbour that is not smaller passes on its own link.
    """
    n = len(rank_docs)
    link, prefix = np.arange(-1, n - 1), common.copy()
    todo = np.arange(n)
    while len(todo):
        to = link[todo]
        open_ = (to >= 0) & (prefix[todo] > 0)
        todo, to = todo[open_], to[open_]
        larger = rank_docs[to] >= rank_docs[todo]
        todo, to = todo[larger], to[larger]
        ahead, through = link[to], prefix[to]
        link[todo] = ahead
        prefix[todo] = np.where(ahead >= 0, np.minimum(prefix[todo], through), 0)
    prefix[link < 0] = 0
    return prefix


def longest_previous(windows: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For every row of a byte matrix: its longest prefix that starts a row of a smaller document."""
    n, length = windows.shape
    padded = np.zeros((n, -(-length // 8) * 8), np.uint8)
    padded[:, :length] = windows
    words = padded.view(">u8").astype(np.uint64)
    order = np.lexsort(tuple(words[:, i] for i in range(words.shape[1] - 1, -1, -1)))
    ranked, by_rank = windows[order], docs[order]
    common = np.zeros(n, np.int64)
    unlike = ranked[1:] != ranked[:-1]
    common[1:] = np.where(unlike.any(axis=1), unlike.argmax(axis=1), length)
    back = previous_smaller(by_rank, common)
    ahead = previous_smaller(by_rank[::-1], np.append(common[1:], 0)[::-1].copy())[::-1]
    result = np.empty(n, np.int64)
    result[order] = np.maximum(back, ahead)
    return result


def matched(strings: list[bytes], docs: np.ndarray, groups: np.ndarray, length: int) -> np.ndarray:
    """Per string a mask of its windows that also start in a smaller document."""
    known: dict[tuple[int, bytes], int] = {}
    which = np.array([known.setdefault(key, len(known)) for key in zip(groups.tolist(), strings, strict=True)], np.int64)
    least = np.full(len(known), LAST)
    np.minimum.at(least, which, docs)
    masks = np.zeros(len(known), np.uint64)
    kept = list(known)
    group = np.array([g for g, _ in kept], np.int64)
    _, place, often = np.unique(group, return_inverse=True, return_counts=True)
    several = np.flatnonzero(often[place] > 1)
    several = several[np.argsort(place[several], kind="stable")]
    step = 20_000  # strings at a time, cut between groups
    start = 0
    while start < len(several):
        stop = min(len(several), start + step)
        while stop < len(several) and place[several[stop]] == place[several[stop - 1]]:
            stop += 1
        part = several[start:stop]
        start = stop
        sizes = np.array([len(kept[i][1]) for i in part], np.int64)
        count = sizes - length + 1
        base = np.concatenate([[0], np.cumsum(sizes)])[:-1]
        data = np.frombuffer(b"".join(kept[i][1] for i in part), np.uint8)
        inner = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        views = np.lib.stride_tricks.sliding_window_view(data, length)[np.repeat(base, count) + inner]
        found = longest_previous(views, np.repeat(least[part], count)) >= length
        bits = found.astype(np.uint64) << inner.astype(np.uint64)
        np.bitwise_or.at(masks, np.repeat(part, count), bits)
    full = np.array([(1 << (len(s) - length + 1)) - 1 for s in strings], np.uint64)
    return np.where(docs > least[which], full, masks[which])


def _table(columns: dict, schema: pa.Schema) -> pa.Table:
    return pa.table(columns, schema=schema)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, with_kept: bool = True) -> DataFrame:
    """Each document's bytes without what an earlier document already holds.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256
    and, if asked for, the kept bytes.
    """
    if not 8 <= gram <= length or length - gram + 1 > 63:
        raise ValueError("gram must be at least 8 and length - gram at most 62")
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text") + 64), F.lit(0))).first()[0]
    count = max(1, math.ceil(size / chunk_bytes))
    key = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    dealt = docs.select(F.pmod(key, F.lit(count)).alias("chunk"), F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    list_schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("hashes", pa.binary()), ("contexts", pa.binary())])
    seen_schema = pa.schema([("chunk", pa.int64()), ("kind", pa.int32()), ("bucket", pa.int64()), ("body", pa.binary())])
    sent_schema = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64())] + [(c, pa.binary()) for c in ("docs", "groups", "sizes", "strings")])
    done_schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.binary())])

    def list_anchors(key, table):
        rows = list(Chunk(table, count, length, gram).listed())
        return _table({"bucket": [r[0] for r in rows], "chunk": [key[0].as_py()] * len(rows), "hashes": [r[1] for r in rows], "contexts": [r[2] for r in rows]}, list_schema)

    def tell_shared(key, table):
        lists = [np.frombuffer(x, np.uint32) for x in table["hashes"].to_pylist()]
        _, place, often = np.unique(np.concatenate(lists), return_inverse=True, return_counts=True)
        contexts = np.bincount(place, np.concatenate([np.frombuffer(x, np.uint16) for x in table["contexts"].to_pylist()]))
        state = np.where((often > 1) & (contexts > HOT), 2, np.where(often > 1, 1, 0)).astype(np.uint8)[place]
        parts = np.split(state, np.cumsum([len(x) for x in lists])[:-1])
        n = len(lists)
        return _table({"chunk": table["chunk"].to_pylist(), "kind": [0] * n, "bucket": [key[0].as_py()] * n, "body": [p.tobytes() for p in parts]}, seen_schema)

    def bodies(table: pa.Table, kind: int) -> dict[int, bytes]:
        return {b: x for k, b, x in zip(table["kind"].to_pylist(), table["bucket"].to_pylist(), table["body"].to_pylist(), strict=True) if k == kind}

    def send_contexts(key, given, told):
        docs_, groups, buckets, strings, _ = Chunk(given, count, length, gram).contexts(bodies(told, 0))
        order = np.argsort(buckets, kind="stable")
        edges = np.flatnonzero(np.diff(buckets[order], prepend=-1))
        out = {name: [] for name in sent_schema.names}
        for start, stop in zip(edges, np.append(edges[1:], len(order)), strict=True):
            part = order[start:stop]
            texts = [strings[i] for i in part]
            out["bucket"].append(int(buckets[part[0]]))
            out["chunk"].append(key[0].as_py())
            out["docs"].append(docs_[part].tobytes())
            out["groups"].append(groups[part].tobytes())
            out["sizes"].append(np.array([len(x) for x in texts], np.uint16).tobytes())
            out["strings"].append(b"".join(texts))
        return _table(out, sent_schema)

    def tell_matches(key, table):
        strings, docs_, groups, counts = [], [], [], []
        for d, g, s, body in zip(*(table[c].to_pylist() for c in ("docs", "groups", "sizes", "strings")), strict=True):
            ends = np.cumsum(np.frombuffer(s, np.uint16).astype(np.int64)).tolist()
            strings += [body[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]
            docs_.append(np.frombuffer(d, np.int64))
            groups.append(np.frombuffer(g, np.uint32))
            counts.append(len(ends))
        masks = matched(strings, np.concatenate(docs_), np.concatenate(groups), length)
        parts = np.split(masks, np.cumsum(counts)[:-1])
        n = len(counts)
        return _table({"chunk": table["chunk"].to_pylist(), "kind": [1] * n, "bucket": [key[0].as_py()] * n, "body": [p.tobytes() for p in parts]}, seen_schema)

    def remove(key, given, told):
        chunk = Chunk(given, count, length, gram)
        docs_, _, buckets, strings, uses = chunk.contexts(bodies(told, 0))
        masks = np.zeros(len(strings), np.uint64)
        order = np.argsort(buckets, kind="stable")
        answers = bodies(told, 1)
        if len(order):
            masks[order] = np.frombuffer(b"".join(answers[b] for b in np.unique(buckets).tolist()), np.uint64)
        at, first, windows, doc = uses.T
        mask = np.where(doc > docs_[at], ~U64(0), masks[at]) if len(uses) else np.zeros(0, np.uint64)
        change = np.zeros(len(chunk.data) + 1, np.int32)
        for i in range(int(windows.max()) if len(uses) else 0):
            hit = first[(windows > i) & ((mask >> U64(i)) & U64(1) > 0)] + i
            np.add.at(change, hit, 1)
            np.add.at(change, hit + length, -1)
        gone = np.cumsum(change[:-1]) > 0
        n_removed, n_spans, digests, kept = [], [], [], []
        for a, b in zip(chunk.offsets[:-1], chunk.offsets[1:], strict=True):
            out = gone[a:b]
            rest = chunk.data[a:b][~out].tobytes()
            n_removed.append(int(out.sum()))
            n_spans.append(int(np.count_nonzero(np.diff(out.view(np.int8), prepend=0) == 1)))
            digests.append(hashlib.sha256(rest).hexdigest())
            kept.append(rest if with_kept else None)
        ids = chunk.docs
        return _table(
            {"doc_id": pa.array(ids, mask=ids == LAST), "n_bytes": np.diff(chunk.offsets), "n_removed": n_removed, "n_spans": n_spans, "kept_sha256": digests, "kept": kept},
            done_schema,
        )

    by_chunk = dealt.groupBy("chunk")
    listed = by_chunk.applyInArrow(list_anchors, LISTED)
    shared = listed.groupBy("bucket").applyInArrow(tell_shared, SEEN)
    sent = by_chunk.cogroup(shared.groupBy("chunk")).applyInArrow(send_contexts, SENT)
    found = sent.groupBy("bucket").applyInArrow(tell_matches, SEEN)
    told = shared.unionByName(found)
    result = by_chunk.cogroup(told.groupBy("chunk")).applyInArrow(remove, RESULT)
    return result if with_kept else result.drop("kept")
