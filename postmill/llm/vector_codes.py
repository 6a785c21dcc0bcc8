"""Product codes of vectors by exact integer rounds over Hilbert-sorted blocks with boxes.

Each component becomes an integer, each vector PARTS pieces. A task cuts its vectors into
chunks; in a chunk the pieces of one part are sorted along a Hilbert curve and cut into
flat blocks of BLOCK neighbours, each with its box (least and greatest of every component)
and its sum. Chunks are written once and read by every round.

In a round the distance from a block's box to an entry, at least and at most, leaves a
block the shortlist of entries that can be nearest to any of its points. Where one is left,
the block's sum is all that is needed; elsewhere distances to the shortlist are taken in
integers, in four bytes where they fit and else in eight. A task adds up its points per part
and entry, so a round sends PARTS * ENTRIES sums a task, and only totals reach the driver.

Defined cases: a row whose vector is null or holds null, NaN or an infinity is dropped. The
common length is that of the smallest kept vec_id's vector (null ids last, then the vector
decides); a vector of another length, or with an integer so large that its distances do
not fit eight bytes, keeps its row with null code and error and takes no part. Lengths that
PARTS does not divide are filled up with zeros, which change no distance. Fewer vectors
than ENTRIES make smaller codebooks. Rows that repeat count each. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import lookup
from postmill.session import written

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

BLOCK = 32
CHUNK_ROWS = 8192
CHUNK_NUMBERS = 1 << 20
CURVE_BITS = 63
KERNEL_CELLS = 1 << 18

CHUNK = "length int, size int, width int, vec_ids array<long>, labels array<string>, points binary, orders binary, lows binary, highs binary, sums binary"


def curve_keys(points: np.ndarray) -> np.ndarray:
    """Place of every point (rows of integers) on a Hilbert curve through their box (Skilling, 2004)."""
    axes = min(points.shape[1], CURVE_BITS)
    if not axes or not len(points):
        return np.zeros(len(points), np.uint64)
    low = points[:, :axes].min(axis=0)
    span = int((points[:, :axes].max(axis=0) - low).max())
    bits = min(CURVE_BITS // axes, max(span.bit_length(), 1))
    x = list(((points[:, :axes] - low) >> max(span.bit_length() - bits, 0)).T.astype(np.uint64))
    for b in range(bits - 1, 0, -1):
        below = np.uint64((1 << b) - 1)
        for i in range(axes):
            hit = (x[i] >> np.uint64(b) & np.uint64(1)).astype(bool)
            swap = np.where(hit, np.uint64(0), (x[0] ^ x[i]) & below)
            if i:
                x[i] = x[i] ^ swap
            x[0] = np.where(hit, x[0] ^ below, x[0] ^ swap)
    for i in range(1, axes):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint64(b) & np.uint64(1), np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros(len(points), np.uint64)
    for b in range(bits - 1, -1, -1):
        for column in x:
            key = key << np.uint64(1) | ((column ^ turn) >> np.uint64(b) & np.uint64(1))
    return key


def largest(length: int) -> int:
    """Greatest size of an integer for which squared distances over a whole vector fit eight bytes."""
    return isqrt((1 << 61) // max(length, 1))


def finite_vectors(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """By vector length: the length, rows and integers of the vectors that count."""
    column = batch.column("embedding")
    sizes = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    flat = column.flatten()
    values = pc.fill_null(flat, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64)
    starts = np.cumsum(np.maximum(sizes, 0)) - np.maximum(sizes, 0)
    for length in np.unique(sizes[sizes >= 0]).tolist():
        rows = np.flatnonzero(sizes == length)
        for at in range(0, len(rows), step := max(1, min(CHUNK_ROWS, CHUNK_NUMBERS // max(length, 1)))):
            own = rows[at : at + step]
            vectors = values[starts[own][:, None] + np.arange(length)]
            finite = np.isfinite(vectors).all(axis=1)
            # Multiplying by a power of two is exact unless it leaves the range of floats.
            with np.errstate(over="ignore"):
                yield length, own[finite], np.floor(vectors[finite] * SCALE)


def cut(vectors: np.ndarray) -> np.ndarray:
    """(parts, vectors, components of a part), filled up with zeros."""
    wide = -(-vectors.shape[1] // PARTS)
    filled = np.zeros((len(vectors), wide * PARTS), vectors.dtype)
    filled[:, : vectors.shape[1]] = vectors
    return filled.reshape(len(vectors), PARTS, wide).transpose(1, 0, 2)


def chunks(embeddings: DataFrame) -> DataFrame:
    """Vectors as chunks of sorted blocks; those that take no part as chunks without points (width 0)."""

    def build(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for length, rows, vectors in finite_vectors(batch):
                fits = (np.abs(vectors) <= largest(length)).all(axis=1)
                if fits.any():
                    yield chunk(batch, length, rows[fits], vectors[fits].astype(np.int64))
                if not fits.all():
                    yield chunk(batch, length, rows[~fits], None)

    def chunk(batch: pa.RecordBatch, length: int, rows: np.ndarray, vectors: np.ndarray | None) -> pa.RecordBatch:
        names = [batch.column(c).take(pa.array(rows)) for c in ("vec_id", "label")]
        bodies, width = [b""] * 5, 0
        if vectors is not None:
            width = 4 if not vectors.size or np.abs(vectors).max() < 1 << 30 else 8
            kind = np.dtype(f"<i{width}")
            orders, points, lows, highs, sums = [], [], [], [], []
            for part in cut(vectors):
                order = np.argsort(curve_keys(part), kind="stable")
                part = part[order]
                edges = np.arange(0, len(part), BLOCK)
                orders.append(order.astype("<u4"))
                points.append(part.astype(kind))
                lows.append(np.minimum.reduceat(part, edges, axis=0).astype(kind))
                highs.append(np.maximum.reduceat(part, edges, axis=0).astype(kind))
                sums.append(np.add.reduceat(part, edges, axis=0).astype("<i8"))
            bodies = [np.stack(x).tobytes() for x in (points, orders, lows, highs, sums)]
        head = [pa.array([x], pa.int32()) for x in (length, len(rows), width)]
        lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), x) for x in names]
        return pa.record_batch([*head, *lists, *(pa.array([b], pa.binary()) for b in bodies)], [f.split()[0] for f in CHUNK.split(", ")])

    given = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    return given.where(F.col("embedding").isNotNull()).mapInArrow(build, CHUNK)


class Chunk:
    """A chunk read back: views of its bodies as (parts, rows or blocks, components)."""

    def __init__(self, batch: pa.RecordBatch, row: int):
        get = lambda name: batch.column(name)[row]
        self.length, self.size, width = (get(c).as_py() for c in ("length", "size", "width"))
        self.vec_ids, self.labels = get("vec_ids").values, get("labels").values
        self.wide, blocks = -(-self.length // PARTS), -(-self.size // BLOCK)
        if width:
            self.points, self.lows, self.highs = (
                np.frombuffer(get(name).as_buffer(), f"<i{width}").reshape(PARTS, n, self.wide)
                for name, n in (("points", self.size), ("lows", blocks), ("highs", blocks))
            )
            self.sums = np.frombuffer(get("sums").as_buffer(), "<i8").reshape(PARTS, blocks, self.wide)
            self.orders = np.frombuffer(get("orders").as_buffer(), "<u4").reshape(PARTS, self.size)


def shortlists(lows: np.ndarray, highs: np.ndarray, book: np.ndarray) -> np.ndarray:
    """Per block and entry whether the entry can be nearest to a point within the block's box."""
    near = np.zeros((len(lows), len(book)), np.int64)
    far = np.zeros_like(near)
    for k in range(book.shape[1]):
        under, over = lows[:, k, None].astype(np.int64) - book[:, k], book[:, k] - highs[:, k, None].astype(np.int64)
        gap = np.maximum(np.maximum(under, over), 0)
        near += gap * gap
        reach = np.maximum(-under, -over)
        far += reach * reach
    return near <= far.min(axis=1, keepdims=True)


def nearest(points: np.ndarray, listed: np.ndarray, book: np.ndarray, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For the points of these blocks: their rows, nearest entry and squared distance."""
    top = max(int(np.abs(points).max(initial=0)), int(np.abs(book).max(initial=0)))
    small = (2 * top) ** 2 * max(book.shape[1], 1) < 1 << 31
    points, book = (x.astype(np.int32 if small else np.int64, copy=False) for x in (points, book))
    counts = listed[blocks].sum(axis=1)
    rows, entries, distances = [], [], []
    size = 1
    while size < 2 * ENTRIES:
        group = blocks[(counts > size // 2) & (counts <= size)]
        step = max(1, KERNEL_CELLS // (BLOCK * size))
        for at in range(0, len(group), step):
            own = group[at : at + step]
            # Listed entries in ascending order, then others, which are farther than some listed one.
            candidates = np.argsort(~listed[own], axis=1, kind="stable")[:, :size]
            place = own[:, None] * BLOCK + np.arange(BLOCK)
            inside = np.minimum(place, len(points) - 1)
            total = np.zeros((len(own), BLOCK, candidates.shape[1]), points.dtype)
            for k in range(book.shape[1]):
                apart = points[inside, k][:, :, None] - book[candidates, k][:, None, :]
                total += apart * apart
            least = total.argmin(axis=2)
            real = place < len(points)
            rows.append(place[real])
            entries.append(np.take_along_axis(candidates, least, axis=1)[real])
            distances.append(np.take_along_axis(total, least[:, :, None], axis=2)[:, :, 0][real].astype(np.int64))
        size *= 2
    none = np.zeros(0, np.int64)
    return tuple(np.concatenate([none, *x]) for x in (rows, entries, distances))


def part_totals(chunk: Chunk, part: int, book: np.ndarray, counts: np.ndarray, sums: np.ndarray) -> None:
    """Add a chunk's points of one part to the number and sum of their nearest entries."""
    listed = shortlists(chunk.lows[part], chunk.highs[part], book)
    alone = listed.sum(axis=1) == 1
    blocks = np.flatnonzero(alone)
    if len(blocks):
        entry = listed[blocks].argmax(axis=1)
        np.add.at(counts, entry, np.minimum(BLOCK, chunk.size - blocks * BLOCK))
        np.add.at(sums, entry, chunk.sums[part][blocks])
    points = chunk.points[part]
    rows, entry, _ = nearest(points, listed, book, np.flatnonzero(~alone))
    if len(rows):
        order = np.argsort(entry, kind="stable")
        found, starts = np.unique(entry[order], return_index=True)
        counts[found] += np.diff(np.append(starts, len(entry)))
        sums[found] += np.add.reduceat(points[rows[order]].astype(np.int64), starts, axis=0)


def first_books(kept: DataFrame) -> np.ndarray | None:
    """Codebooks from the smallest ids, (parts, entries, components); None without vectors."""

    def smallest(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row)
                vectors = np.empty((chunk.size, PARTS, chunk.wide), np.int64)
                for part in range(PARTS):
                    vectors[chunk.orders[part], part] = chunk.points[part]
                vectors = vectors.reshape(chunk.size, -1)
                ids = chunk.vec_ids.to_pylist()
                keys = [(i is None, i or 0) for i in ids]
                # Ties at the last place are all sent on; the vectors decide between them.
                edge = sorted(keys)[: ENTRIES][-1]
                rows = [i for i, key in enumerate(keys) if key < edge]
                rows += sorted((i for i, key in enumerate(keys) if key == edge), key=lambda i: tuple(vectors[i].tolist()))[:ENTRIES]
                yield pa.record_batch([pa.array([ids[i] for i in rows], pa.int64()), pa.array([chunk.length] * len(rows), pa.int32()), pa.array([vectors[i].tolist() for i in rows], pa.list_(pa.int64()))], ["vec_id", "length", "vector"])

    found = kept.mapInArrow(smallest, "vec_id long, length int, vector array<long>")
    order = [F.asc_nulls_last("vec_id"), "length", "vector"]
    first = found.orderBy(*order).limit(1).collect()
    if not first:
        return None
    rows = found.where(F.col("length") == first[0].length).orderBy(*order).limit(ENTRIES).collect()
    vectors = np.array([r.vector for r in rows], np.int64).reshape(len(rows), PARTS, -1)
    return first[0].length, np.ascontiguousarray(vectors.transpose(1, 0, 2))


def next_books(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks after one round."""
    sent = kept.sparkSession.sparkContext.broadcast(books)

    def totals(batches: Iterator[pa.RecordBatch]):
        books = sent.value
        parts, entries, wide = books.shape
        counts, sums = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, wide), np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row)
                for part in range(parts):
                    part_totals(chunk, part, books[part], counts[part], sums[part])
        part, entry = np.nonzero(counts)
        body = np.concatenate([counts[part, entry][:, None], sums[part, entry]], axis=1)
        columns = [np.repeat(x, wide + 1) for x in (part, entry)] + [np.tile(np.arange(wide + 1), len(part)), body.reshape(-1)]
        yield pa.record_batch([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "total"])

    rows = kept.mapInArrow(totals, "part long, entry long, place long, total long").groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).collect()
    found = np.zeros((*books.shape[:2], books.shape[2] + 1), np.int64)
    for r in rows:
        found[r.part, r.entry, r.place] = r.total
    counts = found[:, :, :1]
    return np.where(counts > 0, found[:, :, 1:] // np.maximum(counts, 1), books)


def trained(blocks: DataFrame, rounds: int = ROUNDS) -> tuple[int, np.ndarray] | None:
    """Vector length and codebooks after all rounds; None without vectors."""
    first = first_books(blocks.where("width > 0"))
    if first is None:
        return None
    length, books = first
    for _ in range(rounds):
        books = next_books(blocks.where((F.col("width") > 0) & (F.col("length") == length)), books)
    return length, books


HEX = np.array([f"{i:02x}" for i in range(256)], "S2")


def encoded(blocks: DataFrame, length: int, books: np.ndarray) -> DataFrame:
    """vec_id, label, code and error of every vector of the chunks."""
    sent = blocks.sparkSession.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]):
        books = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                chunk = Chunk(batch, row)
                codes, errors = pa.nulls(chunk.size, pa.string()), pa.nulls(chunk.size, pa.int64())
                if chunk.length == length and batch.column("width")[row].as_py():
                    own, error = np.zeros((chunk.size, PARTS), np.uint8), np.zeros(chunk.size, np.int64)
                    for part in range(PARTS):
                        listed = shortlists(chunk.lows[part], chunk.highs[part], books[part])
                        rows, entry, distance = nearest(chunk.points[part], listed, books[part], np.arange(len(listed)))
                        at = chunk.orders[part][rows]
                        own[at, part] = entry
                        error[at] += distance
                    codes = pa.array(HEX[own].view(f"S{2 * PARTS}").reshape(-1).astype(str), pa.string())
                    errors = pa.array(error)
                yield pa.record_batch([chunk.vec_ids, chunk.labels, codes, errors], ["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(encode, "vec_id long, label string, code string, error long")


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def decoded(codes: DataFrame, length: int, books: np.ndarray) -> DataFrame:
    """Codes as vectors again: vec_id and the entries' components over SCALE."""
    sent = codes.sparkSession.sparkContext.broadcast(books)

    def decode(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column("code")))
            own = np.frombuffer(bytes.fromhex("".join(batch.column("code").to_pylist())), np.uint8).reshape(-1, PARTS)
            vectors = sent.value[np.arange(PARTS), own].reshape(len(own), -1)[:, :length] / SCALE
            yield pa.record_batch([batch.column("vec_id"), pa.array(list(vectors), pa.list_(pa.float64()))], ["vec_id", "embedding"])

    return codes.select("vec_id", "code").mapInArrow(decode, "vec_id long, embedding array<double>")


def compressed(embeddings: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that counts."""
    blocks = written(chunks(embeddings), "vector-blocks")
    found = trained(blocks, rounds)
    length, books = found or (0, np.zeros((PARTS, 0, 0), np.int64))
    codes = encoded(blocks, length, books).withColumn("label", F.coalesce(F.concat(F.lit("="), "label"), F.lit("")))
    codes = written(codes, "vector-codes")
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    met = lookup(codes, written(by_label, "label-errors"), ["label"], "left")
    return met.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
