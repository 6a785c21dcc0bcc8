"""Near-duplicate documents by BagMinHash over multisets of five-word shingles.

A shingle that occurs w times covers [0, w) of a weight axis cut into [0,1), [1,2),
[2,4), [4,8) ... On each piece runs a Poisson process whose points carry a signature
component and a place in the piece; a component keeps the earliest point that lies
below the shingle's weight. Points come in time order, so a shingle stops as soon as
it is later than the slowest component, and the few pieces replace w unit processes.
Two signatures agree in a component with the probability of the weighted Jaccard.

Bands of the signature bring candidates together. Within a band's bucket everyone is
held against the smallest member. What that leaves apart is compared pair by pair, by one
bit per component, where a bucket is small; only likely pairs leave the task. A large bucket's members
are held against a few heads and, while the bucket still holds several components, meet anew
under longer keys of two bands: texts that are alike share many bands (8 of 32 on
average at similarity 0.8), texts that share a common passage few. There each member goes to its
likeliest partner of another component. These steps only spare work: large buckets that still hold
several components after them are compared pair by pair too, in blocks, so that a task holds two blocks
whatever the size of a bucket. There the texts come with the members: a pair is verified where it is found, pairs that are
linked by others no more, and only links that join components leave the task, fewer than the block has members.
Candidates are verified on whole texts, and classes are connected components.

Nodes are distinct texts (by digest), so copies meet once and are never expanded.

Defined cases: null and empty texts are copies of each other and like nothing else.
A text of one to four words is one shingle. Rows without doc_id belong to the class
of their text; if no row of a class has one, class_id is null. Unlike texts that share a
doc_id are different classes, though class_id may be the same; first_of_class keeps one
document of each.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.llm.arrays import U64, distinct, mix, pieces, text_shingles
from postmill.llm.components import components
from postmill.session import written

WORDS = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 6
COMPONENTS = BANDS * ROWS
SKETCH = COMPONENTS // 64
# One-bit sketches of texts with similarity 0.8 differ in 19.2 of 192 bits on average,
# with standard deviation 4.2: five deviations are allowed.
MOST_BITS = 40
# A bucket of up to SMALL is compared whole. A larger one is held against HEADS of its
# members, and anew under keys that take in one of the next STRIDES bands more, LEVELS deep.
SMALL = 32
HEADS = 4
STRIDES = 2
LEVELS = 2
# What then is left of large buckets is compared whole, in blocks of about BLOCK members, CHUNK of them at once.
# A block also holds about BLOCK_BYTES of text at most, where more than one text is in it.
BLOCK = 2048
BLOCK_BYTES = 8 << 20
CHUNK = 256

SIGNED = "doc_id long, digest binary, bands array<long>, sketch array<long>"


def signatures(item: np.ndarray, owner: np.ndarray, weight: np.ndarray, texts: int, size: int = COMPONENTS) -> np.ndarray:
    """Earliest time per text and component (infinite where a text has no shingle)."""
    times = np.full(texts * size, np.inf)
    limit = np.full(texts, np.inf)
    rows, lowers, sizes = [], [], []
    lower, span = 0, 1
    while True:
        has = np.flatnonzero(weight > lower)
        if not len(has):
            break
        rows.append(has)
        lowers.append(np.full(len(has), lower, np.int64))
        sizes.append(np.full(len(has), span, np.int64))
        lower, span = lower + span, max(1, lower + span)
    if not rows:
        return times.reshape(texts, size)
    row, lower, span = (np.concatenate(x) for x in (rows, lowers, sizes))
    seed = mix(item[row] + mix(lower.astype(np.uint64) + U64(77)))
    doc, room, at = owner[row], np.minimum(weight[row] - lower, span), np.zeros(len(row))
    step = 0
    while len(seed):
        draw = mix(seed + U64(step * 0x9E3779B97F4A7C15 % (1 << 64)))
        at = at - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / span
        keep = at <= limit[doc]
        if not keep.all():
            seed, doc, room, span, at, draw = (x[keep] for x in (seed, doc, room, span, at, draw))
        mark = mix(draw ^ U64(0xA0761D6478BD642F))
        component = ((mark & U64(0xFFFFFFFF)) * U64(size)) >> U64(32)
        place = ((mark >> U64(32)) * span.astype(np.uint64)) >> U64(32)
        counts = place < room.astype(np.uint64)
        np.minimum.at(times, doc[counts] * size + component[counts].astype(np.int64), at[counts])
        if step < 8 or step % 8 == 0:
            open_ = np.unique(doc) if step >= 8 else slice(None)
            limit[open_] = times.reshape(texts, size)[open_].max(axis=1)
        step += 1
    return times.reshape(texts, size)


def sign(docs: DataFrame) -> DataFrame:
    """Signature bands and one-bit sketch of every text; none for a text without words."""

    def signed(batches):
        for batch in pieces(batches, "text"):
            values, owner = text_shingles(batch.column("text"), WORDS)
            values, owner, weight = distinct(values, owner)
            times = signatures(values, owner, weight, batch.num_rows)
            codes = mix(times.view(np.uint64) + np.arange(COMPONENTS, dtype=np.uint64) * U64(0xD1342543DE82EF95))
            band = np.zeros((batch.num_rows, BANDS), np.uint64)
            for i in range(ROWS):
                band = mix(band * U64(0xE7037ED1A0B428DB) + codes[:, i::ROWS])
            bits = (codes >> U64(63)).reshape(-1, SKETCH, 64)
            sketch = (bits << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
            none = np.isinf(times[:, 0])
            lists = [[None if n else x for n, x in zip(none, rows.view(np.int64).tolist(), strict=True)] for rows in (band, sketch)]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("digest"), *(pa.array(x, pa.list_(pa.int64())) for x in lists)],
                ["doc_id", "digest", "bands", "sketch"],
            )

    text = F.coalesce("text", F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.unhex(F.md5(text)).alias("digest"), text.alias("text"))
    return given.mapInArrow(signed, SIGNED)


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Pairs (a, b) of digests whose texts have at least this weighted Jaccard similarity."""
    left = texts.select(F.col("digest").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("digest").alias("b"), F.col("text").alias("text_b"))

    def check(batches):
        for batch in pieces(pieces(batches, "text_a"), "text_b"):
            keys = []
            for name in ("text_a", "text_b"):
                values, owner = text_shingles(batch.column(name), WORDS)
                values, owner, weight = distinct(values, owner)
                keys.append((values, owner, weight))
            values = np.concatenate([keys[0][0], keys[1][0]])
            owner = np.concatenate([keys[0][1], keys[1][1]])
            weight = np.concatenate([keys[0][2], keys[1][2]])
            order = np.lexsort((values, owner))
            values, owner, weight = values[order], owner[order], weight[order]
            same = np.flatnonzero((values[1:] == values[:-1]) & (owner[1:] == owner[:-1]))
            shared = np.bincount(owner[same], np.minimum(weight[same], weight[same + 1]), batch.num_rows)
            total = np.bincount(owner, weight, batch.num_rows)
            good = shared >= similarity * (total - shared) - 1e-9
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(good & (total > 0)))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(check, "a binary, b binary")


def _bits(one, other):
    """In how many bits two sketches differ."""
    return sum((F.bit_count(F.get(one, F.lit(i)).bitwiseXOR(F.get(other, F.lit(i)))) for i in range(1, SKETCH)), F.bit_count(F.get(one, F.lit(0)).bitwiseXOR(F.get(other, F.lit(0)))))


def _pairs_within(members: DataFrame, likeliest: bool) -> DataFrame:
    """Likely pairs of different components within buckets of at most SMALL members; of each member all, or its likeliest."""
    placed = members.select("key", "digest", "component", "sketch").repartition("key").sortWithinPartitions("key")

    def compare(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            edges = np.flatnonzero(np.diff(table["key"].to_numpy())) + 1
            last = int(edges[-1]) if len(edges) else 0
            rest = table.slice(last)
            if last:
                yield from pairs_in(table.slice(0, last), np.concatenate([[0], edges]))
        if rest is not None and len(rest):
            yield from pairs_in(rest, np.array([0, len(rest)]))

    def pairs_in(table, edges):
        codes: dict[bytes, int] = {}
        component = np.array([codes.setdefault(x, len(codes)) for x in table["component"].to_pylist()])
        digests = table["digest"].to_pylist()
        sketch = np.array(table["sketch"].to_pylist(), np.int64).view(np.uint64).reshape(-1, SKETCH)
        found = set()
        sizes = np.diff(edges)
        for size in np.unique(sizes).tolist():
            every = edges[:-1][sizes == size][:, None] + np.arange(size)
            for start in range(0, len(every), 256):
                at = every[start : start + 256]
                own, of = sketch[at], component[at]
                bits = np.bitwise_count(own[:, :, None] ^ own[:, None]).sum(axis=3, dtype=np.int64)
                bits[of[:, :, None] == of[:, None]] = 64 * SKETCH
                if likeliest:
                    other = bits.argmin(axis=2)
                    bucket, x = np.nonzero(np.take_along_axis(bits, other[:, :, None], axis=2)[:, :, 0] <= MOST_BITS)
                    y = other[bucket, x]
                else:
                    bucket, x, y = np.nonzero(bits <= MOST_BITS)
                found.update((digests[i], digests[k]) for i, k in zip(at[bucket, x].tolist(), at[bucket, y].tolist(), strict=True))
        if found:
            a, b = zip(*sorted((min(p), max(p)) for p in found), strict=True)
            yield pa.record_batch([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return placed.mapInArrow(compare, "a binary, b binary").distinct()


def _pairs_with_heads(members: DataFrame, large: DataFrame) -> DataFrame:
    """Likely pairs of a large bucket's members with its heads; of each text the likeliest with each component."""
    held = F.transform(F.array_distinct("heads"), lambda h: F.struct(_bits("sketch", h["sketch"]).alias("bits"), h["digest"].alias("digest"), h["component"].alias("component")))
    likely = F.filter(held, lambda h: (h["component"] != F.col("component")) & (h["bits"] <= MOST_BITS))
    near = members.join(large, "key").select("digest", F.explode(likely).alias("head"))
    best = near.groupBy("digest", F.col("head.component").alias("of")).agg(F.min(F.struct("head.bits", "head.digest")).alias("b"))
    return best.select(F.least("digest", "b.digest").alias("a"), F.greatest("digest", "b.digest").alias("b")).distinct()


def _pairs_in_blocks(members: DataFrame, sizes: DataFrame, block: int, similarity: float | None = None) -> DataFrame:
    """All likely pairs of different components within buckets (key, size) of any size.

    A bucket's members are dealt over blocks, and each two blocks, or one with itself, meet in a cell.
    With `similarity` members come with their text and sizes with their bytes, and instead of the pairs those
    links leave a cell that join its components as all of its links would.
    """
    blocks = F.ceil(F.col("size") / block).cast("int")
    if similarity is not None:
        blocks = F.greatest(blocks, F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int"))
    own = F.pmod(F.xxhash64("digest", F.lit("block")), blocks).cast("int")
    placed = members.join(sizes, "key").withColumn("own", own)
    columns = ["digest", "component", "sketch", *(["text"] if similarity is not None else [])]
    placed = placed.select("key", *columns, "own", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    cell = F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))
    rows = placed.select(cell.alias("cell"), *columns, (F.col("own") <= F.col("other")).alias("low"), (F.col("own") >= F.col("other")).alias("high"))
    rows = rows.repartition("cell").sortWithinPartitions("cell")

    def compare(batches):
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            edges = [0, *(np.flatnonzero(np.diff(table["cell"].to_numpy())) + 1).tolist()]
            for start, end in zip(edges[:-1], edges[1:], strict=True):
                yield from pairs_in(table.slice(start, end - start))
            rest = table.slice(edges[-1])
        if rest is not None and len(rest):
            yield from pairs_in(rest)

    def pairs_in(table):
        codes: dict[bytes, int] = {}
        component = np.array([codes.setdefault(x, len(codes)) for x in table["component"].to_pylist()])
        if len(codes) < 2:
            return
        digests = np.array(table["digest"].to_pylist(), object)
        sketch = np.array(table["sketch"].to_pylist(), np.int64).view(np.uint64).reshape(-1, SKETCH)
        low, high = (np.flatnonzero(table[side].to_numpy()) for side in ("low", "high"))
        linked = None if similarity is None else _links_among(table.select(["text"]), component, similarity)
        for start in range(0, len(low), CHUNK):
            at = low[start : start + CHUNK]
            bits = sum(np.bitwise_count(sketch[at, i][:, None] ^ sketch[high, i]).astype(np.int16) for i in range(SKETCH))
            x, y = np.nonzero((bits <= MOST_BITS) & (component[at][:, None] != component[high]))
            x, y = at[x], high[y]
            if linked is not None:
                x, y = linked(x, y)
            one, other = digests[x], digests[y]
            if len(one):
                swap = one > other
                a, b = np.where(swap, other, one), np.where(swap, one, other)
                yield pa.record_batch([pa.array(a.tolist(), pa.binary()), pa.array(b.tolist(), pa.binary())], ["a", "b"])

    return rows.mapInArrow(compare, "a binary, b binary").distinct()


def _links_among(texts: pa.Table, component: np.ndarray, similarity: float):
    """A function that of pairs (x, y) of these texts, x ascending, gives links that join their components as all do.

    Joined components get one number in `component`, and pairs within one are not verified.
    """
    parts, seen = [], 0
    for piece in pieces(texts.to_batches(), "text"):
        values, owner, weight = distinct(*text_shingles(piece.column("text"), WORDS))
        parts.append((values, owner + seen, weight))
        seen += piece.num_rows
    values, owner, weight = (np.concatenate(x) for x in zip(*parts, strict=True))
    codes = np.unique(values, return_inverse=True)[1]
    bounds = np.searchsorted(owner, np.arange(seen + 1))
    total = np.bincount(owner, weight, seen)
    held = np.zeros(len(values), np.int64)

    def links(x, y):
        found = []
        edges = [*np.flatnonzero(np.diff(x, prepend=-1)).tolist(), len(x)]
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            one, others = x[start], y[start:end]
            others = others[component[others] != component[one]]
            if not len(others):
                continue
            own = slice(bounds[one], bounds[one + 1])
            held[codes[own]] = weight[own]
            lengths = bounds[others + 1] - bounds[others]
            before = np.cumsum(lengths) - lengths
            at = np.repeat(bounds[others] - before, lengths) + np.arange(lengths.sum())
            shared = np.bincount(np.repeat(np.arange(len(others)), lengths), np.minimum(held[codes[at]], weight[at]), len(others))
            held[codes[own]] = 0
            both = total[one] + total[others]
            for other in others[(shared >= similarity * (both - shared) - 1e-9) & (both > 0)]:
                if component[other] != component[one]:
                    component[component == component[other]] = component[one]
                    found.append((one, other))
        return (np.array(side, np.int64) for side in (zip(*found, strict=True) if found else ((), ())))

    return links


def _named(met: DataFrame, known: DataFrame) -> DataFrame:
    """Bucket members with their components, in buckets that hold several."""
    named = met.join(known.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    named = written(named, "named")
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    return written(named.join(mixed, "key", "left_semi"), "members")


def _longer_keys(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Members of large buckets under longer keys: their band's and that of one of the next STRIDES bands."""
    bands = members.join(nodes.select("digest", "bands"), "digest")
    last = F.transform(
        F.sequence(F.lit(1), F.lit(STRIDES)),
        lambda s: F.struct(F.xxhash64("key", s, F.get("bands", ((F.col("band") + s) % BANDS).cast("int"))).alias("key"), ((F.col("band") + s) % BANDS).cast("int").alias("band")),
    )
    return bands.select("digest", "sketch", F.explode(last).alias("k")).select("k.key", "k.band", "digest", "sketch")


def classes(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, digest of its text, component (smallest digest of its class) and class_id (smallest doc_id)."""
    signed = written(sign(docs), "signed")
    nodes = signed.groupBy("digest").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "bands", "sketch")).alias("r"))
    nodes = written(nodes.select("digest", "r.doc_id", "r.bands", "r.sketch"), "nodes")
    banded = nodes.where("bands is not null").select("digest", "sketch", F.posexplode("bands").alias("band", "value"))
    banded = banded.select(F.xxhash64("band", "value").alias("key"), "band", "digest", "sketch")
    buckets = banded.groupBy("key").agg(F.min(F.struct("digest", "sketch")).alias("first"), F.count("*").alias("size")).where("size > 1").drop("size")
    met = written(banded.join(buckets, "key"), "met")

    # Texts that meet any other, once each.
    wanted = met.groupBy("digest").count().join(nodes.select("digest", "doc_id"), "digest").drop("count")
    text = F.coalesce("text", F.lit(""))
    given = docs.select(F.col("doc_id").cast("long").alias("own_id"), F.unhex(F.md5(text)).alias("own"), text.alias("text"))
    texts = given.join(wanted, F.col("own_id").eqNullSafe(F.col("doc_id")) & (F.col("own") == F.col("digest")))
    texts = written(texts.dropDuplicates(["digest"]).select("digest", "text", F.octet_length("text").alias("bytes")), "texts")

    # First every text against the likeliest of its buckets' smallest members.
    near = met.where("digest <> first.digest").withColumn("bits", _bits("sketch", "first.sketch")).where(F.col("bits") <= MOST_BITS)
    best = near.groupBy("digest").agg(F.min(F.struct("bits", "first.digest")).alias("b"))
    tried = written(best.select(F.col("b.digest").alias("a"), F.col("digest").alias("b")), "tried")
    links = written(verified(tried, texts, similarity), "links")
    known = written(components(links, "a", "b"), "known")

    # Then what is left between components within buckets: all of a small bucket, and a
    # large one's members with HEADS of them and under longer keys.
    tried = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    whole = met = met.drop("first")
    for level in range(LEVELS):
        members = _named(met, known)
        if members.isEmpty():
            break
        row = F.struct("digest", "component", "sketch")
        heads = [F.min(F.struct(F.xxhash64("digest", F.lit(salt)), row.alias("row")))["row"] for salt in range(HEADS)]
        sizes = members.groupBy("key").agg(F.count("*").alias("size"), F.array(*heads).alias("heads")).where(F.col("size") > SMALL)
        large = written(sizes.select("key", "heads"), "large")
        small = members.join(large.select("key"), "key", "left_anti")
        pairs = _pairs_within(small, level > 0).unionByName(_pairs_with_heads(members, large)).distinct()
        pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "pairs")
        more = written(verified(pairs, texts, similarity), "more-links")
        if not more.isEmpty():
            links = links.unionByName(more)
            known = written(components(links, "a", "b"), "known")
        tried = tried.unionByName(pairs)
        if large.isEmpty():
            break
        if level + 1 < LEVELS or level == 0:
            left = written(members.join(large.select("key"), "key", "left_semi").drop("component"), "left")
            whole = left if level == 0 else whole
            met = _longer_keys(left, nodes)

    # Last, large buckets that still hold several components: every likely pair, verified in its block.
    members = _named(whole, known)
    sizes = members.join(texts.select("digest", "bytes"), "digest").groupBy("key").agg(F.count("*").alias("size"), F.sum("bytes").alias("bytes"))
    sizes = written(sizes.where(F.col("size") > SMALL), "sizes")
    more = written(_pairs_in_blocks(members.join(texts.select("digest", "text"), "digest"), sizes, BLOCK, similarity), "last-links")
    joined = known if more.isEmpty() else components(links.unionByName(more), "a", "b")

    of = nodes.select("digest", "doc_id").join(joined.withColumnRenamed("node", "digest"), "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    least = of.groupBy("component").agg(F.min("doc_id").alias("class_id"))
    of = of.join(least, "component").select("digest", "component", "class_id")
    return signed.select("doc_id", "digest").join(of, "digest")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id and class_id of every document."""
    return classes(docs, similarity).select("doc_id", "class_id")


def first_of_class(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The documents, one of each class: that with the smallest doc_id, then digest.

    Of rows that repeat both doc_id and text the smallest by all columns stays. Columns may have any names and
    any types that can be compared.
    """
    of = written(classes(docs, similarity), "classes")
    kept = of.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")).alias("r"))
    kept = kept.select(F.col("r.doc_id").alias("kept_id"), F.col("r.digest").alias("kept_digest"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    given = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("id"), F.unhex(F.md5(F.coalesce("text", F.lit("")))).alias("digest"))
    same = F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("digest") == F.col("kept_digest"))
    return given.join(kept, same, "left_semi").groupBy("id", "digest").agg(F.min("row").alias("row")).select("row.*")
