"""Token ids as canonical length-limited Huffman code, in blocks that decode on their own.

Documents are dealt by doc_id range and tokenized once, in order, into segments of whole
documents. All ids are counted; the counts, one row per id of the vocabulary, give code
lengths of at most LONGEST bits by package-merge. Segments are then rewritten as codes
with a checkpoint, the bit offset, every STRIDE ids. Blocks between checkpoints are
decoded side by side with one table of 2^LONGEST entries.

The files are Parquet folders below one path:
  codes     id, bits (code length; the codes follow from the lengths)
  segments  shard, segment, doc_ids, counts, n_ids, checkpoints (little-endian uint64),
            payload (codes, first bit of a byte is its highest)
Shards are in ascending doc_id order, segments of a shard and documents of a segment too.

A word between ASCII white space is tokenized once and remembered by the worker: the
tokenizer drops white space and no token crosses it. Words are found again by hash and held
byte by byte, in arrays. `whole_texts` turns that off for tokenizers of which this is not true.

Defined cases: null text is empty and gets the end id alone. Null doc_ids come first.
Equal doc_ids, which may be many, go by their texts' hashes and are dealt by them; a document of any length is in one segment. An empty table
writes empty files. Other columns are ignored.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postmill.llm.arrays import pieces, text_bytes, word_spans
from postmill.llm.known_ids import KINDS, LETTER, MARK, REMEMBERED, WORD, KnownIds, ranges, word_ids
from postmill.session import scratch_path

END_ID = 2
LONGEST = 18
STRIDE = 512
SEGMENT_IDS = 1 << 17
PIECE_BYTES = 1 << 20

ENCODED = "shard int, segment long, doc_ids array<long>, counts array<long>, n_ids long, checkpoints binary, payload binary"


class Encoder:
    """Ids of texts, each followed by the end id."""

    def __init__(self, tokenizer_path: str, end_id: int, whole_texts: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.end = end_id
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = whole_texts or not (self.tokenizer.normalizer and self.tokenizer.pre_tokenizer)
        # What plain words may be taken to mean: letters are folded and no other way of cutting words is known.
        self.plain = not self.whole and self.lowers_and_cuts()
        self.parts: dict[str, list[int]] = {}
        self.known = KnownIds(self.learn)

    def lowers_and_cuts(self) -> bool:
        """Whether the tokenizer lowers letters and reads letters, apostrophes and other marks apart, by trial."""
        normal = self.tokenizer.normalizer.normalize_str("AbÀÿß")
        found = [piece for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("ab.,cd's|é!")]
        return normal == "abàÿß" and found == ["ab", ".,", "cd", "'s", "|", "Ã©", "!"]

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one after the other, and the number of each.

        Words are normalised and cut together, parted by blanks; the model then sees
        every distinct piece once. Words that hold an added token or other white space
        are left to the tokenizer whole.
        """
        single = [i for i, w in enumerate(words) if self.plain and WORD.fullmatch(w)]
        done = set(single)
        rest = [i for i in range(len(words)) if i not in done]
        texts = {i: words[i].decode() for i in rest}
        together = [i for i, t in texts.items() if len(t.split()) == 1 and not any(a in t for a in self.added)]
        normal = self.tokenizer.normalizer.normalize_str(" ".join([texts[i] for i in together])) if together else ""
        sizes = [len(x) + 1 for x in normal.split(" ")] if together else []
        if len(sizes) != len(together):
            together = []
        number = np.zeros(len(words), np.int64)
        ids, number[: len(single)] = word_ids(self.tokenizer.model, [words[i] for i in single], lower=True)
        if together:
            if len(self.parts) > REMEMBERED:
                self.parts.clear()
            found = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
            for piece, _ in found:
                if piece not in self.parts:
                    self.parts[piece] = [t.id for t in self.tokenizer.model.tokenize(piece)]
            lists = [self.parts[piece] for piece, _ in found]
            ids += [i for x in lists for i in x]
            owner = np.searchsorted(np.cumsum(sizes), np.array([at for _, (at, _) in found], np.int64), side="right")
            number[len(single) : len(single) + len(together)] = np.bincount(owner, [len(x) for x in lists], len(together))
        done.update(together)
        apart = [i for i in rest if i not in done]
        for at, i in enumerate(apart, len(done)):
            own = self.tokenizer.encode(texts[i], add_special_tokens=False).ids
            ids += own
            number[at] = len(own)
        # From the order they were found in to the order they were asked for.
        place = np.argsort(np.array(single + together + apart, np.int64), kind="stable")
        starts = np.cumsum(number) - number
        return np.array(ids, np.uint32)[ranges(starts[place], number[place])], number[place]

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all texts, starts and ends of their units, and the first unit of each text.

        Units are words between white space, cut once more between an ASCII letter and ASCII punctuation
        other than an apostrophe, where the tokenizer parts them whatever stands around; not in a
        text that holds an added token.
        """
        data, offsets = text_bytes(texts)
        starts, ends, counts = word_spans(data, offsets)
        if not self.plain or not len(starts):
            return data, starts, ends, np.concatenate([[0], np.cumsum(counts)])
        kind = KINDS[data]
        marks = np.flatnonzero((kind[1:] == MARK) & (kind[:-1] == LETTER)) + 1
        for added in self.added:
            held = pc.fill_null(pc.match_substring(texts, added), False).to_numpy(zero_copy_only=False)
            if held.any():
                marks = marks[~held[np.searchsorted(offsets, marks, side="right") - 1]]
        first, last = np.zeros(len(data) + 1, bool), np.zeros(len(data) + 1, bool)
        first[starts] = first[marks] = last[ends] = last[marks] = True
        starts = np.flatnonzero(first)
        return data, starts, np.flatnonzero(last), np.searchsorted(starts, offsets)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the number of ids of each text."""
        if self.whole:
            found = self.tokenizer.encode_batch([t or "" for t in texts.to_pylist()], add_special_tokens=False)
            parts = [np.append(np.array(e.ids, np.uint32), np.uint32(self.end)) for e in found]
            return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.array([len(p) for p in parts], np.int64)
        data, starts, ends, first = self.units(texts)
        ids, sizes = self.known.ids_of(data, starts, ends)
        upto = np.concatenate([[0], np.cumsum(sizes)])[first]
        return np.insert(ids, upto[1:], self.end).astype(np.uint32), np.diff(upto) + 1


_encoders: dict[tuple, Encoder] = {}


def encoder_for(*key) -> Encoder:
    """The worker's encoder: what one task has learnt serves the next."""
    if key not in _encoders:
        _encoders[key] = Encoder(*key)
    return _encoders[key]


def code_lengths(counts: dict[int, int], longest: int = LONGEST) -> dict[int, int]:
    """Code length of each id, at most `longest`, with the least total size (package-merge)."""
    ids = sorted(counts, key=lambda i: (counts[i], i))
    if len(ids) > 1 << longest:
        raise ValueError(f"{len(ids)} ids do not fit codes of {longest} bits")
    if len(ids) < 2:
        return dict.fromkeys(ids, 1)
    weights = [counts[i] for i in ids]
    # A level's list holds leaves and packages of the level below, by weight. Only the
    # number of leaves among its first entries is needed to find the lengths.
    levels, packages = [], []
    for _ in range(longest):
        merged = list(heapq.merge(((w, 1) for w in weights), ((w, 0) for w in packages)))
        levels.append([leaf for _, leaf in merged])
        values = [w for w, _ in merged]
        packages = [a + b for a, b in zip(values[::2], values[1::2], strict=False)]
    lengths = np.zeros(len(ids), np.int64)
    take = 2 * (len(ids) - 1)
    for level in reversed(levels):
        leaves = sum(level[:take])
        lengths[:leaves] += 1
        take = 2 * (take - leaves)
    return dict(zip(ids, lengths.tolist(), strict=True))


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Code and length of each id, in arrays by id: by length, then id, counting up."""
    code = np.zeros(max(lengths, default=0) + 1, np.uint64)
    size = np.zeros(len(code), np.int64)
    value = before = 0
    for i in sorted(lengths, key=lambda i: (lengths[i], i)):
        value <<= lengths[i] - before
        code[i], size[i], before = value, lengths[i], lengths[i]
        value += 1
    return code, size


def decoding_table(lengths: dict[int, int], longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray]:
    """For every next `longest` bits: the id they begin with and its code's length."""
    code, size = canonical(lengths)
    ids, bits = np.zeros(1 << longest, np.uint32), np.zeros(1 << longest, np.int64)
    for i, n in lengths.items():
        start = int(code[i]) << (longest - n)
        ids[start : start + (1 << (longest - n))] = i
        bits[start : start + (1 << (longest - n))] = n
    return ids, bits


def pack(ids: np.ndarray, code: np.ndarray, size: np.ndarray, stride: int = STRIDE) -> tuple[bytes, np.ndarray]:
    """The ids' bits, and the bit offset of every stride-th id."""
    sizes = size[ids]
    ends = np.cumsum(sizes)
    starts = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    words = np.zeros(total // 64 + 2, np.uint64)
    at, shift = starts >> 6, 64 - (starts & 63) - sizes
    values = code[ids]
    high = np.where(shift >= 0, values << np.maximum(shift, 0).astype(np.uint64), values >> np.maximum(-shift, 0).astype(np.uint64))
    # Bits of different ids never overlap, so words are sums; equal places are neighbours.
    if len(at):
        edges = np.flatnonzero(np.diff(at, prepend=-1))
        words[at[edges]] = np.add.reduceat(high, edges)
    over = np.flatnonzero(shift < 0)
    words[at[over] + 1] |= values[over] << (64 + shift[over]).astype(np.uint64)
    return words.astype(">u8").tobytes()[: (total + 7) // 8], starts[::stride].astype("<u8")


def unpack(payload: bytes, checkpoints: np.ndarray, count: int, ids: np.ndarray, bits: np.ndarray, longest: int = LONGEST, stride: int = STRIDE) -> np.ndarray:
    """The ids of a payload: every block goes one id further at each step."""
    data = np.zeros(len(payload) + 8, np.uint8)
    data[: len(payload)] = np.frombuffer(payload, np.uint8)
    # 32 bits from every byte on: a code starts within the first 8 of them.
    window = (data[:-3].astype(np.uint32) << 24) | (data[1:-2].astype(np.uint32) << 16) | (data[2:-1].astype(np.uint32) << 8) | data[3:]
    at = checkpoints.astype(np.int64)
    out = np.zeros((stride, len(at)), np.uint32)
    full = count - (len(at) - 1) * stride if len(at) else 0
    for step in range(min(stride, count)):
        if step == full:
            at = at[:-1]
        key = (window[at >> 3] >> (32 - longest - (at & 7)).astype(np.uint32)) & np.uint32((1 << longest) - 1)
        out[step, : len(at)] = ids[key]
        at = at + bits[key]
    return out.T.reshape(-1)[:count]


def id_type(n_bytes: int, n_ids: int) -> type:
    """Plain ids take two bytes where the vocabulary allows it, else four."""
    return np.uint16 if n_bytes == 2 * n_ids else np.uint32


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int, whole_texts: bool) -> DataFrame:
    """Segments of plain ids in ascending doc_id order: shard, segment, doc_ids, counts, n_ids, ids."""

    def tokenize(batches: Iterator[pa.RecordBatch]):
        encoder = encoder_for(tokenizer_path, end_id, whole_texts)
        small = max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        doc_ids, counts, parts, held = [], [], [], 0

        def segment():
            ids = np.concatenate(parts).astype(np.uint16 if small else np.uint32)
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (doc_ids, counts)]
            return pa.record_batch([*lists, pa.array([len(ids)]), pa.array([ids.tobytes()])], ["doc_ids", "counts", "n_ids", "ids"])

        for batch in pieces(batches, "text", PIECE_BYTES):
            ids, own = encoder.encode(batch.column("text"))
            doc_ids += batch.column("doc_id").to_pylist()
            counts += own.tolist()
            parts.append(ids)
            held += len(ids)
            if held >= SEGMENT_IDS:
                yield segment()
                doc_ids, counts, parts, held = [], [], [], 0
        if doc_ids:
            yield segment()

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = given.repartitionByRange(*order[:2]).sortWithinPartitions(*order).select("doc_id", "text")
    found = ordered.mapInArrow(tokenize, "doc_ids array<long>, counts array<long>, n_ids long, ids binary")
    return found.select(F.spark_partition_id().alias("shard"), F.monotonically_increasing_id().alias("segment"), "*")


def count_ids(segments: DataFrame) -> dict[int, int]:
    """How often each id occurs: one number per id of the vocabulary."""

    def count(batches: Iterator[pa.RecordBatch]):
        total = np.zeros(1, np.int64)
        for batch in batches:
            for n, raw in zip(batch.column("n_ids").to_pylist(), batch.column("ids"), strict=True):
                body = raw.as_buffer()
                own = np.bincount(np.frombuffer(body, id_type(body.size, n)))
                if len(own) > len(total):
                    total = np.pad(total, (0, len(own) - len(total)))
                total[: len(own)] += own
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total[some])], ["id", "n"])

    rows = segments.select("n_ids", "ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()
    return {r.id: r.n for r in rows}


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID, longest: int = LONGEST, whole_texts: bool = False) -> None:
    """Encode docs and write codes and segments below path; plain ids are kept in the shared folder meanwhile."""
    spark = docs.sparkSession
    plain = scratch_path(spark, "plain-ids")
    tokenized(docs, tokenizer_path, end_id, whole_texts).write.option("compression", "zstd").parquet(plain)
    segments = spark.read.parquet(plain)
    lengths = code_lengths(count_ids(segments), longest)
    spark.createDataFrame(sorted(lengths.items()), "id long, bits int").coalesce(1).write.parquet(f"{path}/codes")
    sent = spark.sparkContext.broadcast(canonical(lengths))

    def encode(batches: Iterator[pa.RecordBatch]):
        code, size = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                n, body = batch.column("n_ids")[row].as_py(), batch.column("ids")[row].as_buffer()
                payload, checkpoints = pack(np.frombuffer(body, id_type(body.size, n)), code, size)
                rest = batch.slice(row, 1).drop_columns(["ids"])
                yield pa.RecordBatch.from_arrays([*rest.columns, pa.array([checkpoints.tobytes()]), pa.array([payload])], [*rest.schema.names, "checkpoints", "payload"])

    segments.mapInArrow(encode, ENCODED).write.option("compression", "uncompressed").parquet(f"{path}/segments")


def read_ids(spark: SparkSession, path: str, longest: int = LONGEST) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens, and ids_crc32 of its ids as decoded."""
    lengths = {r.id: r.bits for r in spark.read.parquet(f"{path}/codes").collect()}
    sent = spark.sparkContext.broadcast(decoding_table(lengths, longest))
    segments = spark.read.parquet(f"{path}/segments")

    # Segments and their ids are few; where each begins is a sum over shards, then within.
    sizes = segments.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    shards = sizes.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("shard_start"))
    within = F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment")) - F.col("n_ids")
    starts = segments.select("shard", "segment", "n_ids").withColumn("within", within).join(shards, "shard")
    starts = starts.select(F.col("segment").alias("of"), (F.col("shard_start") + F.col("within")).alias("segment_start"))

    def decode(batches: Iterator[pa.RecordBatch]):
        ids, bits = sent.value
        for batch in batches:
            for row in range(batch.num_rows):
                get = lambda name, row=row, batch=batch: batch.column(name)[row].as_py()
                found = unpack(get("payload"), np.frombuffer(get("checkpoints"), "<u8"), get("n_ids"), ids, bits, longest)
                counts = np.array(get("counts"), np.int64)
                ends = np.cumsum(counts)
                raw = memoryview(found.astype("<u4").tobytes())
                sums = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                columns = [pa.array(get("doc_ids"), pa.int64()), pa.array(ends - counts), pa.array(counts), pa.array(sums, pa.int64())]
                segment = pa.array(np.full(len(counts), get("segment"), np.int64))
                yield pa.record_batch([segment, *columns], ["segment", "doc_id", "inside", "n_tokens", "ids_crc32"])

    body = segments.select("segment", "doc_ids", "counts", "n_ids", "checkpoints", "payload")
    decoded = body.mapInArrow(decode, "segment long, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return decoded.join(starts, decoded["segment"] == starts["of"]).select("doc_id", (F.col("segment_start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def encoded(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write docs to the shared folder and read the files back."""
    path = scratch_path(docs.sparkSession, "ids")
    write_ids(docs, path, tokenizer_path, end_id)
    return read_ids(docs.sparkSession, path)
