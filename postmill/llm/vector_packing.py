"""Vector best-fit packing of token sequences under token, document and attention capacities.

A document's ids end with the end id. Documents longer than a sequence are cut, the first
piece taking what is left over. A piece asks for three things: tokens, one document, and
its attention cost, the square of its tokens. Pieces are packed longest first; a piece goes
to the open sequence that every capacity lets it into and that fits best: with the least
weighted norm of what is left afterwards, or the least weighted dot product of the piece with what is
left. A thing's weight is the share of its capacity that all pieces ask for together,
so what is scarce counts most.

What a piece asks for follows from its length alone. So the plan is made from the number of
pieces of each length, at most a sequence's tokens of them whatever the data: equal
sequences are one run, and a run is filled in one step, which gives the same result as piece after
piece, because a sequence just filled further always fits the next equal piece best. The plan
says which ranks among the pieces of a length go where. Ranks come from a count within
each task that wrote pieces and one sum per task and length before it; pieces are not sorted.

Defined cases: null text is empty and is one piece, the end id alone. Rows that repeat, and rows
without doc_id, are packed each. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postmill.llm.arrays import pieces as cut_batches
from postmill.llm.arrays import text_bytes
from postmill.llm.known_ids import KINDS, LETTER, LINE, MARK, OTHER, SPACE, WORD, KnownIds, ranges, word_ids
from postmill.operators.joins import lookup
from postmill.session import written

END_ID = 2
TOKENS = 1024
PIECE_BYTES = 1 << 20
TOGETHER = 4096
RANK_BITS = 40

# White space the tokenizer knows beside ASCII's.
OTHER_SPACE = "[\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}\\x{1C}-\\x{1F}]"

PIECES = "doc_id long, piece int, start long, length long, rank long, ids binary"


@dataclass(frozen=True)
class Capacity:
    """What a sequence holds at most. Where not given, documents and cost follow from the tokens and never bind."""

    tokens: int = TOKENS
    documents: int | None = None
    cost: int | None = None

    def vector(self) -> np.ndarray:
        documents = self.tokens if self.documents is None else self.documents
        return np.array([self.tokens, documents, self.tokens**2 if self.cost is None else self.cost], np.int64)

    def longest_piece(self) -> int:
        return min(self.tokens, isqrt(int(self.vector()[2])))


class ByteEncoder:
    """Ids of texts by a byte-level tokenizer, from units it never merges across.

    The tokenizer's words part, whatever stands around, before a single space and on both sides of a single
    line feed between characters that are no white space, and between an ASCII letter and ASCII
    punctuation other than an apostrophe; units end there. A text with other white space or an
    added token goes to the tokenizer whole.
    """

    def __init__(self, path: str, end_id: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.end = end_id
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.known = KnownIds(self.learn)

    def odd(self, texts: pa.Array) -> np.ndarray:
        """Texts that hold white space beside ASCII's or an added token."""
        found = pc.match_substring_regex(texts, OTHER_SPACE)
        for added in self.added:
            found = pc.or_(found, pc.match_substring(texts, added))
        return pc.fill_null(found, False).to_numpy(zero_copy_only=False)

    def learn(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units, one after the other, and the number of each.

        A unit of letters is one word, which the model takes as it is. Others that neither begin with
        white space, but for one space, nor end with it are encoded together, parted by line
        feeds: each is then read as it is on its own.
        """
        single = [i for i, w in enumerate(words) if WORD.fullmatch(w)]
        done = set(single)
        rest = [i for i in range(len(words)) if i not in done]
        texts = {i: words[i].decode() for i in rest}
        plain = ~self.odd(pa.array(list(texts.values()), pa.string()))
        together = [i for i, p in zip(rest, plain.tolist(), strict=True) if p and (t := texts[i]) and not t[-1].isspace() and not t[t[0] == " "].isspace()]
        number = np.zeros(len(words), np.int64)
        ids, number[: len(single)] = word_ids(self.tokenizer.model, [words[i] for i in single])
        found = [np.array(ids, np.uint32)]
        for at in range(0, len(together), TOGETHER):
            own = together[at : at + TOGETHER]
            at += len(single)
            encoding = self.tokenizer.encode("\n".join([texts[i] for i in own]), add_special_tokens=False)
            ends = np.cumsum([len(texts[i]) + 1 for i in own])
            first = np.array([a for a, _ in encoding.offsets], np.int64)
            owner = np.searchsorted(ends, first, side="right")
            inside = first < ends[owner] - 1
            found.append(np.array(encoding.ids, np.uint32)[inside])
            number[at : at + len(own)] = np.bincount(owner[inside], minlength=len(own))
        done.update(together)
        apart = [i for i in rest if i not in done]
        for at, encoding in enumerate(self.tokenizer.encode_batch([texts[i] for i in apart], add_special_tokens=False), len(done)):
            found.append(np.array(encoding.ids, np.uint32))
            number[at] = len(encoding.ids)
        # From the order they were found in to the order they were asked for.
        place = np.argsort(np.array(single + together + apart, np.int64), kind="stable")
        starts = np.cumsum(number) - number
        return np.concatenate([np.zeros(0, np.uint32), *found])[ranges(starts[place], number[place])], number[place]

    def units(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes of all texts, starts and ends of their units, and the first unit of each text."""
        data, offsets = text_bytes(texts)
        kind = KINDS[data]
        between = np.flatnonzero((kind[1:-1] >= SPACE) & (kind[:-2] < SPACE) & (kind[2:] < SPACE)) + 1
        line = between[kind[between] == LINE]
        between = between[kind[between] != OTHER]
        marks = np.flatnonzero((kind[1:] == MARK) & (kind[:-1] == LETTER)) + 1
        cuts = np.zeros(len(data) + 1, bool)
        cuts[between] = cuts[line + 1] = cuts[marks] = True
        # White space that begins or ends a text may be cut off too, whatever stands in the next text.
        for i in np.flatnonzero(self.odd(texts)).tolist():
            cuts[offsets[i] : offsets[i + 1]] = False
        cuts[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        starts = np.flatnonzero(cuts[:-1])
        return data, starts, np.append(starts[1:], len(data))[: len(starts)], np.searchsorted(starts, offsets)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, each text's followed by the end id, and the number of ids of each text."""
        data, starts, ends, first = self.units(texts)
        ids, sizes = self.known.ids_of(data, starts, ends)
        upto = np.concatenate([[0], np.cumsum(sizes)])[first]
        return np.insert(ids, upto[1:], self.end).astype(np.uint32), np.diff(upto) + 1


_encoders: dict[tuple, ByteEncoder] = {}


def encoder_for(*key) -> ByteEncoder:
    """The worker's encoder: what one task has learnt serves the next."""
    if key not in _encoders:
        _encoders[key] = ByteEncoder(*key)
    return _encoders[key]


def cut_lengths(totals: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts with these many ids: the pieces' text, number and length; the first takes what is left over."""
    counts = -(-totals // longest)
    owner = np.repeat(np.arange(len(totals)), counts)
    number = ranges(np.zeros(len(counts), np.int64), counts)
    return owner, number, np.where(number == 0, totals[owner] - (counts[owner] - 1) * longest, longest)


def token_pieces(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, longest: int = TOKENS) -> DataFrame:
    """Pieces with their ids, the task that cut them and their rank among that task's pieces of equal length."""

    def cut(batches: Iterator[pa.RecordBatch]):
        encoder = encoder_for(tokenizer_path, end_id)
        kind = "<u2" if max(encoder.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4"
        met = np.zeros(longest + 1, np.int64)
        for batch in cut_batches(batches, "text", PIECE_BYTES):
            ids, totals = encoder.encode(batch.column("text"))
            owner, number, length = cut_lengths(totals, longest)
            order = np.argsort(length, kind="stable")
            values, first, own = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(length), np.int64)
            rank[order] = ranges(met[values], own)
            met[values] += own
            ends = np.cumsum(length)
            texts = np.cumsum(totals) - totals
            width = int(kind[2])
            body = pa.Array.from_buffers(
                pa.large_binary(), len(length), [None, pa.py_buffer(np.concatenate([[0], ends]) * width), pa.py_buffer(ids.astype(kind))]
            )
            columns = [batch.column("doc_id").take(pa.array(owner)), pa.array(number.astype(np.int32)), pa.array(ends - length - texts[owner])]
            yield pa.record_batch([*columns, pa.array(length), pa.array(rank), body.cast(pa.binary())], [f.split()[0] for f in PIECES.split(", ")])

    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return given.mapInArrow(cut, PIECES).withColumn("task", F.spark_partition_id())


def best_fit(histogram: dict[int, int], capacity: Capacity = Capacity(), rule: str = "norm") -> np.ndarray:
    """The plan for so many pieces of each length: rows (length, first rank, pieces, pieces per
    sequence, first sequence, offset in it), by length and rank.

    A run is neighbouring sequences with the same content so far. A step fills the best run, or new
    sequences where no run has room, with as many pieces each as fit.
    """
    room = capacity.vector()
    lengths = sorted(histogram, reverse=True)
    asked = np.array([[n, 1, n * n] for n in lengths], np.int64).reshape(-1, 3)
    load = (asked * np.array([histogram[n] for n in lengths], np.int64)[:, None]).sum(axis=0) / room
    weight = load / load.sum() if lengths else load
    shortest = asked[-1] if lengths else room
    # Open runs: sequences, first sequence and what is left of each capacity.
    runs = np.zeros((0, 2), np.int64)
    left = np.zeros((0, 3), np.int64)
    plan, opened = [], 0
    for length, want in zip(lengths, asked, strict=True):
        count, rank = histogram[length], 0
        while count:
            fits = np.flatnonzero((left >= want).all(axis=1))
            if len(fits):
                after = (left[fits] - want) / room
                score = (weight * after**2).sum(axis=1) if rule == "norm" else (weight * (want / room) * after).sum(axis=1)
                run = int(fits[np.lexsort((runs[fits, 1], score))[0]])
                each = int((left[run] // want).min())
            else:
                each = int((room // want).min())
                runs = np.vstack([runs, [-(-count // each), opened]])
                left = np.vstack([left, room])
                opened += -(-count // each)
                run = len(runs) - 1
            each = min(each, count)
            sequences, first = runs[run].tolist()
            used = min(sequences, count // each)
            before = left[run].copy()
            plan.append((length, rank, used * each, each, first, int(room[0] - before[0])))
            count, rank = count - used * each, rank + used * each
            left[run] = before - each * want
            runs[run] = used, first
            if used < sequences:
                runs = np.vstack([runs, [sequences - used, first + used]])
                left = np.vstack([left, before])
        live = (left >= shortest).all(axis=1)
        runs, left = runs[live], left[live]
    rows = np.array(plan, np.int64).reshape(-1, 6)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def placed(pieces: DataFrame, capacity: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """Pieces with sequence_id and offset. pieces: a written table of `token_pieces` or some of its columns."""
    sizes = written(pieces.groupBy("task", "length").agg(F.count("*").alias("pieces")), "piece-sizes")
    histogram = {r.length: r.pieces for r in sizes.groupBy("length").agg(F.sum("pieces").alias("pieces")).collect()}
    earlier = F.sum("pieces").over(Window.partitionBy("length").orderBy("task")) - F.col("pieces")
    earlier = written(sizes.select("task", "length", earlier.alias("earlier")), "pieces-before")
    sent = pieces.sparkSession.sparkContext.broadcast(best_fit(histogram, capacity, rule))

    def place(batches: Iterator[pa.RecordBatch]):
        plan = sent.value
        keys = plan[:, 0] << RANK_BITS | plan[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, length << RANK_BITS | rank, side="right") - 1
            _, first, _, each, sequence, offset = plan[at].T
            inside = rank - first
            added = [pa.array(sequence + inside // each), pa.array(offset + inside % each * length)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], [*batch.schema.names, "sequence_id", "offset"])

    ranked = lookup(pieces, earlier, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("earlier")).drop("earlier")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ranked.schema)
    return ranked.mapInArrow(place, f"{fields}, sequence_id long, offset long").drop("task", "rank")


def with_checksums(pieces: DataFrame) -> DataFrame:
    """ids_crc32, over the ids as four bytes each, instead of the ids."""

    def check(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            sums = []
            for n, raw in zip(batch.column("length").to_pylist(), batch.column("ids"), strict=True):
                body = raw.as_buffer()
                sums.append(zlib.crc32(np.frombuffer(body, f"<u{body.size // n}").astype("<u4")))
            rest = batch.drop_columns(["ids"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(sums, pa.int64())], [*rest.schema.names, "ids_crc32"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema if f.name != "ids")
    return pieces.mapInArrow(check, f"{fields}, ids_crc32 long")


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences of `placed` pieces with ids: sequence_id, doc_ids, lengths, ids (little-endian, two or four bytes each)."""
    piece = F.struct("offset", "doc_id", "length", F.hex("ids").alias("ids"))
    held = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("p"))
    return held.select("sequence_id", F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"), F.unhex(F.array_join("p.ids", "")).alias("ids"))


def packed(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """Pieces of all documents with their ids and places; ids are written once to the shared folder."""
    pieces = written(token_pieces(docs, tokenizer_path, end_id, capacity.longest_piece()), "pieces")
    return placed(pieces, capacity, rule)


def packing_report(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID, capacity: Capacity = Capacity(), rule: str = "norm") -> DataFrame:
    """As `packed`, with a checksum in place of the ids, which do not travel."""
    pieces = written(token_pieces(docs, tokenizer_path, end_id, capacity.longest_piece()), "pieces")
    return placed(with_checksums(pieces), capacity, rule)
