"""Conversation repair: the cheapest edits that make roles read system?, (user, assistant)+, or nothing.

Rows are damaged by rule, marked with their first fault, dealt by conversation and read in
turn order as a stream. A repair is a path through a layered graph: a node is a row and the
role kept last, an edge one edit. Its weight is one big integer. The high digits add up
cost; below them every edit of the path has a digit of WIDTH bits, first edit highest, and
places not used yet are zero, so that a shorter audit is less than one that goes on. The
least integer into a node is then the least cost, and among equals the audit that comes
first in ASCII. Two paths into one node with equal cost never are one a prefix of the
other, since the longer one has paid for its inserts, so the least prefix stays least.

Digits that all living paths share are taken off and kept as text, so integers stay short
however long a conversation is; a path carries the running digest of its repaired text.
Memory is the audit, which is part of the result, and never the texts. One conversation is
one stream all the same: its digest runs over its text in order and cannot be split. Rows
that repeat are combined before they are dealt, and earlier copies are found by digests alone.

Defined cases: a null in any column is one space, but a null turn still comes first and a null
conv_id is a conversation of its own. Rows of one turn go by role, then text. A role's
initial is its first character, none for an empty role. A conversation whose rows are all
dropped has zeros and no text. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.operators.joins import lookup
from postmill.session import written

DAMAGES = 20
DROP, EMPTY, UNSTOP, REPEAT, USER = range(5)

NONE, BLANK, DUPLICATE, TRUNCATED, GONE = range(5)

REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3

#: Letters of an audit; their place is their digit, so digits order as ASCII does.
LETTERS = " DIKR"
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4
WIDTH = 3
SLOTS = 64

#: The role kept last. A user follows any but a user, an assistant only a user, a system only nothing.
START, S, U, A = range(4)
BEFORE = {"s": (S, (START,)), "u": (U, (START, S, A)), "a": (A, (U,))}
LEGAL = {"su", "ua", "au"}

WORDY = r"[^\x20\x09-\x0D]"
STOPPED = r"[.!?][\x20\x09-\x0D]*\z"

COLUMNS = ["conv_id", "turn", "role", "text"]
REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)


def given(conversations: DataFrame) -> DataFrame:
    """The four columns as they are judged, one copy of each row; nothing is damaged."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
        F.lit(1).cast("long").alias("copies"),
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """`given` after damage by conversation and turn; a dropped row stays with no copies."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % DAMAGES
    rows = given(conversations)
    text = F.when(kind == EMPTY, F.lit("")).when(kind == UNSTOP, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return rows.select(
        "conv_id",
        "turn",
        F.when(kind == USER, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(kind == DROP, F.lit("")).otherwise(text).alias("text"),
        F.when(kind == DROP, F.lit(0)).when(kind == REPEAT, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )


def said() -> Column:
    """Digest of what tells a row's words within the whole table: conversation, role and text."""
    conversation = F.coalesce(F.col("conv_id").cast("string"), F.lit("none"))
    return F.unhex(F.md5(F.concat_ws(":", conversation, F.length("role").cast("string"), "role", "text")))


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their first fault. Whether a text was there before is decided by digests and turns alone."""
    wordy = F.col("text").rlike(WORDY)
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.coalesce("turn", F.lit(0)).alias("turn"))
    light = rows.where((F.col("copies") > 0) & wordy).select(said().alias("said"), turn.alias("at"))
    several = light.groupBy("said").agg(F.min("at").alias("first"), F.max("at").alias("last")).where("first < last")
    again = written(several.select("said", "first"), "said-again")
    found = lookup(rows.withColumn("said", said()), again, ["said"], "left")
    fault = (
        F.when(F.col("copies") == 0, F.lit(GONE))
        .when(~wordy, F.lit(BLANK))
        .when(F.col("first") < turn, F.lit(DUPLICATE))
        .when(~F.col("text").rlike(STOPPED), F.lit(TRUNCATED))
        .otherwise(F.lit(NONE))
    )
    return found.select(*COLUMNS, fault.alias("fault"), "copies")


def combined(rows: DataFrame) -> DataFrame:
    """Equal rows of a batch as one row with their number, before they are shuffled."""

    def combine(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            table = pa.Table.from_batches([batch]).group_by([*COLUMNS, "fault"], use_threads=False).aggregate([("copies", "sum")])
            yield from table.rename_columns([*COLUMNS, "fault", "copies"]).combine_chunks().to_batches()

    return rows.select(*COLUMNS, "fault", "copies").mapInArrow(combine, "conv_id long, turn long, role string, text string, fault int, copies long")


class Path:
    """The best way into a node: its weight, number of edits and digest of the repaired text."""

    __slots__ = ("weight", "edits", "digest")

    def __init__(self, weight: int, edits: int, digest):
        self.weight, self.edits, self.digest = weight, edits, digest


class Repair:
    """Least paths over the rows of one conversation, fed in order."""

    def __init__(self):
        self.slots = SLOTS
        self.paths = {START: Path(0, 0, hashlib.sha256())}
        self.settled: list[str] = []
        self.settled_cost = 0

    def letters(self, digits: int, count: int) -> str:
        """The first `count` digits of a weight's low part as letters."""
        return "".join(LETTERS[digits >> WIDTH * (self.slots - 1 - i) & 7] for i in range(count))

    def make_room(self) -> None:
        """Take off the digits and cost that all paths share; if none are shared, widen the low part."""
        low = WIDTH * self.slots
        mask = (1 << low) - 1
        paths = list(self.paths.values())
        differing = 0
        for path in paths:
            differing |= (path.weight ^ paths[0].weight) & mask
        shared = min((low - differing.bit_length()) // WIDTH, min(p.edits for p in paths))
        least = min(p.weight >> low for p in paths)
        if shared:
            self.settled.append(self.letters(paths[0].weight & mask, shared))
        else:
            self.slots *= 2
        self.settled_cost += least
        for path in paths:
            cost, digits = (path.weight >> low) - least, path.weight & mask
            if shared:
                path.weight, path.edits = cost << low | (digits << WIDTH * shared) & mask, path.edits - shared
            else:
                path.weight = (cost << low | digits) << low

    def edge(self, cost: int, letter: int, edits: int) -> int:
        return (cost << WIDTH * self.slots) + (letter << WIDTH * (self.slots - 1 - edits))

    def best(self, paths: dict[int, Path], origins, cost: int, letter: int):
        """Weight and path of the least way on from these nodes by one edit."""
        ways = [(p.weight + self.edge(cost, letter, p.edits), p) for p in map(paths.get, origins) if p]
        return min(ways, key=lambda way: way[0], default=None)

    def step(self, into: dict[int, Path], node: int, way, spoken: bytes, first: bool) -> None:
        if way and (node not in into or way[0] < into[node].weight):
            digest = way[1].digest.copy()
            digest.update(spoken if first else b"\n" + spoken)
            into[node] = Path(way[0], way[1].edits + 1, digest)

    def insert(self) -> None:
        """Inserted rows at this place: a user, and an assistant behind any user."""
        paths = dict(self.paths)
        for node, origins, spoken in ((U, (START, S, A), b"user:"), (A, (U,), b"assistant:")):
            way = self.best(paths, origins, INSERT_COST, INSERT)
            if way:
                self.step(paths, node, way, spoken, way[1] is paths.get(START))
        self.paths = paths

    def feed(self, fault: int, role: bytes, text: bytes, initial: str) -> None:
        if max(p.edits for p in self.paths.values()) + 4 > self.slots:
            self.make_room()
        self.insert()
        paths = self.paths
        into = {node: Path(p.weight + self.edge(DELETE_COST, DELETE, p.edits), p.edits + 1, p.digest) for node, p in paths.items()}
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED_COST if fault == TRUNCATED else 0
            changes = [(*BEFORE["u"], REROLE_COST, REROLE, b"user"), (*BEFORE["a"], REROLE_COST, REROLE, b"assistant")]
            if initial in BEFORE:
                changes.insert(0, (*BEFORE[initial], 0, KEEP, role))
            for node, origins, cost, letter, name in changes:
                way = self.best(paths, origins, cost + extra, letter)
                if way:
                    self.step(into, node, way, name + b":" + text, way[1] is paths.get(START))
        self.paths = into

    def result(self) -> tuple[int, str, str]:
        """Cost, audit and digest of the least complete path."""
        if max(p.edits for p in self.paths.values()) + 2 > self.slots:
            self.make_room()
        self.insert()
        path = min((self.paths[n] for n in (START, A) if n in self.paths), key=lambda p: p.weight)
        low = WIDTH * self.slots
        self.settled.append(self.letters(path.weight & ((1 << low) - 1), path.edits))
        return self.settled_cost + (path.weight >> low), "".join(self.settled), path.digest.hexdigest()


class Conversation:
    """Counts and repair of one conversation, its rows fed in turn order."""

    def __init__(self, conv_id):
        self.conv_id, self.repair = conv_id, Repair()
        self.counts = [0] * 4
        self.illegal = self.turns = 0
        self.first = self.last = self.initial = self.before = None

    def feed(self, turn, role: bytes, text: bytes, fault: int, copies: int) -> None:
        if fault == GONE:
            return
        initial = role.decode()[:1]
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        again = BLANK if fault == BLANK else DUPLICATE
        row = (turn, role, text)
        for copy in range(copies):
            own = again if copy or row == self.before else fault
            self.illegal += self.initial is not None and self.initial + initial not in LEGAL
            self.initial = initial
            self.counts[own] += 1
            self.repair.feed(own, role, text, initial)
        self.before = row

    def result(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.counts[1:], self.illegal, *self.repair.result())


def in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(*[F.asc_nulls_first(c) for c in COLUMNS])


def repairs(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, and cost, audit and digest of its repair.

    rows: those of `given` or `damaged`.
    """

    def judge(batches: Iterator[pa.RecordBatch]):
        now, done = None, []
        for batch in batches:
            texts = (batch.column(c).cast(pa.binary()).to_pylist() for c in ("role", "text"))
            plain = (batch.column(c).to_pylist() for c in ("conv_id", "turn", "fault", "copies"))
            for conv_id, turn, fault, copies, role, text in zip(*plain, *texts, strict=True):
                if now is None or now.conv_id != conv_id:
                    if now:
                        done.append(now.result())
                    now = Conversation(conv_id)
                now.feed(turn, role, text, fault, copies)
            if done:
                yield report(done)
                done = []
        if now:
            yield report([now.result()])

    def report(done: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        names = [field.split()[0] for field in REPORT.split(", ")]
        return pa.record_batch([pa.array(x, t) for x, t in zip(zip(*done, strict=True), kinds, strict=True)], names)

    return in_order(combined(marked(rows))).mapInArrow(judge, REPORT)


def repaired(rows: DataFrame, reports: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, role, text.

    An audit tells all but what the kept rows say: an odd number of rows is left if and only if
    the first is a system row, and from there roles alternate.
    """

    def plan(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for conv_id, audit in zip(batch.column("conv_id").to_pylist(), batch.column("audit").to_pylist(), strict=True):
                system = (len(audit) - audit.count("D")) % 2
                place = row = 0
                out = []
                for letter in audit:
                    if letter != "D":
                        role = None if letter == "K" else ("user", "assistant")[(place + system) % 2]
                        out.append((conv_id, place, role, None if letter == "I" else row))
                        place += 1
                    row += letter != "I"
                for at in range(0, len(out), 1 << 16):
                    columns = zip(*out[at : at + (1 << 16)], strict=True)
                    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64())
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["conv_id", "place", "new_role", "row"])

    def number(batches: Iterator[pa.RecordBatch]):
        now, row = object(), 0
        for batch in batches:
            copies, first = batch.column("copies").to_pylist(), []
            for conv_id, n in zip(batch.column("conv_id").to_pylist(), copies, strict=True):
                row = row if conv_id == now else 0
                first.append(row)
                now, row = conv_id, row + n
            columns = [batch.column(c) for c in ("conv_id", "role", "text")]
            kept = pa.record_batch([*columns, pa.array(first, pa.int64())], ["own_id", "role", "text", "row"])
            yield kept.filter(pa.array([n > 0 for n in copies], pa.bool_()))

    edits = reports.select("conv_id", "audit").mapInArrow(plan, "conv_id long, place long, new_role string, row long")
    # Copies after the first are never kept, so a row's first number finds it.
    numbered = in_order(combined(marked(rows))).mapInArrow(number, "own_id long, role string, text string, row long")
    met = edits.join(numbered.withColumnRenamed("row", "own_row"), F.col("conv_id").eqNullSafe(F.col("own_id")) & (F.col("row") == F.col("own_row")), "left")
    return met.select("conv_id", "place", F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))
