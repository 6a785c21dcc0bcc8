import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from postmill.llm import vector_packing as vp
from postmill.llm.known_ids import KnownIds
from postmill.llm.vector_packing import Capacity

SCHEMA = "doc_id long, text string, length string, rank string, task string"


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path())


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "a \nb", "a\n b", "don't 's 'S", "<|endoftext|>", "a <|endoftext|> b", "x <|endof text|>"]
ODD += ["a  b", "a  b", "　 a 　", "a   b c", "é à  ü", "1 2 34 5.6", "\x1c a \x1d b", "tab\t a", "日本 語", "😀 😀😀", "x" * 300, "x " * 900]
ODD += ["a " + "b" * 100 + " a", "\x85 a", "a \x0bb", "a. b, c! (d) 'e'", "​ a ​b", "᠎ a᠎ b"]


def texts(seed, n):
    rng = random.Random(seed)
    alphabet = ["a", "be", "cé", " ", " ", " ", "  ", "\n", ".", "'s", "1", " ", " ", "<|endoftext|>", "ß", "\t"]
    common = alphabet[:6] + [".", "1"]
    return ["".join(rng.choice(alphabet if rng.random() < 0.3 else common) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_ids_equal_the_tokenizer(monkeypatch):
    monkeypatch.setattr("postmill.llm.known_ids.REMEMBERED", 50)
    own, plain = vp.ByteEncoder(path(), 2), tokenizer()
    own.known.most = 50
    rows = ODD + texts(1, 4000)
    for at in range(0, len(rows), 500):
        batch = rows[at : at + 500]
        ids, counts = own.encode(pa.array([t or "" for t in batch]))
        want = [e.ids + [2] for e in plain.encode_batch([t or "" for t in batch], add_special_tokens=False)]
        assert np.split(ids, np.cumsum(counts)[:-1])[-1].tolist() == want[-1]
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == want


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr("postmill.llm.known_ids.word_hashes", lambda data, starts, ends: (ends - starts).astype(np.uint64) << np.uint64(50))
    known = KnownIds(lambda words: (np.array([b for w in words for b in w], np.uint32), np.array([len(w) for w in words])))
    for _ in range(2):
        data = np.frombuffer(b"abcabdabcxyq", np.uint8)
        ids, sizes = known.ids_of(data, np.array([0, 3, 6, 9, 11]), np.array([3, 6, 9, 11, 12]))
        assert ids.tolist() == data.tolist() and sizes.tolist() == [3, 3, 3, 2, 1]


def one_by_one(lengths, capacity, rule="norm"):
    """Best fit piece after piece: the lengths in each sequence, in order."""
    room = capacity.vector().astype(float)
    want = [np.array([n, 1, n * n], float) for n in lengths]
    weight = sum(want, np.zeros(3)) / room
    weight = weight / weight.sum() if lengths else weight
    left, held = [], []
    for n, v in sorted(zip(lengths, want, strict=True), key=lambda x: -x[0]):
        best = None
        for i, r in enumerate(left):
            if (r >= v).all():
                after = (r - v) / room
                score = (weight * after**2).sum() if rule == "norm" else (weight * (v / room) * after).sum()
                if best is None or score < best[0] - 1e-15:
                    best = score, i
        if best is None:
            left.append(room.copy())
            held.append([])
            best = 0, len(left) - 1
        left[best[1]] = left[best[1]] - v
        held[best[1]].append(n)
    return held


def contents(plan):
    held = defaultdict(list)
    for length, _, n, each, first, offset in plan.tolist():
        for i in range(n):
            held[first + i // each].append((offset + i % each * length, length))
    return {s: sorted(x) for s, x in held.items()}


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [Capacity(50), Capacity(50, 3), Capacity(50, None, 900), Capacity(50, 4, 1200), Capacity(7, 1)])
def test_plan_equals_piece_after_piece(capacity, rule):
    rng = random.Random(str((capacity, rule)))
    for _ in range(30):
        longest = capacity.longest_piece()
        lengths = [rng.choice([rng.randint(1, longest), rng.randint(1, max(1, longest // 5)), longest]) for _ in range(rng.randint(0, 150))]
        plan = vp.best_fit(Counter(lengths), capacity, rule)
        held = contents(plan)
        assert sorted(held) == list(range(len(held)))
        room = capacity.vector()
        for own in held.values():
            sizes = [n for _, n in own]
            assert [at for at, _ in own] == [sum(sizes[:i]) for i in range(len(own))]
            assert (np.array([sum(sizes), len(sizes), sum(n * n for n in sizes)]) <= room).all()
        assert Counter(tuple(n for _, n in own) for own in held.values()) == Counter(map(tuple, one_by_one(lengths, capacity, rule)))
        for length, n in Counter(lengths).items():
            own = plan[plan[:, 0] == length]
            assert own[:, 1].tolist() == (np.cumsum(own[:, 2]) - own[:, 2]).tolist() and own[:, 2].sum() == n


@pytest.mark.parametrize("capacity", [Capacity(40), Capacity(40, 3, 1000)])
def test_pieces_hold_every_id_once(spark, capacity):
    rows = list(enumerate(ODD + texts(2, 300))) + [(None, "no id here"), (5, "again"), (5, "again")]
    df = spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(5)
    got = vp.packing_report(df, path(), capacity=capacity).collect()
    plain = tokenizer()
    want = Counter()
    longest = capacity.longest_piece()
    for doc, text in rows:
        ids = plain.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % longest or longest
        edges = [0, *range(first, len(ids) + 1, longest)]
        for i, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            want[doc, i, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    room = capacity.vector()
    for own in held.values():
        own.sort()
        sizes = [n for _, n in own]
        assert [at for at, _ in own] == [sum(sizes[:i]) for i in range(len(own))]
        assert (np.array([sum(sizes), len(sizes), sum(n * n for n in sizes)]) <= room).all()
    assert len(held) == len(one_by_one([r.length for r in got], capacity))


def test_sequences_are_their_pieces(spark):
    rows = list(enumerate(texts(3, 80)))
    packed = vp.packed(spark.createDataFrame([(*r, "x", "y", "z") for r in rows], SCHEMA).repartition(3), path(), capacity=Capacity(60))
    bodies = {(r.sequence_id, r.offset): (r.doc_id, bytes(r.ids)) for r in packed.collect()}
    whole = vp.sequences(packed).collect()
    assert len(whole) == len({s for s, _ in bodies})
    for r in whole:
        own = [bodies[s, at] for s, at in sorted(bodies) if s == r.sequence_id]
        assert r.doc_ids == [d for d, _ in own] and bytes(r.ids) == b"".join(b for _, b in own) and sum(r.lengths) * 2 == len(r.ids)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert vp.packing_report(df, path()).collect() == []
    assert vp.sequences(vp.packed(df, path())).collect() == []
