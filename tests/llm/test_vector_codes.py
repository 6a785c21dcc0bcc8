import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from postmill.llm import vector_codes as vc

SCHEMA = "vec_id long, embedding array<float>, label int, code string, error string"


def squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def brute(rows, rounds=2):
    """Counter of result rows, with Python integers and no boxes."""
    kept = []
    for vec_id, vector, label, *_ in rows:
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector):
            kept.append((vec_id, [math.floor(256 * float(np.float32(x))) for x in vector], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, len(r[1]), r[1]))
    if not kept:
        return Counter()
    length = len(kept[0][1])
    wide = -(-length // 16)
    limit = math.isqrt((1 << 61) // max(length, 1))
    fits = [r for r in kept if len(r[1]) == length and all(abs(x) <= limit for x in r[1])]
    parts = lambda v: [(v + [0] * (16 * wide - length))[p * wide : (p + 1) * wide] for p in range(16)]
    cuts = [parts(v) for _, v, _ in fits]
    books = [[c[p] for c in cuts[:64]] for p in range(16)]

    def assign(part, piece):
        return min((squared(piece, entry), i) for i, entry in enumerate(books[part]))

    for _ in range(rounds):
        for p in range(16):
            members = defaultdict(list)
            for c in cuts:
                members[assign(p, c[p])[1]].append(c[p])
            for i, own in members.items():
                books[p][i] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for (vec_id, _, label), c in zip(fits, cuts, strict=True):
        found = [assign(p, c[p]) for p in range(16)]
        out.append((vec_id, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found), label))
    out += [(r[0], None, None, r[2]) for r in kept if r not in fits]
    by_label = defaultdict(lambda: None)
    for _, _, error, label in out:
        if error is not None:
            by_label[label] = (by_label[label] or 0) + error
    return Counter((i, c, e, by_label[label], digest) for i, c, e, label in out)


def result(spark, rows, **how):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(4)
    return Counter((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vc.compressed(df, **how).collect())


def vectors(rng, n, d, spread=0.3):
    centres = [[rng.gauss(0, spread) for _ in range(d)] for _ in range(9)]
    return [[x + rng.gauss(0, spread / 5) for x in rng.choice(centres)] for _ in range(n)]


def test_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vc, "CHUNK_ROWS", 150)
    rng = random.Random(1)
    rows = [(i * 3, v, rng.choice([None, 0, 1, 2])) for i, v in enumerate(vectors(rng, 400, 32))]
    rows += [rows[5], rows[5], (None, rows[7][1], 1), (900_001, None, 1), (900_002, [None] + rows[0][1][1:], 1)]
    rows += [(900_003, [math.nan] * 32, 2), (900_004, [math.inf] + rows[0][1][1:], 2), (900_005, [0.5] * 31, 77), (900_006, [], None)]
    rows += [(900_007, [3e38] + [0.0] * 31, 5), (900_008, [3e4] * 32, 6)]
    assert result(spark, rows) == brute(rows)


@pytest.mark.parametrize(("n", "d"), [(300, 48), (20, 32), (1, 16), (120, 20), (90, 3), (70, 0)])
def test_sizes(spark, n, d):
    """Fewer vectors than entries, lengths that do not divide, and none at all."""
    rng = random.Random(n)
    rows = [(i, v, i % 3) for i, v in enumerate(vectors(rng, n, d))]
    assert result(spark, rows) == brute(rows)


def test_ties_and_equal_vectors(spark):
    """Few distinct values: equal entries, ties in distance, repeated ids and unused entries."""
    rng = random.Random(7)
    rows = [(rng.randrange(60), [rng.choice([-1.0, 0.0, 1.0]) for _ in range(16)], None) for _ in range(300)]
    assert result(spark, rows) == brute(rows)
    assert result(spark, rows, rounds=5) == brute(rows, 5)


def test_empty_table(spark):
    assert result(spark, []) == Counter()
    assert result(spark, [(1, None, 1), (2, [math.nan], 1)]) == Counter()


def test_shortlists_hold_every_nearest_entry():
    rng = np.random.default_rng(3)
    points = rng.integers(-400, 400, (6400, 3))
    book = rng.integers(-400, 400, (64, 3))
    in_order = points[np.argsort(vc.curve_keys(points), kind="stable")]
    listed = {}
    for name, own in (("as given", points), ("on the curve", in_order)):
        lows, highs = (f(own.reshape(200, 32, 3), axis=1) for f in (np.min, np.max))
        listed[name] = vc.shortlists(lows, highs, book)
        exact = ((own[:, None] - book) ** 2).sum(axis=2).argmin(axis=1)
        assert listed[name][np.repeat(np.arange(200), 32), exact].all()
    assert listed["on the curve"].sum() < 0.3 * listed["as given"].sum()


def test_neighbours_on_the_curve_are_neighbours():
    grid = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    path = grid[np.argsort(vc.curve_keys(grid))]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()
    assert len(np.unique(vc.curve_keys(grid))) == len(grid)


def test_decoded_vectors_have_the_stated_error(spark):
    rng = random.Random(5)
    rows = [(i, v, 0, "x", "y") for i, v in enumerate(vectors(rng, 200, 40))]
    blocks = vc.chunks(spark.createDataFrame(rows, SCHEMA))
    length, books = vc.trained(blocks)
    codes = vc.encoded(blocks, length, books)
    errors = {r.vec_id: r.error for r in codes.collect()}
    for r in vc.decoded(codes, length, books).collect():
        given = [math.floor(256 * float(np.float32(x))) for x in rows[r.vec_id][1]]
        # The zeros that fill up the last part are decoded with an error of their own.
        assert squared(given, [int(x * 256) for x in r.embedding]) <= errors[r.vec_id]
