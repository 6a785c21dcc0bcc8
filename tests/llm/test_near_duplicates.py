import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from postmill.llm import bagminhash
from postmill.llm.components import components


def bag(text):
    words = (text or "").encode().split()
    if 0 < len(words) < 5:
        return Counter([tuple(words)])
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def similarity(a, b):
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


def brute(rows):
    """doc_id -> smallest doc_id of its class, by comparing all texts."""
    texts = sorted({t or "" for _, t in rows})
    bags = [bag(t) for t in texts]
    root = list(range(len(texts)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if similarity(bags[i], bags[j]) >= 0.8:
                root[find(i)] = find(j)
    members = defaultdict(list)
    for d, t in rows:
        members[find(texts.index(t or ""))].append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in members.items()}
    return Counter((d, least[find(texts.index(t or ""))]) for d, t in rows)


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 200))] for _ in range(14)]
    rows = []
    for i in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
            words[rng.randrange(len(words))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            words = words + words[: rng.randint(5, 20)]
        rows.append((i * 7, " ".join(words)))
    rows += [(3, None), (4, ""), (5, "  "), (6, "one two"), (8, "one two"), (9, "one three"), (None, rows[0][1]), (None, "alone " * 40), (11, "again " * 300), (12, "again " * 310), (0, rows[0][1]), (0, rows[0][1])]
    return rows


@pytest.mark.parametrize(("seed", "small"), [(1, 32), (2, 4)])
def test_classes_equal_brute_force(spark, monkeypatch, seed, small):
    monkeypatch.setattr(bagminhash, "SMALL", small)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, b"x") for r in rows], "doc_id long, text string, digest binary")
    got = Counter((r.doc_id, r.class_id) for r in bagminhash.near_duplicates(df).collect())
    assert got == brute(rows)
    kept = bagminhash.first_of_class(df).collect()
    assert len(kept) == len({c for _, c in got if c is not None}) + 1  # one class has no doc_id
    assert kept[0].asDict().keys() == {"doc_id", "text", "digest"}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bagminhash.near_duplicates(df).collect() == []
    assert bagminhash.first_of_class(df).collect() == []


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(5)
    items = np.arange(400, dtype=np.uint64) * np.uint64(2654435761)
    a, b = rng.integers(1, 60, 400), rng.integers(1, 60, 400)
    a[:50] = 0
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    has = a > 0
    times = bagminhash.signatures(
        np.concatenate([items[has], items]), np.repeat([0, 1], [has.sum(), 400]), np.concatenate([a[has], b]), 2, 4096
    )
    assert abs((times[0] == times[1]).mean() - want) < 4 * (want * (1 - want) / 4096) ** 0.5


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(20)] + [(30, 31), (31, 30), (40, 40), (None, 3)], "a long, b long")
    got = {(r.node, r.component) for r in components(edges, "a", "b").collect()}
    assert got == {(i, 0) for i in range(21)} | {(30, 30), (31, 30)}
