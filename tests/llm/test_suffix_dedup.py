import hashlib
import random

import numpy as np
import pytest

from postmill.llm.suffix_dedup import longest_previous, remove_repeats


def brute(rows, length):
    """The contract read literally: every window, every smaller document."""
    least = {}
    data = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    for doc, text in data:
        for i in range(len(text) - length + 1):
            w = text[i : i + length]
            least[w] = min(least.get(w, LAST), doc)
    out = []
    for (given, _), (doc, text) in zip(rows, data, strict=True):
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - length + 1):
            if least[text[i : i + length]] < doc:
                gone[i : i + length] = True
        kept = bytes(b for b, g in zip(text, gone, strict=True) if not g)
        spans = int(np.count_nonzero(np.diff(gone.astype(int), prepend=0) == 1))
        out.append((given, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


LAST = 2**63 - 1


def rows_of(df):
    return sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()], key=repr)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé \n") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    common = text(30)
    base = [text(rng.randint(1, 60)) for _ in range(12)]
    rows = []
    for i in range(60):
        t = rng.choice(base)
        cut = rng.randrange(len(t) + 1)
        kind = rng.randrange(5)
        if kind == 1:
            t = t[:cut] + word() + t[cut:]
        elif kind == 2:
            t = text(9) + common + text(9)
        elif kind == 3:
            t = t[cut:] + common[cut % 40 :] + t
        rows.append((i * 3 - 20, t))
    rows += [(7, base[0]), (7, base[0]), (None, base[1]), (None, base[1]), (500, None), (501, ""), (502, "x" * 300), (503, "x" * 120), (1000, "\0" * 80), (1001, "\0" * 90)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("seed", "hot"), [(1, 32), (2, 0), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr("postmill.llm.suffix_dedup.HOT", hot)
    rows = corpus(seed)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, chunk string")
    got = remove_repeats(df, chunk_bytes=3000)
    assert rows_of(got) == brute(rows, 50)
    kept = {hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256 for r in got.collect()}
    assert kept == {True}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_longest_previous():
    rng = np.random.default_rng(3)
    windows = rng.integers(97, 99, (300, 12)).astype(np.uint8)
    docs = rng.integers(0, 9, 300)
    want = [max((next((k for k in range(12) if windows[i, k] != windows[j, k]), 12) for j in range(300) if docs[j] < docs[i]), default=0) for i in range(300)]
    assert longest_previous(windows, docs).tolist() == want
