import itertools
import random

import numpy as np
import pytest

from postmill.llm import crf


def brute(scores, transitions):
    """Marginals and expected transitions of one chain, by all its labellings."""
    n, k = scores.shape
    marginal, expected, total = np.zeros((n, k)), np.zeros((k, k)), 0.0
    for path in itertools.product(range(k), repeat=n):
        weight = np.exp(sum(scores[i, y] for i, y in enumerate(path)) + sum(transitions[a, b] for a, b in itertools.pairwise(path)))
        total += weight
        for i, y in enumerate(path):
            marginal[i, y] += weight
        for a, b in itertools.pairwise(path):
            expected[a, b] += weight
    return marginal / total, expected / total


@pytest.mark.parametrize("most", [32, 2])
def test_marginals_equal_brute_force(monkeypatch, most):
    monkeypatch.setattr(crf, "COLUMNS", most)  # 2: pieces follow each other
    rng = np.random.default_rng(3)
    counts = np.array([1, 0, 7, 2, 5])
    scores, transitions = rng.normal(0, 2, (15, 3)), rng.normal(0, 2, (3, 3))
    marginal, expected = crf.forward_backward(scores, counts, transitions, steps=2)
    ends = np.cumsum(counts)
    want = [brute(scores[e - c : e], transitions) for e, c in zip(ends, counts, strict=True) if c]
    assert np.allclose(marginal, np.concatenate([m for m, _ in want]))
    assert np.allclose(expected, sum(e for _, e in want))


def documents(languages, rows, repeats=0):
    """Rows of made-up languages, each with its own words; the first has the fewest rows."""
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = []
    for number in range(languages):
        words = ["".join(rng.choices(letters, k=6)) for _ in range(12)]
        for _ in range(rows if number else rows - 3):
            out.append((len(out), " ".join(rng.choices(words, k=25)), f"l{number:02d}"))
    out += [(1, f"again {i}", "l01") for i in range(repeats)]
    return out + [(len(out), None, "l00"), (None, "no id", "none"), (len(out) + 1, "no lang", None)]


def test_every_language_is_a_label(spark, monkeypatch):
    monkeypatch.setattr(crf, "FEATURES", 1 << 13)
    rows = documents(40, 20)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = crf.train(crf.training_rows(df), features=1 << 13)
    assert model.labels == [f"l{i:02d}" for i in range(40)]
    want = {d: lang for d, text, lang in rows if text and d is not None and lang}
    got = {r.doc_id: r.lang_pred for r in crf.predicted(df, model).collect()}
    assert len(got) == len(rows)
    right = [got[d] == lang for d, lang in want.items()]
    assert sum(right) > 0.95 * len(right)
    assert all(any(got[d] == name for d, lang in want.items() if lang == name) for name in model.labels)


def test_repeated_ids_leave_room_for_all_languages(spark):
    rows = documents(40, 12, repeats=3000)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = crf.training_rows(df, sample=5, rows=200, least=5)
    assert {lang for _, lang in got} == {f"l{i:02d}" for i in range(40)}
    assert all(sum(x == lang for _, x in got) <= 10 for _, lang in got)
