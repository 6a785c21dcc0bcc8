import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from postmill.llm import quality_ratio

DOCS = "doc_id long, text string"


def repeat_words(text):
    """Words within a three-word window that the text repeats."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    return len({i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)})


def test_repeats_equal_brute_force(spark):
    rng = random.Random(2)
    texts = [None, "", "a b c", "a a a a", "a b c a b c", "x " * 60]
    texts += [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 120))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), DOCS)
    got = {r.doc_id: r.n_repeat_words for r in quality_ratio.base_counts(df).collect()}
    assert got == {i: repeat_words(t) for i, t in enumerate(texts)}


def test_windows_alike_in_their_lower_hash_bits_do_not_repeat(spark, monkeypatch):
    """Two windows whose hashes differ in the upper four bits only, in a text with another repeat."""
    whole = F.xxhash64

    def alike(*columns):
        if len(columns) != 3:
            return whole(*columns)
        end = columns[2]
        return F.when(end == "p", F.lit(5)).when(end == "q", F.lit(5 | 1 << 60)).otherwise(whole(*columns))

    monkeypatch.setattr(F, "xxhash64", alike)
    text = "a b p c d q e f g e f g"
    got = quality_ratio.base_counts(spark.createDataFrame([(1, text)], DOCS)).first()
    assert got.n_repeat_words == repeat_words(text) == 6


def test_all_trusted_documents_count(spark):
    """More good labels than 20,000, most of documents that are not there; repeats and nulls among them."""
    docs = spark.createDataFrame([(i, "good") for i in range(300)] + [(300, "other"), (None, "good"), (7, "good")], DOCS)
    labels = spark.range(30_000).selectExpr("if(id < 300, id, id + 1000) as doc_id", "1 as quality", "cast(null as int) as toxic")
    labels = labels.unionByName(labels.where("doc_id < 3")).unionByName(spark.sql("select cast(null as bigint) doc_id, 1 quality, 0 toxic"))
    buckets = 64
    got = quality_ratio.log_ratios(docs, labels, buckets)
    at = {w: spark.range(1).select(F.pmod(F.xxhash64(F.lit(w)), F.lit(buckets))).first()[0] for w in ("good", "other")}
    assert at["good"] != at["other"]
    for word, target, raw in (("good", 301, 302), ("other", 0, 1)):
        want = math.log((target + 1) / (301 + buckets)) - math.log((raw + 1) / (303 + buckets))
        assert abs(got[at[word]] - want) < 1e-9


@pytest.mark.parametrize("limit", [1 << 26, 0])
def test_trusted_ids_by_bitmap_and_by_join(spark, limit):
    rng = random.Random(6)
    ids = [None, 0, 1, -1, 32768, 32769, -32768, -32769, 65536, 1 << 40, *(rng.randint(-100_000, 100_000) for _ in range(400))]
    good = {i for i in ids if i is not None and rng.random() < 0.5}
    rows = spark.createDataFrame([(i, str(at)) for at, i in enumerate(ids)], DOCS)
    marked = quality_ratio.with_trust(rows, spark.createDataFrame([(i,) for i in good], "good_id long"), limit)
    got = {r.text: r.good for r in marked.collect()}
    assert got == {str(at): int(i in good) for at, i in enumerate(ids)}


def brute(rows, trusted, buckets, hashed, threshold):
    """doc_id -> the counts, base_failed, score and kept, text by text."""
    def grams(text):
        own = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
        return own, [hashed[w] for w in own] + [hashed[a, b] for a, b in itertools.pairwise(own)]

    raw, target = Counter(), Counter()
    for doc, text in rows:
        raw.update(grams(text)[1])
        if doc in trusted:
            target.update(grams(text)[1])
    total = lambda c: sum(c.values()) + buckets
    ratio = {b: math.log((target[b] + 1) / total(target)) - math.log((raw[b] + 1) / total(raw)) if target else 0.0 for b in range(buckets)}
    out = []
    for doc, text in rows:
        own, buckets_of = grams(text)
        lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        n, again = len(own), repeat_words(text)
        failed = n < 50 or 100 * again > 50 * n
        score = sum(float(f"{ratio[b]:.6f}") for b in buckets_of) / (2 * n - 1) if n else 0.0
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        out.append((doc, n, sum(map(len, own)), symbols, len(lines) - len(set(lines)), again, failed, not failed and score >= threshold, score))
    return out


def corpus():
    rng = random.Random(8)
    good, bad = [f"good{i}" for i in range(30)], [f"bad{i}" for i in range(30)]
    texts = [None, "", " \n ", "# $ one", "same line\nsame line\n \nother\nsame line", "x " * 70, "éé ü\u00a0b " * 20]
    for i in range(60):
        own = good if i % 2 else bad
        texts.append("".join(rng.choice(own) + rng.choice([" ", "  ", "\n", "\t", " # "]) for _ in range(rng.randint(40, 90))))
    rows = [(i, t) for i, t in enumerate(texts)]
    return rows + [rows[9], rows[9], (None, texts[10]), (None, texts[11])]


def hashes(spark, rows, buckets):
    keys = {w for _, t in rows for w in (t or "").split()} | {p for _, t in rows for p in itertools.pairwise(re.split(r"[\x20\x09-\x0D]+", t or ""))}
    keys |= {w for _, t in rows for w in re.split(r"[\x20\x09-\x0D]+", t or "") if w}
    one = spark.createDataFrame([(k,) for k in keys if isinstance(k, str)], "a string").select("a", F.pmod(F.xxhash64("a"), F.lit(buckets)).alias("h"))
    two = spark.createDataFrame([k for k in keys if not isinstance(k, str)], "a string, b string").select("a", "b", F.pmod(F.xxhash64("a", "b"), F.lit(buckets)).alias("h"))
    return {r.a: r.h for r in one.collect()} | {(r.a, r.b): r.h for r in two.collect()}


def test_judgements_equal_brute_force(spark):
    rows = corpus()
    trusted = {i for i in range(60) if i % 2 and i > 8}
    labels = [(i, int(i in trusted), 0) for i in range(60)] + [(8, 1, 1), (None, 1, 0), (9, 1, 0), (9, 0, 0), (10, 1, None)]
    trusted |= {9, 10}
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], DOCS + ", words string, score string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality_ratio.judged(docs, labels).collect()
    want = brute(rows, trusted, quality_ratio.BUCKETS, hashes(spark, rows, quality_ratio.BUCKETS), quality_ratio.THRESHOLD)
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert Counter(tuple(r[n] for n in names) for r in got) == Counter(w[:-1] for w in want)
    scores = {r.doc_id: r.score for r in got if r.doc_id is not None}
    assert all(abs(scores[w[0]] - w[-1]) < 1e-9 for w in want if w[0] is not None)
    assert 5 < sum(r.kept for r in got) < len(got) - 20
    kept = quality_ratio.kept_documents(docs, labels)
    assert kept.columns == docs.columns
    texts = dict(enumerate(t for _, t in rows))
    assert Counter(r.text for r in kept.collect()) == Counter(texts[i] for i, w in enumerate(want) if w[-2])


def test_without_labels_only_base_rules_judge(spark):
    docs = spark.createDataFrame(corpus(), DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert all(r.kept != r.base_failed and r.score == 0 for r in quality_ratio.judged(docs, none).collect())
    assert quality_ratio.judged(docs.limit(0), none).collect() == quality_ratio.kept_documents(docs.limit(0), none).collect() == []


def test_filters_do_not_reach_into_the_windows(spark):
    docs = spark.createDataFrame(corpus(), DOCS + "")
    labels = spark.createDataFrame([(9, 1, 0)], "doc_id long, quality int, toxic int")
    for df in (quality_ratio.judged(docs, labels).where("kept"), quality_ratio.kept_documents(docs, labels)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        filters = [line for line in plan.split("\n") if "Filter" in line]
        assert plan.count("sort_array") == 1 and filters and max(map(len, filters)) < 5000


def test_grams_are_counted_in_compiled_code_from_one_split(spark):
    rows, buckets = corpus(), 512
    trusted = {9, 10, 11, 12, 40}
    labels = spark.createDataFrame([(i, 1, 0) for i in trusted] + [(13, 0, 0), (1000, 1, 0)], "doc_id long, quality int, toxic int")
    counts = quality_ratio.gram_counts(spark.createDataFrame(rows, DOCS), labels, buckets)
    hashed = hashes(spark, rows, buckets)
    raw, target = Counter(), Counter()
    for doc, text in rows:
        own = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        grams = [hashed[w] for w in own] + [hashed[p] for p in itertools.pairwise(own)]
        raw.update(grams)
        target.update(grams if doc in trusted else [])
    assert {r.bucket: (r.raw, r.target) for r in counts.collect()} == {b: (n, target[b]) for b, n in raw.items()}
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan and plan.count("split(") == 1
