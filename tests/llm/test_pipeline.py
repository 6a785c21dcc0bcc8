import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from test_archive_reputation_mix import targets
from test_containment import brute as contained
from test_huffman_ids import plain_ids
from test_near_duplicates import brute as classes
from test_quality_ratio import brute as judged
from test_quality_ratio import hashes

import corpus_pipeline
from postmill.llm import quality_ratio


def corpus():
    rng = random.Random(11)
    good, bad = [f"good{i}" for i in range(150)], [f"bad{i}" for i in range(40)]
    text = lambda own, n: " ".join(rng.choice(own) for _ in range(n))
    items = [(i, text(good, 12)) for i in range(6)] + [(6, None), (7, "three words only")]
    docs = [[i, text(bad if i % 5 == 0 else good, rng.randint(55, 120))] for i in range(150)]
    for i in range(20):
        docs.append([200 + i, docs[3 * i + 1][1]])
        words = docs[3 * i + 2][1].split()
        words[rng.randrange(len(words))] = "other"
        docs.append([300 + i, " ".join(words)])
    for i in range(6):
        docs.append([400 + i, f"{text(good, 40)} {items[i][1]} {text(good, 30)}"])
    docs += [[500, None], [501, ""], [502, "short text"], [503, "again and again " * 40]]
    sources = ["a", "b", "c", None]
    return [(d, t, "en", sources[d % 4], len(t or "")) for d, t in docs], items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    docs, items = corpus()
    labels = [(i, int(i % 5 != 0), 0) for i in range(130)] + [(400 + i, 1, 0) for i in range(6)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, docs, items, {i for i, good, _ in labels if good}


def test_run_equals_brute_force(spark, folder):
    path, docs, items, trusted = folder
    rows = [(d, t) for d, t, *_ in docs]
    verdicts = judged(rows, trusted, quality_ratio.BUCKETS, hashes(spark, rows, quality_ratio.BUCKETS), quality_ratio.THRESHOLD)
    rows = [row for row, v in zip(rows, verdicts, strict=True) if v[-2]]
    least = classes(rows)
    rows = [(d, t) for d, t in rows if (d, d) in least]
    leaked = {d for d, _ in contained(rows, items)}
    assert {400 + i for i in range(6)} <= leaked
    clean = {d: t for d, t in rows if d not in leaked}
    assert 60 < len(clean) < 150 and not {500, 501, 502, 503} & clean.keys()

    got = sorted(corpus_pipeline.run(spark, path).collect(), key=lambda r: r.start)
    copies = Counter(r.doc_id for r in got)
    assert copies.keys() <= clean.keys() and max(copies.values()) <= 2
    sizes, taken = defaultdict(int), defaultdict(int)
    source = {d: s for d, _, _, s, _ in docs}
    for d, t in clean.items():
        sizes[source[d]] += len(t.split())
        taken[source[d]] += copies[d] * len(t.split())
    assert all(abs(taken[s] - n) <= 0.05 * n + 120 for s, n in targets(sizes).items())
    ids = dict(zip(clean, plain_ids(list(clean.values())), strict=True))
    start = 0
    assert [r.doc_id for r in got] == sorted(copies.elements())
    for r in got:
        own = ids[r.doc_id]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def test_stages_keep_the_columns_of_documents(spark, folder):
    path, docs, *_ = folder
    given = corpus_pipeline.queries.table(spark, path, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, given, path).schema == given.schema
        assert stage(spark, given.limit(0), path).collect() == []
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, given.limit(0), path).collect() == [] and last(spark, given, path).count() == len(docs)
