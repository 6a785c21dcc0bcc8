"""Pairs of large buckets are verified where they are found: only links that join components leave a block."""

from collections import Counter

import pytest
from test_near_duplicates import brute, corpus

from postmill.llm import bagminhash
from postmill.llm.components import components


@pytest.mark.parametrize("block_bytes", [1 << 20, 200])
def test_links_join_what_all_links_would(spark, monkeypatch, block_bytes):
    monkeypatch.setattr(bagminhash, "BLOCK_BYTES", block_bytes)
    text = lambda group, i: " ".join([f"g{group}w{k}" for k in range(60)] + [f"own{i}"] * (i % 3))
    rows = [(1, bytes([i]), bytes([i]), [0, 0, 0], text(i % 4, i)) for i in range(80)]
    members = spark.createDataFrame(rows, "key long, digest binary, component binary, sketch array<long>, text string")
    sizes = spark.createDataFrame([(1, 80, sum(len(r[4]) for r in rows))], "key long, size long, bytes long")
    found = bagminhash._pairs_in_blocks(members, sizes, 16 if block_bytes == 200 else 100, 0.8)
    groups = {}
    for r in components(found, "a", "b").collect():
        groups.setdefault(bytes(r.component), set()).add(bytes(r.node)[0] % 4)
    assert len(groups) == 4 and all(len(g) == 1 for g in groups.values())
    if block_bytes > 200:
        assert found.count() == 80 - 4


def test_no_pair_of_a_large_bucket_leaves_its_block_unverified(spark, monkeypatch):
    given = []
    verified = bagminhash.verified
    monkeypatch.setattr(bagminhash, "verified", lambda pairs, *rest: given.append(pairs.count()) or verified(pairs, *rest))
    for name, value in {"SMALL": 1, "LEVELS": 0, "BLOCK": 8, "CHUNK": 5}.items():
        monkeypatch.setattr(bagminhash, name, value)
    rows = corpus(5)
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute(rows)
    assert len(given) == 1 and given[0] <= len(rows)
