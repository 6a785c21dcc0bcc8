"""Large buckets lose no link: without heads, longer keys and first partners the classes are those of brute force."""

from collections import Counter

from test_near_duplicates import brute, corpus

from postmill.llm import bagminhash


def test_large_buckets_are_compared_whole(spark, monkeypatch):
    for name, value in {"SMALL": 1, "LEVELS": 0, "BLOCK": 8, "CHUNK": 5}.items():
        monkeypatch.setattr(bagminhash, name, value)
    rows = corpus(3)
    got = bagminhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert Counter(map(tuple, got.collect())) == brute(rows)


def test_blocks_meet_every_pair_of_components(spark):
    rows = [(k, bytes([k, i]), bytes([i % 7]), [0, 0, 0]) for k in (1, 2) for i in range(50)]
    members = spark.createDataFrame(rows, "key long, digest binary, component binary, sketch array<long>")
    sizes = spark.createDataFrame([(1, 50), (2, 50)], "key long, size long")
    found = [(bytes(a), bytes(b)) for a, b in bagminhash._pairs_in_blocks(members, sizes, 6).collect()]
    digests = [bytes([k, i]) for k in (1, 2) for i in range(50)]
    wanted = {(a, b) for a in digests for b in digests if a < b and a[0] == b[0] and a[1] % 7 != b[1] % 7}
    assert len(found) == len(wanted) and set(found) == wanted
