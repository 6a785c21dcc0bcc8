"""Known ids are told without a shuffle of the rows, and rows are made one per key in one."""

from collections import Counter

import pytest
from plans import plan
from pyspark.sql import functions as F

from postmill.operators import joins, loading

IDS = [0, 1, 63, 64, 65, -1, -64, -65, 2**40, 2**63 - 1, -(2**63), None]


def rows_of(df):
    return Counter(map(tuple, df.collect()))


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_rows_without_ids_of_a_kind(spark, tmp_path, limit):
    spark.createDataFrame([(i, str(i)) for i in IDS * 2], "id long, t string").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    for held in ([], IDS, [1, 1, 64, -64, 2**63 - 1, None], [2, 62, 66, -2, -66, 2**40 + 1, -(2**63) + 1]):
        ids = spark.createDataFrame([(i,) for i in held], "id long")
        want = Counter((i, str(i)) for i in IDS * 2 if i is None or i not in held)
        assert rows_of(joins.without_ids(rows, ids, "id", limit)) == want, held
    names = spark.createDataFrame([("1",), ("1",), (None,)], "t string")
    assert rows_of(joins.without_ids(rows, names, "t", limit)) == Counter((i, str(i)) for i in IDS * 2 if i != 1)


def test_dense_ids_beyond_a_broadcast_do_not_shuffle_the_rows(spark, tmp_path):
    """Ids that are too large for a broadcast as they are, and not as words of 64 neighbours."""
    spark.range(4000).withColumn("t", F.col("id").cast("string")).write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    ids = spark.range(0, 4000, 2)
    limit = joins.content_bytes(ids) // 4
    found = joins.without_ids(rows, ids, "id", limit)
    assert "Exchange hashpartitioning" not in plan(found) and "SortMergeJoin" not in plan(found)
    assert [r.id for r in found.select("id").orderBy("id").collect()] == list(range(1, 4000, 2))


def test_split_joins_do_not_sort_the_rows(spark, tmp_path):
    spark.range(300).selectExpr("cast(id % 50 as string) as name", "id").write.parquet(str(tmp_path / "rows"))
    rows = spark.read.parquet(str(tmp_path / "rows"))
    other = spark.createDataFrame([(str(i), i) for i in range(40)], "name string, number long")
    for how in ("inner", "left", "left_semi", "left_anti"):
        found = joins.lookup(rows, other, ["name"], how, limit=0, hot_keys=5)
        assert "SortMergeJoin" not in plan(found) and "ShuffledHashJoin" in plan(found), how
        assert rows_of(found) == rows_of(rows.join(other, "name", how)), how


def test_held_rows_are_dropped_before_one_per_key(spark, tmp_path, monkeypatch):
    batch = spark.createDataFrame([(i, t) for i in (*range(6), None) for t in "ab"], "id long, t string")
    target = batch.where("id < 4")
    seen = []
    whole = loading.one_per_key
    monkeypatch.setattr(loading, "one_per_key", lambda df, key, limit: seen.append(df.count()) or whole(df, key, limit))
    assert rows_of(loading.absent_rows(batch, target, "id", limit=0)) == Counter([(4, "a"), (5, "a")])
    assert seen == [4]


def test_many_repeated_keys_are_grouped_in_one_shuffle(spark, tmp_path):
    spark.createDataFrame([(i, t) for i in (*range(6), None) for t in "ba"] + [(9, "z")], "id long, t string").write.parquet(str(tmp_path / "b"))
    batch = spark.read.parquet(str(tmp_path / "b"))
    got = loading.one_per_key(batch, "id", limit=0)
    assert rows_of(got) == Counter([*((i, "a") for i in range(6)), (9, "z"), (None, "a"), (None, "b")])
    assert "Join" not in plan(got)
