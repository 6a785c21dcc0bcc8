import random
from collections import Counter

import pytest
from plans import plan
from pyspark.sql import Window
from pyspark.sql import functions as F

from postmill.operators import dimensions, joins, keys, loading


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_dense_ids_equal_row_number(spark):
    df = spark.range(20_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id")
    one_task = df.withColumn("n", F.row_number().over(Window.orderBy("k")).cast("long"))
    many = keys.dense_ids(df, ["k"], "n")
    assert rows_of(many.select("k", "id", "n")) == rows_of(one_task)
    assert "SinglePartition" not in plan(many).split("Window")[0]


def test_dense_ids_with_nulls_first_and_offset(spark):
    df = spark.createDataFrame([("b", None), (None, "x"), ("a", "y"), ("a", None)], "a string, b string")
    got = {tuple(r) for r in keys.dense_ids(df, ["a", "b"], "n", after=10).collect()}
    assert got == {(11, None, "x"), (12, "a", None), (13, "a", "y"), (14, "b", None)}
    assert keys.dense_ids(df.limit(0), ["a"], "n").count() == 0


def test_ids_stay_the_same_when_read_again(spark):
    df = spark.range(1000).select(F.md5(F.col("id").cast("string")).alias("k"))
    ids = keys.dense_ids(df, ["k"], "n")
    assert rows_of(ids) == rows_of(ids.repartition(3))


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows hold one key, a third hold none."""
    rng = random.Random(1)
    rows = [(i, "hot") for i in range(400)] + [(i, None) for i in range(400, 800)]
    rows += [(i, f"k{rng.randrange(150)}") for i in range(800, 1200)] + [(1200, "stray"), (1201, "stray")]
    fact = spark.createDataFrame(rows, "job_id long, name string").repartition(5)
    other = spark.createDataFrame([("hot", 0)] + [(f"k{i}", i + 1) for i in range(0, 150, 2)], "name string, id long")
    return fact, other


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_keys", [2, 20, 10_000])
def test_split_join_equals_plain_join(skewed, how, hot_keys):
    fact, other = skewed
    split = joins.lookup(fact, other, ["name"], how, limit=0, hot_keys=hot_keys)
    assert split.columns == fact.join(other, "name", how).columns
    assert rows_of(split) == rows_of(fact.join(other, "name", how))


def test_split_join_where_the_hot_key_is_unknown(skewed):
    fact, other = skewed
    other = other.where("name <> 'hot'")
    for how in ("inner", "left", "left_semi", "left_anti"):
        split = joins.lookup(fact, other, ["name"], how, limit=0, hot_keys=5)
        assert rows_of(split) == rows_of(fact.join(other, "name", how)), how


def test_small_sides_are_broadcast_and_large_ones_are_not(spark, skewed):
    fact, other = skewed
    assert "BroadcastHashJoin" in plan(joins.lookup(fact, other, ["name"]))
    size = joins.content_bytes(other)
    assert not joins.fits_broadcast(other, size - 1) and joins.fits_broadcast(other, size)


def test_rows_without_a_key_are_spread(skewed):
    """400 null rows must not meet in one shuffle partition."""
    fact, other = skewed
    split = joins.lookup(fact, other, ["name"], "left", limit=0, hot_keys=5)
    assert "_spread" in split._jdf.queryExecution().optimizedPlan().toString()
    assert split.where("name is null").count() == 400


def test_lookups_after_lookups_read_the_rows_once(spark, tmp_path):
    """Five split dimensions: the fact table stands in the plan once, and no key that is hot or missing meets in one task."""
    rows = [(i, *("hot" if i % 3 else None if i % 7 else f"k{i % 40}" for _ in range(5))) for i in range(600)]
    spark.createDataFrame(rows, "i long, " + ", ".join(f"d{k} string" for k in range(5))).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    got = want = fact
    for k in range(5):
        # Not every hot key has a match.
        names = [(f"k{j}", j) for j in range(30)] + ([("hot", 99)] if k % 2 else [])
        other = spark.createDataFrame(names, f"d{k} string, id{k} long")
        got = joins.lookup(got, other, [f"d{k}"], "left", limit=0, hot_keys=5, counted=fact)
        want = want.join(other, f"d{k}", "left")
    order = want.columns
    assert rows_of(got.select(order)) == rows_of(want)
    leaves = [line for line in got._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Relation" in line and "i#" in line]
    assert len(leaves) == 1


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_null_safe_lookup(spark, limit):
    fact = spark.createDataFrame([(1, "a", None), (2, None, None), (3, "a", "b"), (4, "", None)], "i long, p string, q string")
    other = spark.createDataFrame([(10, "a", None), (20, None, None), (30, "x", "y")], "id long, u string, v string")
    got = joins.null_safe_lookup(fact, other, {"p": "u", "q": "v"}, limit)
    assert {(r.i, r.id) for r in got.collect()} == {(1, 10), (2, 20), (3, None), (4, None)}
    assert set(got.columns) == {"i", "p", "q", "id"}


# --- loads ------------------------------------------------------------------


def jobs(spark, rows):
    return spark.createDataFrame(rows, "job_id long, title string, note string")


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
def test_one_per_key(spark, limit):
    rows = [(1, "b", None), (1, "a", "z"), (1, "a", None), (2, "x", "y"), (3, None, "q"), (3, "a", "a")] + [(4, "s", "t")] * 5
    got = rows_of(loading.one_per_key(jobs(spark, rows), "job_id", limit))
    assert got == Counter([(1, "a", None), (2, "x", "y"), (3, None, "q"), (4, "s", "t")])


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("unique", [True, False])
def test_absent_rows(spark, limit, unique):
    target = jobs(spark, [(1, "old", "o"), (2, "old", "o")])
    batch = jobs(spark, [(2, "new", "n"), (3, "new", "n"), (None, "new", "n")])
    got = rows_of(loading.absent_rows(batch, target, "job_id", unique, limit))
    assert got == Counter([(3, "new", "n")])


def test_inserting_twice_changes_nothing(spark):
    target = jobs(spark, [(1, "old", "o")])
    batch = jobs(spark, [(1, "new", "n"), (2, "new", "n"), (2, "newer", "n")])
    once = loading.insert_absent(target, batch, "job_id")
    assert rows_of(once) == Counter([(1, "old", "o"), (2, "new", "n")])
    assert rows_of(loading.insert_absent(once, batch, "job_id")) == rows_of(once)


def test_new_names_get_the_next_ids(spark):
    known = spark.createDataFrame([(7, "m"), (3, "c")], "company_id long, company_name string")
    source = spark.createDataFrame([("c",), ("z",), ("a",), ("",), (None,), ("z",)], "company_name string")
    after = loading.insert_absent_names(known, source, "company_name", "company_id")
    assert rows_of(after) == Counter([(7, "m"), (3, "c"), (8, "a"), (9, "z")])
    assert rows_of(loading.insert_absent_names(after, source, "company_name", "company_id")) == rows_of(after)
    fresh = loading.insert_absent_names(known.limit(0), source, "company_name", "company_id")
    assert rows_of(fresh) == Counter([(1, "a"), (2, "c"), (3, "z")])
    assert rows_of(fresh) == rows_of(dimensions.dim_company(source))


def test_backfill_keeps_keys_that_are_set(spark):
    rows = spark.createDataFrame([(1, "a", None), (2, "a", 99), (3, "q", None), (4, None, None)], "job_id long, company_name string, company_id long")
    dim = spark.createDataFrame([(5, "a")], "company_id long, company_name string")
    for limit in (0, joins.BROADCAST_BYTES):
        got = loading.backfill_key(rows, dim, "company_name", "company_id", limit)
        assert got.columns == rows.columns
        assert rows_of(got) == Counter([(1, "a", 5), (2, "a", 99), (3, "q", None), (4, None, None)])


def test_cascade(spark):
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 1), (3, 3)], "job_id long, skill_id long")
    gone = spark.createDataFrame([(1, "x"), (9, "y")], "job_id long, title string")
    assert rows_of(loading.without_deleted(bridge, gone, "job_id")) == Counter([(2, 1), (3, 3)])
    gone = spark.createDataFrame([(1,), (3,)], "skill_id long")
    assert rows_of(loading.without_deleted(bridge, gone, "skill_id", limit=0).select("job_id", "skill_id")) == Counter([(1, 2)])
