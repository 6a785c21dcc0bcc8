"""Keys of several columns are held against each other as texts."""

from postmill.operators import quality


def test_declared_keys_of_several_columns_are_told_apart(spark):
    declared = {"n": quality.Declared(("a", "b")), "s": quality.Declared(("a", "b"))}
    numbers = spark.createDataFrame([(1, 11), (11, 1), (1, 11), (None, 1)], "a long, b long")
    texts = spark.createDataFrame([("x,y", "z"), ("x", "y,z"), ("x", "y,z")], "a string, b string")
    found = {r.check: r.violations for r in quality.declared_constraints({"n": numbers, "s": texts}, declared).collect()}
    assert found == {"n_pk_duplicate": 1, "n_a_null": 1, "n_b_null": 0, "s_pk_duplicate": 1, "s_a_null": 0, "s_b_null": 0}
