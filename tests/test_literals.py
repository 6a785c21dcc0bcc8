import ast

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postmill.functions.literals import dict_literal, last_entries, list_literal, unparsable

LISTS = {
    "['SQL', ' Python ']": ["SQL", " Python "],
    """["o'neil", 'x']""": ["o'neil", "x"],
    "['a', None, 'None']": ["a", None, "None"],
    '["a", null]': ["a", None],
    "['x, None, y']": ["x, None, y"],
    "['a,]', 'b']": ["a,]", "b"],
    "['a',]": ["a"],
    "[ 'a' , 'b' , ]": ["a", "b"],
    r"['it\'s', 'a\\', 'é', '\xe9', 'é']": ["it's", "a\\", "é", "é", "é"],
    """['say "hi"']""": ['say "hi"'],
    "\t['a']\n": ["a"],
    "[]": [],
    "['']": [""],
}
NOT_LISTS = [
    "['a' 'b'",
    "['a'] junk",
    "['a']} x",
    "['a'], 'w': ['b']",
    "['a'] ['b']",
    "['a', b]",
    "[,]",
    "['a',,]",
    "{'a': ['x']}",
    "a",
    "['a", 
    "",
    "None",
]
DICTS = {
    "{'cloud': ['AWS', 'gcp'], 'prog': ['sql']}": [("cloud", ["AWS", "gcp"]), ("prog", ["sql"])],
    "{'a': None, 'b': []}": [("a", None), ("b", [])],
    "{'a': ['x', None]}": [("a", ["x", None])],
    "{'a': ['x'], 'a': ['y']}": [("a", ["y"])],
    "{'a': ['x'], 'b': ['z'], 'a': None}": [("b", ["z"]), ("a", None)],
    """{"it's": ["None", 'x,]'],}""": [("it's", ["None", "x,]"])],
    "{'None': ['a',], 'N': None,}": [("None", ["a"]), ("N", None)],
    "{}": [],
}
NOT_DICTS = [
    "['a']",
    "{'a': 'xyz'}",
    "{'b': (1,2)}",
    "{'a': ['x']} junk",
    "{'a': ['x']}, {'b': ['y']}",
    "{'a'}",
    "{'a': ['x'] 'b': ['y']}",
    "not a dict",
    "{'a': ['x']",
]


def parse(spark, texts, parser):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", parser(F.col("t")).alias("v"), unparsable(F.col("t"), parser(F.col("t"))).alias("bad"))
    return {texts[r.i]: r for r in rows.collect()}


def entries(text):
    return last_entries(dict_literal(text))


def pairs(value):
    return None if value is None else [(e.key, e.value) for e in value]


def test_lists(spark):
    got = parse(spark, list(LISTS), list_literal)
    assert {t: r.v for t, r in got.items()} == LISTS
    assert not any(r.bad for r in got.values())


def test_texts_that_are_no_list(spark):
    got = parse(spark, NOT_LISTS, list_literal)
    assert {t for t, r in got.items() if r.v is not None} == set()
    assert {t for t, r in got.items() if not r.bad} == {"", "None"}


def test_dicts(spark):
    got = parse(spark, list(DICTS), entries)
    assert {t: pairs(r.v) for t, r in got.items()} == DICTS


def test_texts_that_are_no_dict(spark):
    got = parse(spark, NOT_DICTS, dict_literal)
    assert {t for t, r in got.items() if r.v is not None} == set()
    assert all(r.bad for r in got.values())


@pytest.mark.parametrize("token", ["", "null", "None", "[]", "{}", " ", None])
def test_empty_tokens_are_no_errors(spark, token):
    for parser in (list_literal, dict_literal):
        assert not parse(spark, [token], parser)[token].bad


def test_long_text_needs_no_stack(spark):
    """A third of a megabyte in one list, with every kind of rewrite in it."""
    items = [f"it's {i}" if i % 7 == 0 else f"skill {i}" for i in range(30_000)]
    items[5] = "x" * 50_000
    items[6] = r"\ ' , ] None"
    listed = repr(items)[:-1] + ", None,]"
    typed = "{'g': " + listed + ", 'h': None}"
    assert parse(spark, [listed], list_literal)[listed].v == [*items, None]
    assert pairs(parse(spark, [typed], entries)[typed].v) == [("g", [*items, None]), ("h", None)]


text = st.text(st.characters(codec="utf-8", exclude_characters="\x00", exclude_categories=["Cs", "Cc"]), max_size=8)
names = st.one_of(text, st.sampled_from(["None", "a,]", "it's", '"', "\\", "\\'", "', '", "null", ",}"]))


@settings(max_examples=25, deadline=None)
@given(st.lists(st.lists(st.one_of(names, st.none())), min_size=20, max_size=60))
def test_any_list_as_python_writes_it(spark, lists):
    texts = sorted({repr(x) for x in lists if str(x).isprintable() and _plain(x)})
    for t, row in parse(spark, texts, list_literal).items():
        assert row.v == ast.literal_eval(t), t


@settings(max_examples=25, deadline=None)
@given(st.lists(st.dictionaries(names, st.one_of(st.none(), st.lists(st.one_of(names, st.none())))), min_size=20, max_size=60))
def test_any_dict_as_python_writes_it(spark, dicts):
    texts = sorted({repr(x) for x in dicts if _plain(x)})
    for t, row in parse(spark, texts, entries).items():
        assert dict(pairs(row.v)) == ast.literal_eval(t), t


def _plain(value):
    """Without the escapes JSON cannot hold (8-digit code points)."""
    return "\\U" not in repr(value)
