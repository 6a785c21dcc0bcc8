"""Skills of postings whose ids do not repeat are made distinct in the row; the relation and the pairs stay the same."""

from pyspark.sql import functions as F

from postmill.functions.text import strip
from postmill.operators import skills
from postmill.plans.queries import Feed

ROWS = [
    (1, "['A', ' a', 'b', '', None]", "{'G': ['a', 'A ', 'c'], ' g': ['c', None], 'h': ['a'], 'x': None}"),
    (2, None, "{'G': []}"),
    (3, "[' a ', 'İ']", "not a dict"),
    (4, None, None),
    (None, "['q', 'Q']", "{'': ['q']}"),
]


def feed(spark, rows):
    made = Feed(spark, "")
    made.raw = spark.createDataFrame(rows, "job_id long, job_skills string, job_type_skills string")
    return made


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_relation_and_pairs_in_the_row_are_those_of_the_shuffle(spark):
    made = feed(spark, ROWS)
    assert made.unique
    relation = skills.all_skills(made.raw)
    assert rows_of(made.relation) == rows_of(relation)
    assert rows_of(made.pairs) == rows_of(skills.skill_pairs(relation))
    assert made.relation.columns == relation.columns
    for df in (made.relation, made.pairs):
        assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_repeated_ids_still_go_by_the_shuffle(spark):
    made = feed(spark, [*ROWS, ROWS[0], (2, "['z']", None)])
    assert not made.unique
    assert rows_of(made.relation) == rows_of(skills.all_skills(made.raw))
    assert len(rows_of(made.pairs)) == len(set(rows_of(made.pairs))) == 7


def test_strip_leaves_no_white_space_at_either_end(spark):
    texts = ["", " ", "a", " a ", "\ta", "a\n", "a ", "  a b\t \n", "é", " é ", "a\nb", "\n", "a 　", "~", "!\x7f", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", strip(F.col("t")).alias("s")).collect()
    white = "\t\n\x0b\x0c\r \x85\xa0       　"
    assert [r.s for r in rows] == [None if r.t is None else r.t.strip(white) for r in rows]
