from plans import plan

from postmill.operators import dimensions, skills

TEXTS = [
    (1, "['SQL', ' Python ', 'sql', '']", "{'Prog ': ['sql'], 'prog': ['SQL', None], 'cloud': ['aws ']}"),
    (2, None, "{'a': None, 'b': []}"),
    (3, "[]", "{'a': ['x'], 'a': ['y']}"),
    (4, "broken", "also broken"),
    (5, """["o'neil", ' ', None]""", None),
    (6, "['None']", "{'None': ['None']}"),
]
ALL = {
    (1, None, "sql"),
    (1, None, "python"),
    (1, "prog", "sql"),
    (1, "cloud", "aws"),
    (3, "a", "y"),
    (5, None, "o'neil"),
    (6, None, "none"),
    (6, "none", "none"),
}


def postings(spark, rows=TEXTS):
    return spark.createDataFrame(rows, "job_id long, job_skills string, job_type_skills string")


def tuples(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_relations(spark):
    df = postings(spark)
    listed, typed = skills.list_skills(df), skills.typed_skills(df)
    assert tuples(listed) == {(i, n) for i, g, n in ALL if g is None}
    assert tuples(typed) == {row for row in ALL if row[1] is not None}
    assert tuples(skills.union_relations(listed, typed)) == ALL
    assert tuples(skills.all_skills(df)) == ALL
    assert tuples(skills.all_skills(df, unique_jobs=True)) == ALL


def test_pairs(spark):
    df = postings(spark)
    want = {(i, n) for i, _, n in ALL}
    assert tuples(skills.skill_pairs(skills.all_skills(df))) == want
    assert tuples(skills.skill_pairs_in_row(df)) == want


def test_repeated_job_ids_are_made_distinct_over_rows(spark):
    df = postings(spark, TEXTS + TEXTS)
    assert tuples(skills.all_skills(df)) == ALL


def test_unique_jobs_need_no_shuffle(spark):
    df = postings(spark)
    assert "Exchange" not in plan(skills.all_skills(df, unique_jobs=True))
    assert "Exchange" not in plan(skills.skill_pairs_in_row(df))
    assert plan(skills.all_skills(df)).count("Exchange") == 1


def test_text_is_parsed_once(spark):
    for df in (skills.all_skills(postings(spark)), skills.typed_skills(postings(spark))):
        assert plan(df).count("from_json(MapType") == 1


def test_a_staged_array_or_its_json_gives_the_same(spark):
    rows = [(1, ["sql", 'q"x', "o'n", None, "None", "a\\b", "é"], None)]
    array = spark.createDataFrame(rows, "job_id long, job_skills array<string>, job_type_skills string")
    text = array.selectExpr("job_id", "to_json(job_skills) as job_skills", "job_type_skills")
    want = {(1, None, n) for n in ("sql", 'q"x', "o'n", "none", "a\\b", "é")}
    assert tuples(skills.all_skills(array)) == want
    assert tuples(skills.all_skills(text)) == want


def test_dimension_and_bridge(spark):
    relation = skills.all_skills(postings(spark))
    dim = dimensions.dim_skill(relation)
    names = sorted({n for _, _, n in ALL})
    assert tuples(dim) == set(enumerate(names, 1))
    ids = {n: i for i, n in enumerate(names, 1)}
    assert tuples(skills.bridge(skills.skill_pairs(relation), dim)) == {(i, ids[n]) for i, _, n in ALL}


def test_main_group_is_the_most_frequent_then_the_first(spark):
    rows = [(i, "b", "x") for i in range(3)] + [(9, "a", "x"), (1, "d", "y"), (2, "c", "y"), (1, None, "z"), (1, "", "w")]
    relation = spark.createDataFrame(rows, "job_id long, skill_group string, skill_name string")
    assert tuples(dimensions.main_groups(relation)) == {("x", "b"), ("y", "c")}
