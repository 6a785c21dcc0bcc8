"""Texts are matched and names folded once, and a load keeps what it reads of new postings."""

from collections import Counter

from pyspark.sql import functions as F

from postmill.fixed import RAW_COLUMNS
from postmill.functions.literals import DICT_LITERAL, LIST_LITERAL, PLAIN_DICT, PLAIN_LIST
from postmill.operators import losses, skills
from postmill.plans import ledger, warehouse


def rows_of(df):
    return Counter(map(tuple, df.collect()))


TEXTS = ["[]", "[ ]", "['a', \"b\"]", "['a' , 'b' ]", "['None', 'x,]']", "['a',]", "['a\\'']", "[None]", "['a' 'b']", "['a]", "{}", "{'a': []}", "{'a' : ['b' , 'c'] , \"d\":[]}", "{'a': None}", "{'a': ['b',]}", "{'a': [None]}", "{'a': ['b\\'']}", "{'a'}", "{'a': ['b'] 'c': []}", "x"]


def test_plain_literals_are_part_of_the_accepted_ones(spark):
    rows = spark.createDataFrame([(t,) for t in TEXTS], "t string")
    told = rows.select("t", *[F.col("t").rlike(p).alias(n) for n, p in (("pl", PLAIN_LIST), ("l", LIST_LITERAL), ("pd", PLAIN_DICT), ("d", DICT_LITERAL))]).collect()
    assert all(r.l >= r.pl and r.d >= r.pd for r in told)
    assert {r.t for r in told if r.pl or r.pd} == {"[]", "[ ]", "['a', \"b\"]", "['a' , 'b' ]", "['None', 'x,]']", "{}", "{'a': []}", "{'a' : ['b' , 'c'] , \"d\":[]}"}


def test_typed_records_carry_the_pairs_of_the_relation(spark):
    rows = [
        (1, "['A', ' a', 'b', '', None]", "{'G': ['a', 'A ', 'c'], ' g': ['c', None], 'h': ['a'], 'x': None, 'h': ['q']}"),
        (2, None, "{'G': []}"),
        (3, "[' a ', 'İ']", "not a dict"),
        (4, None, None),
    ]
    given = spark.createDataFrame(rows, "job_id long, job_skills string, job_type_skills string")
    raw = given.select("job_id", *[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])
    records = losses.typed(raw)
    assert "entries" not in records.columns
    relation = skills.all_skills(raw)
    assert rows_of(skills.relation_of(records, True)) == rows_of(skills.relation_of(records)) == rows_of(relation)
    assert rows_of(skills.skill_pairs_by_job(records)) == rows_of(skills.skill_pairs(relation))
    assert [r.job_skills for r in records.orderBy("job_id").collect()] == ['["a","a","b","",null]', "[]", '["a","i̇"]', "[]"]


def test_new_postings_hold_what_is_read_of_them(spark, tmp_path):
    empty = {c: F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS}
    raw = lambda *ids: spark.createDataFrame([(i,) for i in ids], "job_id long").select("job_id", *empty.values())
    ledger.append(raw(1, 2), str(tmp_path))
    state = ledger.append(raw(2, 3), str(tmp_path))
    new = state.table(spark, "staging.new_postings")
    assert [r.job_id for r in new.collect()] == [3] and new.columns == ledger.NEW_COLUMNS


def test_a_one_shot_run_parses_the_texts_of_unique_jobs_once(spark, tmp_path, monkeypatch):
    rows = [(i, f"['a', 'B{i % 3}']", "{'g': ['a', 'c']}") for i in range(9)]
    given = spark.createDataFrame(rows, "job_id long, job_skills string, job_type_skills string")
    raw = given.select("job_id", *[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])
    seen = []
    parse = skills.dict_literal
    monkeypatch.setattr(skills, "dict_literal", lambda text: seen.append(text) or parse(text))
    run = warehouse.run_batch(raw, str(tmp_path))
    assert len(seen) == 1 and run["job_skill_all"].count() == 36 and run["bridge_job_skill"].count() == 27
