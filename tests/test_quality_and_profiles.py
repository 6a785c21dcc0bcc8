import pytest
from pyspark.sql import functions as F

from postmill.operators import profiling, quality


def report(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(dict(rows))
    return dict(rows)


@pytest.fixture(scope="module")
def tables(spark):
    jobs = spark.createDataFrame(
        [(1, "a", 1), (2, "a", 1), (3, None, None), (4, "b", None), (4, "c", 9), (None, "", None)],
        "job_id long, company_name string, company_id long",
    )
    bridge = spark.createDataFrame(
        [(1, 1), (1, 1), (1, 2), (7, 1), (None, 2), (2, None), (7, 5)], "job_id long, skill_id long"
    )
    skill = spark.createDataFrame([(1, "x"), (2, "y"), (2, "y"), (3, None), (4, None)], "skill_id long, skill_name string")
    company = spark.createDataFrame([(1, "a"), (2, "b")], "company_id long, company_name string")
    return jobs, bridge, skill, company


def test_references(tables):
    jobs, bridge, skill, company = tables
    assert report(quality.references(jobs, bridge, skill, company)) == {
        "orphan_job_ids": 3,  # 7 twice, and the null key
        "orphan_skill_ids": 2,  # 5, and the null key
        "orphan_company_ids": 1,  # 9; null keys are skipped
    }


def test_constraints(tables):
    got = report(quality.core_constraints(*tables))
    assert got["jobs_pk_null"] == 1 and got["jobs_pk_duplicate"] == 1
    assert got["dim_skill_pk_duplicate"] == 1 and got["dim_skill_name_duplicate"] == 1
    assert got["bridge_job_skill_pk_null"] == 2 and got["bridge_job_skill_pk_duplicate"] == 1
    assert got["dim_company_pk_null"] == 0 and got["dim_company_name_duplicate"] == 0
    assert got["missing_company_id"] == 1


def test_required_names(tables):
    got = report(quality.unique_name(tables[2], "skill_name", "skills", required=True))
    assert got == {"skills_name_duplicate": 1, "skills_name_null": 2}


def test_duplicate_keys(tables):
    assert [tuple(r) for r in quality.duplicate_keys(tables[1], ["job_id", "skill_id"]).collect()] == [(1, 1, 2)]


def test_null_sums_of_an_empty_table_are_null(tables):
    columns = {"null_job_id": "job_id", "null_skill_id": "skill_id"}
    assert tuple(quality.null_sums(tables[1], columns).first()) == (1, 1)
    assert tuple(quality.null_sums(tables[1].limit(0), columns).first()) == (None, None)


def test_reports_of_empty_tables_are_zero(tables):
    assert set(report(quality.core_constraints(*[t.limit(0) for t in tables])).values()) == {0}


def test_relation_contract(spark):
    good = spark.createDataFrame([(1, "a"), (2, "a")], "job_id long, skill_name string")
    assert set(report(quality.relation_contract(good)).values()) == {0}
    bad = spark.createDataFrame([(1, 5), (1, 5), (2, None)], "job_id long, skill_name int")
    assert report(quality.relation_contract(bad)) == {"blank_skill_name": 1, "skill_name_type": 1, "duplicate_job_skill": 1}


def test_staging_contract(spark):
    df = spark.createDataFrame([(None, "t", "yes")], "job_id long, job_title string, job_work_from_home string")
    got = report(quality.staging_contract(df))
    assert got["missing_columns"] == 15 and got["missing_input_columns"] == 2
    assert got["wrong_types"] == 8 and got["null_job_id"] == 1 and got["empty_load"] == 0
    assert report(quality.staging_contract(df.limit(0)))["empty_load"] == 1


def test_lost_text(spark):
    names = "job_skills job_type_skills job_posted_date salary_year_avg salary_hour_avg".split()
    rows = [
        ("['a'", "{'a'", "2023-06-16", "n/a", "1.0d"),
        ("[]", "None", " 2023-06-16 13:44:15 ", " 12 ", "1e3"),
        ("null", "{}", "", "", " "),
        (None, None, None, None, None),
        ("['a'] x", "['a']", "2023-02-30 00:00:00", "-", "1"),
    ]
    df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    assert report(quality.lost_text(df)) == dict(zip(names, (2, 2, 2, 2, 1), strict=True))


def test_size_limits(spark):
    columns = [*quality.TEXT_LIMITS, *quality.SALARY_DECIMALS]
    kinds = ", ".join(f"{c} {'double' if c in quality.SALARY_DECIMALS else 'string'}" for c in columns)
    rows = [
        tuple("x" * n for n in quality.TEXT_LIMITS.values()) + (12.345, 999999.994),
        tuple("x" * (n + 1) for n in quality.TEXT_LIMITS.values()) + (1e10, 999999.996),
        tuple(None for _ in columns),
    ]
    assert report(quality.size_limits(spark.createDataFrame(rows, kinds))) == dict.fromkeys(columns, 1)


def test_enforce(spark):
    df = spark.createDataFrame([("a", 0), ("b", 2)], "check string, violations long")
    quality.enforce(df.where("violations = 0"))
    with pytest.raises(quality.ChecksFailed, match="b: 2"):
        quality.enforce(df)


def test_profiles(spark, tables):
    jobs, bridge, _, _ = tables
    assert report(profiling.null_profile(jobs)) == {"job_id": 1, "company_name": 1, "company_id": 3}
    assert profiling.duplicate_members(bridge).first()[0] == 2
    assert profiling.duplicate_members(jobs).first()[0] == 0
    assert profiling.duplicate_members(jobs, ignore=("job_id", "company_id")).first()[0] == 2
    assert tuple(profiling.distinct_counts(jobs, {"c": "company_name", "k": "company_id"}).first()) == (4, 2)
    assert [tuple(r) for r in profiling.table_summary(bridge).collect()] == [
        ("job_id", "bigint", 7, 1),
        ("skill_id", "bigint", 7, 1),
    ]
    assert tuple(profiling.row_counts({"j": jobs, "b": bridge, "e": jobs.limit(0)}).first()) == (6, 7, 0)


def test_approximate_distinct_counts_are_close(spark):
    df = spark.range(50_000).select((F.col("id") % 20_000).alias("v"))
    exact = profiling.distinct_counts(df, {"n": "v"}).first().n
    near = profiling.distinct_counts(df, {"n": "v"}, approximate=True).first().n
    assert exact == 20_000 and abs(near - exact) < 0.15 * exact
