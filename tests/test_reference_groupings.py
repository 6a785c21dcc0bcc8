"""References and keys are counted in groupings: no join that could broadcast every key of a parent."""

from plans import plan

from postmill.operators import quality


def tables(spark):
    jobs = spark.createDataFrame([(1, 7, "a"), (2, None, None), (2, 9, "b"), (None, 7, "a")], "job_id long, company_id long, company_name string")
    bridge = spark.createDataFrame([(1, 1), (1, 1), (3, 1), (None, 2), (2, None)], "job_id long, skill_id long")
    skills = spark.createDataFrame([(1, "x"), (4, "x"), (4, "y")], "skill_id long, skill_name string")
    companies = spark.createDataFrame([(7, "a"), (8, "a")], "company_id long, company_name string")
    return jobs, bridge, skills, companies


def test_core_constraints_without_a_join(spark):
    report = quality.core_constraints(*tables(spark))
    assert "Join" not in plan(report)
    found = {r.check: r.violations for r in report.collect()}
    assert found == {
        "jobs_pk_null": 1, "jobs_pk_duplicate": 1,
        "dim_skill_pk_null": 0, "dim_skill_pk_duplicate": 1, "dim_skill_name_duplicate": 1,
        "bridge_job_skill_pk_null": 2, "bridge_job_skill_pk_duplicate": 1,
        "dim_company_pk_null": 0, "dim_company_pk_duplicate": 0, "dim_company_name_duplicate": 1,
        "orphan_job_ids": 2, "orphan_skill_ids": 2, "orphan_company_ids": 1, "missing_company_id": 0,
    }
    assert {r.check: r.violations for r in quality.references(*tables(spark)).collect()} == {
        "orphan_job_ids": 2, "orphan_skill_ids": 2, "orphan_company_ids": 1,
    }


def test_empty_tables_have_no_violations(spark):
    empty = [df.where("false") for df in tables(spark)]
    assert {r.violations for r in quality.core_constraints(*empty).collect()} == {0}
