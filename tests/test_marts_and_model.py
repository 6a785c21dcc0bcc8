from collections import Counter
from datetime import datetime
from decimal import Decimal

import pytest
from plans import plan
from pyspark.sql import functions as F

from postmill.fixed import JOB_COLUMNS, MART_COLUMNS, RAW_COLUMNS
from postmill.operators import cleaning, dimensions
from postmill.plans import marts, normalized
from postmill.session import written


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def core(spark):
    names = ["job_id", *RAW_COLUMNS]
    given = [
        dict(job_id="1", job_title_short="DE", job_country="US", company_name="acme", job_location="Here", salary_year_avg="12.345", job_posted_date="2023-06-16 13:44:15"),
        dict(job_id="2", job_title_short="DE", job_country=None, company_name=None, job_via="via A"),
        dict(job_id="3", job_title_short="DA", job_country="US", company_name="zeta", job_schedule_type="Full-time"),
        dict(job_id="4", job_title_short="DA", job_country="US", company_name="acme"),
    ]
    raw = spark.createDataFrame([tuple(g.get(n) for n in names) for g in given], ", ".join(f"{n} string" for n in names))
    jobs = cleaning.core_columns(cleaning.clean_postings(raw))
    company = dimensions.dim_company(jobs)
    jobs = jobs.join(company, "company_name", "left")
    skill = spark.createDataFrame([(1, "python"), (2, "sql"), (3, "unused")], "skill_id long, skill_name string")
    bridge = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (3, 2), (9, 1), (4, 77), (None, 1)], "job_id long, skill_id long")
    return jobs, bridge, skill, company


def test_job_skills(core):
    mart = marts.job_skills(*core)
    assert mart.columns == MART_COLUMNS
    got = Counter((r.job_id, r.company_name, r.skill_name) for r in mart.collect())
    assert got == Counter([(1, "acme", "python"), (1, "acme", "sql"), (2, None, "sql"), (3, "zeta", "sql")])


def test_counts_equal_counts_over_the_mart(core):
    jobs, bridge, skill, _ = core
    mart = marts.job_skills(*core)
    for by, made in (
        ([], marts.skill_counts(jobs, bridge, skill)),
        (["job_title_short"], marts.skill_counts_by_title(jobs, bridge, skill)),
        (["job_country"], marts.skill_counts_by_country(jobs, bridge, skill)),
    ):
        plain = mart.groupBy(*by, "skill_name").agg(F.count("*").alias("postings"))
        assert made.columns == plain.columns and rows_of(made) == rows_of(plain)


def test_counts_hold_for_a_dimension_with_repeated_rows(core):
    """Counting before the lookup must not hide that a broken dimension multiplies rows."""
    jobs, bridge, skill, company = core
    broken = skill.union(skill.where("skill_id = 2"))
    plain = marts.job_skills(jobs, bridge, broken, company).groupBy("skill_name").agg(F.count("*").alias("postings"))
    assert rows_of(marts.skill_counts(jobs, bridge, broken)) == rows_of(plain)


def test_direct_counts_keep_pairs_of_unknown_jobs(core):
    assert rows_of(marts.postings_per_skill(core[1], core[2])) == Counter([("python", 3), ("sql", 3)])


def test_most_wanted_breaks_ties_by_name(spark):
    counts = spark.createDataFrame([("b", 2), ("a", 2), ("c", 3), ("d", 1)], "skill_name string, postings long")
    top = marts.most_wanted(counts, 3)
    assert [r.skill_name for r in top.collect()] == ["c", "a", "b"]
    assert "TakeOrderedAndProject" in plan(top)


def test_counts_read_two_columns_of_the_jobs(core):
    jobs, bridge, skill, _ = core
    text = plan(marts.skill_counts_by_title(written(jobs.select(*JOB_COLUMNS), "jobs"), bridge, skill))
    assert "ReadSchema: struct<job_id:bigint,job_title_short:string>" in text


def test_fact_table(core):
    jobs = core[0]
    made = {
        "company": normalized.companies(jobs),
        "location": dimensions.locations(jobs),
        "platform": normalized.platforms(jobs),
        "schedule_type": normalized.schedule_types(jobs),
    }
    assert rows_of(made["company"]) == Counter([(1, "acme"), (2, "zeta")])
    assert rows_of(made["location"]) == Counter([(1, None, None, "US"), (2, "Here", None, "US")])
    fact = {r.job_id: r for r in normalized.jobs_fact(jobs, **made).collect()}
    assert len(fact) == 4
    assert (fact[1].company_id, fact[1].location_id, fact[1].platform_id, fact[1].schedule_type_id) == (1, 2, None, None)
    assert (fact[2].company_id, fact[2].location_id, fact[2].platform_id) == (None, None, 1)
    assert (fact[3].company_id, fact[3].location_id, fact[3].schedule_type_id) == (2, 1, 1)
    assert fact[1].salary_year_avg == Decimal("12.35") and fact[2].salary_year_avg is None
    assert fact[1].posted_date == datetime(2023, 6, 16, 13, 44, 15)


def test_skills_have_one_type_at_most(spark):
    relation = spark.createDataFrame(
        [(1, "g1", "a"), (2, "g1", "a"), (1, "g0", "a"), (1, None, "b"), (1, "g2", "c")],
        "job_id long, skill_group string, skill_name string",
    )
    types = normalized.skill_types(relation)
    assert rows_of(types) == Counter([(1, "g0"), (2, "g1"), (3, "g2")])
    made = normalized.skills(dimensions.dim_skill(relation), relation, types)
    assert rows_of(made) == Counter([(1, "a", 2), (2, "b", None), (3, "c", 3)])
