"""The normalized model: eight tables with declared names and types."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.fixed import SALARY_DECIMALS
from postmill.functions.text import utc_wall_clock
from postmill.operators.dimensions import main_groups, name_dimension
from postmill.operators.joins import lookup, null_safe_lookup
from postmill.operators.skills import bridge


def companies(jobs: DataFrame) -> DataFrame:
    return name_dimension(jobs, "company_name", "company_id", "name")


def platforms(jobs: DataFrame) -> DataFrame:
    return name_dimension(jobs, "job_via", "platform_id", "name")


def schedule_types(jobs: DataFrame) -> DataFrame:
    return name_dimension(jobs, "job_schedule_type", "schedule_type_id", "name")


def skill_types(relation: DataFrame) -> DataFrame:
    return name_dimension(relation, "skill_group", "skill_type_id", "name")


def skills(dim_skill: DataFrame, relation: DataFrame, types: DataFrame) -> DataFrame:
    """Skills with the type most of their jobs give; null for skills without one."""
    named_types = types.select("skill_type_id", F.col("name").alias("skill_group"))
    typed = lookup(main_groups(relation), named_types, ["skill_group"]).select("skill_name", "skill_type_id")
    return dim_skill.join(typed, "skill_name", "left").select(
        "skill_id", F.col("skill_name").alias("name"), "skill_type_id"
    )


def jobs_fact(
    jobs: DataFrame,
    company: DataFrame | None,
    location: DataFrame,
    platform: DataFrame,
    schedule_type: DataFrame,
) -> DataFrame:
    """The fact table: four foreign keys, decimals for salaries, null for unknown ones.

    Without `company` the jobs hold the company's key already.
    """
    # The tables that tend to be small come first, so that the rows pass few splits.
    named = [(schedule_type, "job_schedule_type"), (platform, "job_via")]
    if company is not None:
        jobs = jobs.drop("company_id")  # the key of the core table; this model has its own
        named.append((company, "company_name"))
    rows = jobs
    for dimension, column in named:
        rows = lookup(rows, dimension.withColumnRenamed("name", column), [column], "left", counted=jobs)
    rows = null_safe_lookup(
        rows,
        location,
        {"job_location": "job_location", "search_location": "search_location", "job_country": "country"},
        counted=jobs,
    )
    salaries = [
        F.nullif(F.col(c), F.lit(0.0)).try_cast(kind).alias(c) for c, kind in SALARY_DECIMALS.items()
    ]
    return rows.select(
        "job_id",
        "job_title",
        "job_title_short",
        "company_id",
        "location_id",
        "platform_id",
        "schedule_type_id",
        F.col("job_work_from_home").alias("work_from_home"),
        utc_wall_clock(F.col("job_posted_date")).alias("posted_date"),
        F.col("job_no_degree_mention").alias("no_degree_mention"),
        F.col("job_health_insurance").alias("health_insurance"),
        "salary_rate",
        *salaries,
    )


def job_skills(pairs: DataFrame, skill: DataFrame) -> DataFrame:
    """The junction table, from (job_id, skill_name) pairs."""
    return bridge(pairs, skill.select("skill_id", F.col("name").alias("skill_name")))
