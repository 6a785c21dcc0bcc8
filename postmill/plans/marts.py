"""Marts over the core tables. Every function returns a lazy frame, as a view would."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.fixed import MART_COLUMNS
from postmill.operators.joins import BROADCAST_BYTES, lookup


def job_skills(
    jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame, dim_company: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """One row per job and skill; jobs without skills drop out, jobs without a company stay.

    Ids are joined before names are looked up, so no name is shuffled. How often a key occurs is counted
    in the tables themselves, which stand in the plan once each.
    """
    facts = jobs.drop("company_name").join(bridge, "job_id")
    named = lookup(facts, dim_skill, ["skill_id"], "left", limit, counted=bridge).where(F.col("skill_name").isNotNull())
    return lookup(named, dim_company, ["company_id"], "left", limit, counted=jobs).select(*MART_COLUMNS)


def _counts(rows: DataFrame, dim_skill: DataFrame, by: list[str]) -> DataFrame:
    """Postings per skill name and `by`.

    Rows are counted by skill id before names are looked up: the lookup then sees
    one row per group instead of one per posting, whatever the skew of the skills.
    """
    counts = rows.groupBy(*by, "skill_id").agg(F.count("*").alias("_n"))
    named = counts.join(dim_skill, "skill_id")
    return named.groupBy(*by, "skill_name").agg(F.sum("_n").alias("postings"))


def postings_per_skill(bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """Straight from the bridge, without the jobs."""
    return _counts(bridge, dim_skill, [])


def _facts(jobs: DataFrame, bridge: DataFrame, by: list[str]) -> DataFrame:
    # The company is not joined: it is unique by id, so it changes no count.
    return jobs.select("job_id", *by).join(bridge, "job_id")


def skill_counts(jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    return _counts(_facts(jobs, bridge, []), dim_skill, [])


def skill_counts_by_title(jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    return _counts(_facts(jobs, bridge, ["job_title_short"]), dim_skill, ["job_title_short"])


def skill_counts_by_country(jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame) -> DataFrame:
    return _counts(_facts(jobs, bridge, ["job_country"]), dim_skill, ["job_country"])


def most_wanted(counts: DataFrame, n: int = 20) -> DataFrame:
    """The n skills with most postings, ties by name."""
    return counts.orderBy(F.desc("postings"), F.asc("skill_name")).limit(n)
