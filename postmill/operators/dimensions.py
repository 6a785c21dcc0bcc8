"""Dimensions: distinct names with dense ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.keys import dense_ids


def given_names(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Distinct values of a column that are neither null nor blank."""
    value = F.col(column)
    return df.where(value.isNotNull() & (value != "")).select(value.alias(name or column)).distinct()


def name_dimension(df: DataFrame, column: str, id_name: str, name: str | None = None) -> DataFrame:
    """(id, name), ids ascending by name."""
    name = name or column
    return dense_ids(given_names(df, column, name), [name], id_name)


def dim_skill(relation: DataFrame) -> DataFrame:
    return name_dimension(relation, "skill_name", "skill_id")


def dim_company(jobs: DataFrame) -> DataFrame:
    return name_dimension(jobs, "company_name", "company_id")


def locations(jobs: DataFrame) -> DataFrame:
    """Distinct location triples, of which any part may be null but not all."""
    parts = ["job_location", "search_location", "country"]
    triples = (
        jobs.select("job_location", "search_location", F.col("job_country").alias("country"))
        .where(F.coalesce(*parts).isNotNull())
        .distinct()
    )
    return dense_ids(triples, parts, "location_id")


def main_groups(relation: DataFrame) -> DataFrame:
    """One group per skill: the one with most jobs, on a tie the smallest name.

    Counts are combined per (skill, group) first, so a skill in most of the rows
    costs no more than any other.
    """
    counts = relation.where("skill_group <> ''").groupBy("skill_name", "skill_group").agg(F.count("*").alias("jobs"))
    rank = F.struct(-F.col("jobs"), F.col("skill_group"))
    return counts.groupBy("skill_name").agg(F.min_by("skill_group", rank).alias("skill_group"))
