"""Profiles of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postmill.operators.quality import as_rows


def null_profile(df: DataFrame) -> DataFrame:
    """(column, nulls), one pass over the table."""
    return as_rows(df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]), "column", "nulls")


def duplicate_members(df: DataFrame, ignore: tuple[str, ...] = ()) -> DataFrame:
    """Rows that share all their columns with another row: every member counts."""
    keys = [c for c in df.columns if c not in ignore]
    groups = df.groupBy(*keys).agg(F.count("*").alias("_rows")).where("_rows > 1")
    return groups.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("duplicate_rows"))


def distinct_counts(df: DataFrame, columns: dict[str, str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values of several columns.

    The exact form plans one expanded row per column, combined before the shuffle;
    the approximate form is one pass without a shuffle of values.
    """
    count = F.approx_count_distinct if approximate else F.count_distinct
    return df.agg(*[count(F.col(c)).alias(name) for name, c in columns.items()])


def skill_profile(relation: DataFrame) -> DataFrame:
    return relation.agg(
        F.count("*").alias("rows"),
        F.count_distinct(F.col("job_id")).alias("jobs_with_skills"),
        F.count_distinct(F.col("skill_name")).alias("unique_skills"),
    )


def table_summary(df: DataFrame) -> DataFrame:
    """(column, type, rows, nulls), one row per column."""
    totals = df.agg(
        F.count("*").alias("_rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    lines = [
        F.struct(
            F.lit(c).alias("column"),
            F.lit(kind).alias("type"),
            F.col("_rows").alias("rows"),
            F.col(f"`{c}`").alias("nulls"),
        )
        for c, kind in df.dtypes
    ]
    return totals.select(F.explode(F.array(*lines)).alias("_line")).select("_line.*")


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several tables side by side."""
    counts = [t.agg(F.count("*").alias(name)) for name, t in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counts)
    return stacked.agg(*[F.max(name).alias(name) for name in tables])
