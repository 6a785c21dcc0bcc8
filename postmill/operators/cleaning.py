"""Typing and cleaning of raw postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.fixed import BOOLEAN_COLUMNS, JOB_COLUMNS, RAW_COLUMNS, SALARY_COLUMNS
from postmill.functions.literals import list_literal
from postmill.functions.text import (
    blank_to_null,
    normal_name,
    number,
    strip,
    truth,
    utc_timestamp,
    utc_wall_clock,
)


def columns_of_type(df: DataFrame, kind: T.DataType) -> list[str]:
    return [field.name for field in df.schema if field.dataType == kind]


def strip_strings(df: DataFrame) -> DataFrame:
    return df.withColumns({c: strip(F.col(c)) for c in columns_of_type(df, T.StringType())})


def blanks_to_null(df: DataFrame) -> DataFrame:
    return df.withColumns({c: blank_to_null(F.col(c)) for c in columns_of_type(df, T.StringType())})


def fill_floats(df: DataFrame, value: float = 0.0) -> DataFrame:
    """Null becomes value in every double column; NaN stays, which fillna would change too."""
    return df.withColumns({c: F.coalesce(c, F.lit(value)) for c in columns_of_type(df, T.DoubleType())})


def with_booleans(df: DataFrame, columns: list[str] = BOOLEAN_COLUMNS) -> DataFrame:
    return df.withColumns({c: truth(F.col(c)) for c in columns})


def with_posted_time(df: DataFrame, column: str = "job_posted_date") -> DataFrame:
    return df.withColumn(column, utc_timestamp(F.col(column)))


def with_salaries(df: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """Lenient numbers; unknown salaries become `fill`, or stay null if it is None."""
    salaries = {c: number(F.col(c)) for c in SALARY_COLUMNS}
    if fill is not None:
        salaries = {c: F.coalesce(v, F.lit(fill)) for c, v in salaries.items()}
    return df.withColumns(salaries)


def clean_skill_list(parsed: Column) -> Column:
    """Cleaned elements of a parsed list; null becomes the empty list."""
    empty = F.array().cast("array<string>")
    return F.coalesce(F.transform(parsed, normal_name), empty)


def clean_postings(raw: DataFrame, fill: float | None = 0.0) -> DataFrame:
    """Staging form of raw postings: one projection, no shuffle.

    job_skills becomes an array; job_type_skills stays text for `typed_skills`.
    """
    df = strip_strings(raw.select("job_id", *RAW_COLUMNS))
    df = with_salaries(with_booleans(with_posted_time(df)), fill)
    df = df.withColumn("job_skills", clean_skill_list(list_literal(F.col("job_skills"))))
    df = df.withColumn("job_id", F.col("job_id").try_cast("long"))
    return blanks_to_null(df)


def skills_as_json(df: DataFrame, column: str = "job_skills") -> DataFrame:
    """List column as JSON text, for sinks that hold no arrays."""
    return df.withColumn(column, F.to_json(column))


def core_columns(staging: DataFrame) -> DataFrame:
    """The 16-column projection loaded into the core jobs table."""
    return staging.select(*JOB_COLUMNS)


def with_wall_clocks(df: DataFrame) -> DataFrame:
    """Timestamps as timestamp_ntz, for readers that know no zones."""
    return df.withColumns({c: utc_wall_clock(F.col(c)) for c in columns_of_type(df, T.TimestampType())})
