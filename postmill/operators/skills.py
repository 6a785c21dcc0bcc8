"""Job-to-skill relations from list and dict literals.

Rows are made distinct by a shuffle in general. Where every job_id is known to
occur once (`unique_jobs`), the rows of a job all come from its own text, so
duplicates are dropped inside the row and nothing is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.functions.literals import dict_literal, last_entries, list_literal
from postmill.functions.text import normal_name, strip
from postmill.operators.joins import lookup

NAMES = "array<string>"
ENTRIES = "array<struct<key:string,value:array<string>>>"


def _or_none(values: Column, kind: str) -> Column:
    return F.coalesce(values, F.array().cast(kind))


def _named(name: Column) -> Column:
    """Neither null nor blank. Stripping alone decides, so the name is not folded twice."""
    return strip(name) != ""


def _list_names(df: DataFrame, column: str) -> Column:
    """The list column, parsed if it is still text."""
    return list_literal(F.col(column)) if dict(df.dtypes)[column] == "string" else F.col(column)


# The explodes below are the outer kind: for the inner kind Catalyst adds a size
# filter on the exploded expression and would parse every text twice. The null
# rows they add fall to the filter on names.


def list_skills(df: DataFrame, column: str = "job_skills") -> DataFrame:
    """(job_id, skill_name), distinct, from a list column or list literal text."""
    rows = df.select("job_id", F.explode_outer(_list_names(df, column)).alias("_name"))
    return rows.where(_named(F.col("_name"))).select("job_id", normal_name(F.col("_name")).alias("skill_name")).distinct()


def typed_skills(df: DataFrame, column: str = "job_type_skills") -> DataFrame:
    """(job_id, skill_group, skill_name), distinct, from dict literal text."""
    parsed = df.select("job_id", dict_literal(F.col(column)).alias("groups"))
    return _spread(parsed.select("job_id", last_entries(F.col("groups")).alias("entries")), False)


def all_skills(
    df: DataFrame,
    list_column: str = "job_skills",
    dict_column: str = "job_type_skills",
    unique_jobs: bool = False,
) -> DataFrame:
    """Union of both relations; rows from the list have a null group."""
    return _spread(_entries(df, list_column, dict_column), unique_jobs)


def _entries(df: DataFrame, list_column: str, dict_column: str) -> DataFrame:
    """(job_id, entries): the dict entries, with the list in front as one without a key.

    So the source is scanned and parsed once, and no union is needed.
    """
    parsed = df.select(
        "job_id",
        _list_names(df, list_column).alias("names"),
        dict_literal(F.col(dict_column)).alias("groups"),
    )
    return parsed.select("job_id", joined_entries(F.col("names"), F.col("groups")).alias("entries"))


def joined_entries(names: Column, groups: Column) -> Column:
    """Entries of a parsed list, which has no key, and a parsed dict."""
    ungrouped = F.array(F.struct(F.lit(None).cast("string").alias("key"), names.alias("value")))
    return F.concat(ungrouped, _or_none(last_entries(groups), ENTRIES))


def relation_of(rows: DataFrame, unique_jobs: bool = False) -> DataFrame:
    """The relation of all_skills from rows (job_id, pairs) that were parsed and folded before."""
    relation = relation_in_row(rows)
    return relation if unique_jobs else relation.distinct()


def _spread(rows: DataFrame, unique_jobs: bool) -> DataFrame:
    if unique_jobs:
        return _spread_in_row(rows)
    groups = rows.select("job_id", F.explode_outer("entries").alias("_entry"))
    names = groups.select(
        "job_id", F.col("_entry.key").alias("_group"), F.explode_outer("_entry.value").alias("_name")
    )
    return (
        names.where(_named(F.col("_name")))
        .select(
            "job_id",
            normal_name(F.col("_group")).alias("skill_group"),
            normal_name(F.col("_name")).alias("skill_name"),
        )
        .distinct()
    )


def _spread_in_row(rows: DataFrame) -> DataFrame:
    return relation_in_row(_distinct_in_row(rows))


def _distinct_in_row(rows: DataFrame) -> DataFrame:
    """(job_id, pairs): the distinct (skill_group, skill_name) of each row. A group is folded once, whatever its skills."""
    folded = F.transform("entries", _folded_entry)
    return rows.select("job_id", folded.alias("_folded")).select("job_id", distinct_pairs(F.col("_folded")).alias("pairs"))


def _folded_entry(entry: Column) -> Column:
    return F.struct(normal_name(entry["key"]).alias("group"), _folded(entry["value"]).alias("names"))


def folded_entries(clean: Column, entries: Column) -> Column:
    """Entries of `joined_entries` as (group, names) with folded names, those of the list from `clean`, where they are."""
    names = F.filter(_or_none(clean, NAMES), lambda name: name != "")
    listed = F.array(F.struct(F.lit(None).cast("string").alias("group"), names.alias("names")))
    return F.concat(listed, F.transform(F.slice(entries, 2, F.size(entries)), _folded_entry))


def distinct_pairs(folded: Column) -> Column:
    """The distinct (skill_group, skill_name) of folded entries."""

    def pairs(entry: Column) -> Column:
        return F.transform(entry["names"], lambda name: F.struct(entry["group"].alias("skill_group"), name.alias("skill_name")))

    return F.array_distinct(F.flatten(F.transform(folded, pairs)))


def _folded(names: Column) -> Column:
    """Normal names of a list, null as an empty one, without blanks."""
    return F.filter(F.transform(_or_none(names, NAMES), normal_name), lambda name: name != "")


def skills_by_job(df: DataFrame, list_column: str = "job_skills", dict_column: str = "job_type_skills") -> DataFrame:
    """(job_id, pairs) of postings in which every job_id occurs once: the distinct (skill_group, skill_name) of each.

    Written once, it gives the relation and the distinct pairs, and neither needs a shuffle.
    """
    return _distinct_in_row(_entries(df, list_column, dict_column))


def relation_in_row(by_job: DataFrame) -> DataFrame:
    """The relation of all_skills from the rows of skills_by_job."""
    rows = by_job.select("job_id", F.explode_outer("pairs").alias("_pair")).select("job_id", "_pair.*")
    return rows.where(F.col("skill_name").isNotNull())


def skill_pairs_by_job(by_job: DataFrame) -> DataFrame:
    """(job_id, skill_name), distinct, from the rows of skills_by_job."""
    rows = by_job.select("job_id", F.explode_outer(F.array_distinct("pairs.skill_name")).alias("skill_name"))
    return rows.where(F.col("skill_name").isNotNull())


def union_relations(listed: DataFrame, typed: DataFrame) -> DataFrame:
    """Distinct union of two relations that exist already."""
    return (
        listed.withColumn("skill_group", F.lit(None).cast("string"))
        .select("job_id", "skill_group", "skill_name")
        .unionByName(typed)
        .distinct()
    )


def skill_pairs(relation: DataFrame) -> DataFrame:
    """(job_id, skill_name), distinct, of a relation with groups."""
    return relation.select("job_id", "skill_name").distinct()


def skill_pairs_in_row(
    df: DataFrame, list_column: str = "job_skills", dict_column: str = "job_type_skills"
) -> DataFrame:
    """The same pairs straight from postings in which every job_id occurs once."""
    return pairs_in_row_of(_entries(df, list_column, dict_column))


def pairs_in_row_of(rows: DataFrame) -> DataFrame:
    """(job_id, skill_name) from rows (job_id, entries) in which every job_id occurs once."""
    values = F.transform("entries", lambda entry: _or_none(entry["value"], NAMES))
    names = F.array_distinct(_folded(F.flatten(values)))
    rows = rows.select("job_id", F.explode_outer(names).alias("skill_name"))
    return rows.where(F.col("skill_name").isNotNull())


def bridge(pairs: DataFrame, dim_skill: DataFrame) -> DataFrame:
    """(job_id, skill_id) of distinct pairs.

    Names and ids are one to one, so ids need not be made distinct again.
    """
    return lookup(pairs, dim_skill, ["skill_name"], how="left").select("job_id", "skill_id")
