"""Checks. Each gives rows (check, violations); reports are unions of them.

Rules on single rows of one table share one aggregation, so a table is scanned
once for all of them. Keys are counted before they are compared, so a key that
fills a third of the table arrives at the join as one row per task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.fixed import (
    CLEAN_TYPES,
    JOB_COLUMNS,
    REQUIRED_INPUT,
    SALARY_DECIMALS,
    SKILL_LIMITS,
    TEXT_LIMITS,
)
from postmill.functions.literals import dict_literal, list_literal, unparsable
from postmill.functions.text import blank_to_null, number, strip, utc_timestamp


def unite(reports: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def as_rows(totals: DataFrame, label: str = "check", value: str = "violations") -> DataFrame:
    """One row of named totals as one row per total."""
    pairs = [
        F.struct(F.lit(c).alias(label), F.col(f"`{c}`").cast("long").alias(value)) for c in totals.columns
    ]
    return totals.select(F.explode(F.array(*pairs)).alias("_pair")).select("_pair.*")


def broken_rows(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break each rule, in one pass."""
    return as_rows(df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()]))


def blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column).cast("string") == "")


# --- keys -------------------------------------------------------------------


def orphans(
    child: DataFrame, key: str, parent: DataFrame, name: str, skip_null: bool = False
) -> DataFrame:
    """Child rows without a parent. A null key has none, unless nulls are skipped."""
    return _key_report(_keyed(parent, key, child, skip_null), {name: _lost()})


def _lost() -> Column:
    """Of the rows that `_keyed` makes: the child's without a parent."""
    return F.coalesce(F.sum(F.when(F.col("_key").isNull() | (F.col("_rows") == 0), F.col("_refs"))), F.lit(0))


def _keyed(parent: DataFrame, key: str, child: DataFrame, skip_null: bool = False) -> DataFrame:
    """(_key, _rows, _refs): how often parent and child hold each key.

    One grouping of both instead of a join, which might broadcast every key of a parent that compresses well.
    """
    rows = child.where(F.col(key).isNotNull()) if skip_null else child
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    held = parent.select(F.col(key).alias("_key"), one.alias("_rows"), none.alias("_refs"))
    held = held.unionByName(rows.select(F.col(key).alias("_key"), none.alias("_rows"), one.alias("_refs")))
    return held.groupBy("_key").agg(F.sum("_rows").alias("_rows"), F.sum("_refs").alias("_refs"))


def _key_report(keyed: DataFrame, totals: dict[str, Column]) -> DataFrame:
    return as_rows(keyed.agg(*[total.alias(name) for name, total in totals.items()]))


def referred_key(parent: DataFrame, key: str, table: str, child: DataFrame, name: str, skip_null: bool = False) -> DataFrame:
    """`primary_key` of parent and `orphans` of a child that refers to it, from one grouping."""
    nulls = F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("_rows"))), F.lit(0))
    totals = {f"{table}_pk_null": nulls, f"{table}_pk_duplicate": F.count_if(F.col("_rows") > 1), name: _lost()}
    return _key_report(_keyed(parent, key, child, skip_null), totals)


def duplicate_keys(df: DataFrame, keys: list[str], count: str = "rows") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(count)).where(F.col(count) > 1)


def duplicated(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Number of keys held by more than one row."""
    return as_rows(duplicate_keys(df, keys).agg(F.count("*").alias(name)))


def null_sums(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """One row of null counts; null, not 0, for an empty table, as SUM gives."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(name) for name, c in columns.items()])


def missing_keys(df: DataFrame, name_column: str, key: str, name: str) -> DataFrame:
    """Rows that name a parent but hold no key."""
    return broken_rows(df, {name: ~blank(name_column) & F.col(key).isNull()})


# --- contracts --------------------------------------------------------------


def missing_columns(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c not in df.columns]


def wrong_types(df: DataFrame, expected: dict[str, str]) -> list[str]:
    actual = dict(df.dtypes)
    return [c for c, kind in expected.items() if actual.get(c) != kind]


def staging_contract(staging: DataFrame) -> DataFrame:
    """Shape and keys of the staging table, in one pass."""
    return as_rows(
        staging.agg(
            F.lit(len(missing_columns(staging, [*JOB_COLUMNS, "job_skills", "job_type_skills"]))).alias(
                "missing_columns"
            ),
            F.lit(len(missing_columns(staging, REQUIRED_INPUT))).alias("missing_input_columns"),
            F.lit(len(wrong_types(staging, CLEAN_TYPES))).alias("wrong_types"),
            F.count_if(F.col("job_id").isNull()).alias("null_job_id"),
            F.when(F.count("*") == 0, 1).otherwise(0).alias("empty_load"),
        )
    )


def relation_contract(listed: DataFrame) -> DataFrame:
    """Skill names are text and given, and no (job, skill) pair comes twice; one grouping."""
    types = len(wrong_types(listed, {"skill_name": "string"}))
    pairs = listed.groupBy("job_id", "skill_name").agg(F.count("*").alias("_rows"))
    return as_rows(
        pairs.agg(
            F.coalesce(F.sum(F.when(blank("skill_name"), F.col("_rows"))), F.lit(0)).alias("blank_skill_name"),
            F.lit(types).alias("skill_name_type"),
            F.count_if(F.col("_rows") > 1).alias("duplicate_job_skill"),
        )
    )


def primary_key(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Null or repeated primary keys, from one grouping by key."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return as_rows(
        groups.agg(
            F.coalesce(F.sum(F.when(any_null, F.col("_rows"))), F.lit(0)).alias(f"{table}_pk_null"),
            F.count_if(F.col("_rows") > 1).alias(f"{table}_pk_duplicate"),
        )
    )


def unique_name(df: DataFrame, column: str, table: str, required: bool = False) -> DataFrame:
    """Repeated names; nulls may repeat, and are counted only if a name is required."""
    report = duplicated(df.where(F.col(column).isNotNull()), [column], f"{table}_name_duplicate")
    if required:
        report = report.unionByName(broken_rows(df, {f"{table}_name_null": F.col(column).isNull()}))
    return report


def core_constraints(jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame, dim_company: DataFrame) -> DataFrame:
    """Every key, unique and reference rule declared on the core tables."""
    return unite(
        [
            referred_key(jobs, "job_id", "jobs", bridge, "orphan_job_ids"),
            referred_key(dim_skill, "skill_id", "dim_skill", bridge, "orphan_skill_ids"),
            unique_name(dim_skill, "skill_name", "dim_skill"),
            primary_key(bridge, ["job_id", "skill_id"], "bridge_job_skill"),
            referred_key(dim_company, "company_id", "dim_company", jobs, "orphan_company_ids", skip_null=True),
            unique_name(dim_company, "company_name", "dim_company"),
            missing_keys(jobs, "company_name", "company_id", "missing_company_id"),
        ]
    )


def references(jobs: DataFrame, bridge: DataFrame, dim_skill: DataFrame, dim_company: DataFrame) -> DataFrame:
    return unite(
        [
            orphans(bridge, "job_id", jobs, "orphan_job_ids"),
            orphans(bridge, "skill_id", dim_skill, "orphan_skill_ids"),
            orphans(jobs, "company_id", dim_company, "orphan_company_ids", skip_null=True),
        ]
    )


# --- declared constraints ---------------------------------------------------


@dataclass(frozen=True)
class Declared:
    """What a table's definition promises. `references` maps a column to the table whose key it holds."""

    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    references: dict[str, str] = field(default_factory=dict)

    def required(self) -> tuple[str, ...]:
        return (*self.key, *self.unique)


def _named_table(key: str) -> Declared:
    return Declared((key,), unique=("name",))


NORMALIZED = {
    "companies": _named_table("company_id"),
    "locations": Declared(("location_id",)),
    "platforms": _named_table("platform_id"),
    "schedule_types": _named_table("schedule_type_id"),
    "skill_types": _named_table("skill_type_id"),
    "skills": Declared(("skill_id",), unique=("name",), references={"skill_type_id": "skill_types"}),
    "jobs_3nf": Declared(
        ("job_id",),
        references={
            "company_id": "companies",
            "location_id": "locations",
            "platform_id": "platforms",
            "schedule_type_id": "schedule_types",
        },
    ),
    "job_skills_3nf": Declared(("job_id", "skill_id"), references={"job_id": "jobs_3nf", "skill_id": "skills"}),
}


def declared_constraints(tables: dict[str, DataFrame], declared: dict[str, Declared] = NORMALIZED) -> DataFrame:
    """Null and repeated keys and names, and references without a parent, of all tables at once.

    Every table is read once: a row becomes one entry per promise, with the value that is
    promised, and a parent's key one entry more per table that refers to it. Entries are counted by
    promise and value, which combines them before the shuffle, so a value on a third of the
    rows is one entry per task; a promise is broken where a value counts more than once or has no parent.
    """
    names = [name for table, d in declared.items() for name in promises(table, d)]
    numbers = {name: i for i, name in enumerate(names)}
    rows = reduce(DataFrame.unionByName, [_entries(tables[t], t, d, declared, numbers) for t, d in declared.items()])
    counts = rows.groupBy("number", "value").agg(F.sum("held").alias("held"), F.max("parent").alias("parent"))
    of = lambda kind: F.col("number").isin([i for n, i in numbers.items() if n.endswith(f"_{kind}")])
    broken = (
        F.when(of("null"), F.col("held"))
        .when(of("duplicate"), (F.col("held") > 1).cast("long"))
        .otherwise(F.when(F.col("parent") == 0, F.col("held")).otherwise(F.lit(0)))
    )
    found = counts.groupBy("number").agg(F.sum(broken).alias("violations"))
    every = found.sparkSession.createDataFrame([(i, n) for n, i in numbers.items()], "number int, check string")
    return every.join(F.broadcast(found), "number", "left").select("check", F.coalesce("violations", F.lit(0)).alias("violations"))


def promises(table: str, d: Declared) -> list[str]:
    """Names of the checks on a table."""
    keys = [f"{table}_pk_duplicate", *[f"{table}_{c}_duplicate" for c in d.unique]]
    return [*keys, *[f"{table}_{c}_null" for c in d.required()], *[f"{table}_{c}_orphan" for c in d.references]]


def _key_text(df: DataFrame, key: tuple[str, ...]) -> Column:
    """One text per key, null if any part is. Integers need no quotes to be told apart."""
    kinds = dict(df.dtypes)
    plain = all(kinds[c] in ("int", "bigint") for c in key)
    text = F.concat_ws(",", *[F.col(c).cast("string") for c in key]) if plain else F.to_json(F.struct(*key))
    return F.when(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key]), text)


def _entries(df: DataFrame, table: str, d: Declared, declared: dict[str, Declared], numbers: dict[str, int]) -> DataFrame:
    """(number, value, held, parent) of a table's rows, with each check's number; nulls break no uniqueness and refer to nothing."""

    def entry(check: str, value: Column, parent: bool = False) -> Column:
        made = F.struct(
            F.lit(numbers[check]).alias("number"), value.alias("value"), F.lit(int(not parent)).cast("long").alias("held"), F.lit(int(parent)).alias("parent")
        )
        return F.when(value.isNotNull(), made)

    text = lambda c: F.col(c).cast("string")
    entries = [entry(f"{table}_pk_duplicate", _key_text(df, d.key))]
    entries += [entry(f"{table}_{c}_duplicate", text(c)) for c in d.unique]
    entries += [entry(f"{table}_{c}_null", F.when(F.col(c).isNull(), F.lit(""))) for c in d.required()]
    entries += [entry(f"{table}_{c}_orphan", text(c)) for c in d.references]
    entries += [
        entry(f"{child}_{c}_orphan", text(d.key[0]), True)
        for child, other in declared.items()
        for c, parent in other.references.items()
        if parent == table
    ]
    return df.select(F.explode(F.array(*entries)).alias("e")).where("e is not null").select("e.*")


# --- text -------------------------------------------------------------------


def lost_text(raw: DataFrame) -> DataFrame:
    """Raw values that were given but became null, in one pass over the raw table."""
    def lost(column: str, parsed: Column) -> Column:
        return blank_to_null(strip(F.col(column))).isNotNull() & parsed.isNull()

    return broken_rows(
        raw,
        {
            "job_skills": unparsable(F.col("job_skills"), list_literal(F.col("job_skills"))),
            "job_type_skills": unparsable(F.col("job_type_skills"), dict_literal(F.col("job_type_skills"))),
            "job_posted_date": lost("job_posted_date", utc_timestamp(strip(F.col("job_posted_date")))),
            "salary_year_avg": lost("salary_year_avg", number(strip(F.col("salary_year_avg")))),
            "salary_hour_avg": lost("salary_hour_avg", number(strip(F.col("salary_hour_avg")))),
        },
    )


def _too_long(limits: dict[str, int]) -> dict[str, Column]:
    return {c: F.char_length(c) > n for c, n in limits.items()}


def too_long(df: DataFrame, limits: dict[str, int] = SKILL_LIMITS) -> DataFrame:
    """Texts beyond their declared length; as it stands, of the skill relation."""
    return broken_rows(df, _too_long(limits))


def size_limits(jobs: DataFrame, limits: dict[str, int] = TEXT_LIMITS) -> DataFrame:
    """Values too long, or too large for their decimal type, for the normalized tables."""
    rules = _too_long(limits)
    for column, kind in SALARY_DECIMALS.items():
        rules[column] = F.col(column).isNotNull() & F.col(column).try_cast(kind).isNull()
    return broken_rows(jobs, rules)


# --- use --------------------------------------------------------------------


class ChecksFailed(ValueError):
    """A load broke one of its rules."""


def enforce(report: DataFrame) -> None:
    """Raise if any check of the report found violations."""
    failed = report.where(F.col("violations") > 0).collect()
    if failed:
        raise ChecksFailed(", ".join(f"{row.check}: {row.violations}" for row in failed))
