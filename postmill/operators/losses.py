"""Typed records that carry what could not be taken as it was given.

A record is parsed once. What it loses by that, each with column, reason and the text as it was
given, stays with it as an array until the load writes it apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postmill.fixed import BOOLEAN_COLUMNS, RAW_COLUMNS, SALARY_DECIMALS, SKILL_LIMITS, TEXT_LIMITS
from postmill.functions.literals import dict_literal, list_literal, unparsable
from postmill.functions.text import blank_to_null, normal_name, number, strip, truth, utc_timestamp
from postmill.operators.skills import distinct_pairs, folded_entries, joined_entries

MISSING = "missing"
RAGGED = "ragged"
UNPARSABLE = "unparsable"
TOO_LONG = "too long"
TOO_LARGE = "too large"

LOSSES = "array<struct<column:string,reason:string,value:string>>"

#: Column of a raw record that holds its text if it has not one field for every column.
RAGGED_COLUMN = "_ragged_record"


@dataclass(frozen=True)
class Rule:
    """A way to lose something: where it holds, `value` could not be kept."""

    column: str
    reason: str
    broken: Column
    value: Column
    #: Cheaper to tell than `broken`, and true wherever that is.
    suspect: Column | None = None

    @property
    def name(self) -> str:
        return f"{self.reason} {self.column}"

    def found(self) -> Column:
        loss = F.struct(F.lit(self.column).alias("column"), F.lit(self.reason).alias("reason"), self.value.alias("value"))
        return F.when(self.broken, loss)


def rules(numbered: bool, ragged: bool) -> list[Rule]:
    """Over the columns that `typed` has parsed; texts are stripped."""
    given = lambda c: blank_to_null(F.col(c)).isNotNull()
    text = F.col
    found = []
    if numbered:
        found.append(Rule("job_id", MISSING, ~given("job_id") & whole(ragged), F.lit(None).cast("string")))
        found.append(Rule("job_id", UNPARSABLE, given("job_id") & F.col("_id").isNull() & whole(ragged), text("job_id")))
    if ragged:
        found.append(Rule("record", RAGGED, ~whole(ragged), text(RAGGED_COLUMN)))
    found += [
        Rule("job_skills", UNPARSABLE, unparsable(F.col("job_skills"), F.col("_names")), text("job_skills")),
        Rule("job_type_skills", UNPARSABLE, unparsable(F.col("job_type_skills"), F.col("_groups")), text("job_type_skills")),
        Rule("job_posted_date", UNPARSABLE, given("job_posted_date") & F.col("_posted").isNull(), text("job_posted_date")),
    ]
    for column, kind in SALARY_DECIMALS.items():
        parsed = F.col(f"_{column}")
        found.append(Rule(column, UNPARSABLE, given(column) & parsed.isNull(), text(column)))
        found.append(Rule(column, TOO_LARGE, parsed.isNotNull() & parsed.try_cast(kind).isNull(), text(column)))
    for column, most in TEXT_LIMITS.items():
        found.append(Rule(column, TOO_LONG, F.char_length(column) > most, text(column)))
    names = F.flatten(F.transform("entries", lambda e: F.coalesce(e["value"], F.array().cast("array<string>"))))
    groups = F.transform("entries", lambda e: e["key"])
    for column, values in (("skill_name", names), ("skill_group", groups)):
        beyond = longer_than(values, SKILL_LIMITS[column])
        found.append(Rule(column, TOO_LONG, F.size(beyond) > 0, F.to_json(beyond), any_long(column)))
    return found


def any_long(column: str) -> Column:
    """Whether any skill or group of the entries is beyond its limit before it is stripped."""
    most = SKILL_LIMITS[column]
    if column == "skill_group":
        return F.exists("entries", lambda e: F.char_length(e["key"]) > most)
    return F.exists("entries", lambda e: F.exists(e["value"], lambda value: F.char_length(value) > most))


def lost(found: list[Rule]) -> Column:
    """All losses of a record as an array. Only for records that any rule suspects are they looked at one by one."""
    every = F.filter(F.array(*[rule.found() for rule in found]), lambda loss: loss.isNotNull())
    suspects = [F.coalesce(rule.broken if rule.suspect is None else rule.suspect, F.lit(False)) for rule in found]
    return F.when(reduce(lambda a, b: a | b, suspects), every).otherwise(F.array().cast(LOSSES))


def longer_than(values: Column, most: int) -> Column:
    return F.filter(values, lambda value: F.char_length(strip(value)) > most)


def whole(ragged: bool) -> Column:
    return F.col(RAGGED_COLUMN).isNull() if ragged else F.lit(True)


def typed(raw: DataFrame) -> DataFrame:
    """Raw postings as typed records: one projection, every literal parsed once.

    Columns: job_id if there is one, the cleaned posting (job_skills as JSON text), pairs (its distinct skills with
    their groups), lost (what could not be kept) and all other columns as they came.
    """
    numbered, ragged = "job_id" in raw.columns, RAGGED_COLUMN in raw.columns
    texts = [*(["job_id"] if numbered else []), *RAW_COLUMNS]
    other = [c for c in raw.columns if c not in texts]
    stripped = raw.select(*other, *[strip(F.col(c).cast("string")).alias(c) for c in texts])
    parsed = stripped.select(
        "*",
        *([F.col("job_id").try_cast("long").alias("_id")] if numbered else []),
        list_literal(F.col("job_skills")).alias("_names"),
        dict_literal(F.col("job_type_skills")).alias("_groups"),
        utc_timestamp(F.col("job_posted_date")).alias("_posted"),
        *[number(F.col(c)).alias(f"_{c}") for c in SALARY_DECIMALS],
    )
    parsed = parsed.withColumns(
        {"entries": joined_entries(F.col("_names"), F.col("_groups")), "_clean": F.transform("_names", normal_name)}
    )
    # Names are folded once, for the JSON text as for the pairs.
    parsed = parsed.withColumn("_folded", folded_entries(F.col("_clean"), F.col("entries")))
    made = {c: truth(F.col(c)) for c in BOOLEAN_COLUMNS}
    made |= {c: F.coalesce(f"_{c}", F.lit(0.0)) for c in SALARY_DECIMALS}
    made |= {"job_posted_date": F.col("_posted"), "job_skills": F.to_json(F.coalesce("_clean", F.array().cast("array<string>")))}
    return parsed.select(
        *([F.col("_id").alias("job_id")] if numbered else []),
        *[made.get(c, blank_to_null(F.col(c))).alias(c) for c in RAW_COLUMNS],
        distinct_pairs(F.col("_folded")).alias("pairs"),
        lost(rules(numbered, ragged)).alias("lost"),
        *other,
    )


def loss_counts(numbered: bool, ragged: bool) -> dict[str, Column]:
    """Aggregates over typed records: how many lose what. Column names are spared the rules' own."""

    def holds(rule: Rule) -> Column:
        return F.exists("lost", lambda loss: (loss["column"] == rule.column) & (loss["reason"] == rule.reason))

    return {rule.name: F.count_if(holds(rule)) for rule in rules(numbered, ragged)}


def losses(records: DataFrame, keys: list[str]) -> DataFrame:
    """One row per loss: the record's keys, column, reason and value."""
    return records.where(F.size("lost") > 0).select(*keys, F.inline("lost"))
