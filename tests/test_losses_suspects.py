"""A record that no rule suspects is not looked at rule by rule; what is lost stays the same."""

from pyspark.sql import functions as F

from postmill.fixed import RAW_COLUMNS
from postmill.operators import losses


def test_long_names_are_lost_and_clean_records_lose_nothing(spark):
    long, padded = "s" * 101, " " * 60 + "s" * 100 + " "
    rows = [
        ("1", f"['{long}', 'a']", "{'g': ['b']}"),
        ("2", f"['{padded}']", f"{{'{long}': None}}"),
        ("3", None, None),
        ("x", "[oops", "{'g': None}"),
    ]
    given = spark.createDataFrame(rows, "job_id string, job_skills string, job_type_skills string")
    raw = given.select("job_id", *[F.col(c) if c in given.columns else F.lit(None).cast("string").alias(c) for c in RAW_COLUMNS])
    lost = losses.typed(raw).select(F.col("lost.column").alias("c"), F.col("lost.reason").alias("r")).collect()
    assert sorted(tuple(zip(x.c, x.r, strict=True)) for x in lost) == [
        (),
        (("job_id", "unparsable"), ("job_skills", "unparsable")),
        (("skill_group", "too long"),),
        (("skill_name", "too long"),),
    ]


def test_rules_are_told_by_a_cheaper_sign_first(spark):
    assert all(rule.suspect is not None for rule in losses.rules(True, False) if rule.column in ("skill_name", "skill_group"))
