from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from postmill.fixed import CLEAN_TYPES, RAW_COLUMNS, WHITESPACE
from postmill.functions.text import blank_to_null, number, strip, truth, utc_timestamp, utc_wall_clock
from postmill.operators import cleaning, quality


def apply(spark, function, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]


def test_strip_takes_all_white_space_but_no_other(spark):
    values = ["\ta\n", " 　a b\xa0", "​a", WHITESPACE, "", None, "a"]
    assert apply(spark, strip, values) == ["a", "a b", "​a", "", "", None, "a"]
    for c in WHITESPACE:
        assert apply(spark, strip, [f"{c}x{c}"]) == ["x"]


def test_blank_to_null(spark):
    assert apply(spark, blank_to_null, ["", " ", "a", None]) == [None, " ", "a", None]


def test_truth(spark):
    values = ["True", "yes", "Y", "1", " TRUE ", "no", "0", "other", "f", "", None]
    assert apply(spark, truth, values) == [True] * 5 + [False] * 4 + [None] * 2


def test_numbers(spark):
    values = ["1", "-1.5", "+.5", "2.", "1e3", "n/a", "", "1.0d", "2f", "0x1p3", "1,000", "1_000", None]
    assert apply(spark, number, values) == [1.0, -1.5, 0.5, 2.0, 1000.0] + [None] * 8
    inf, nan = apply(spark, number, ["-inf", "NaN"])
    assert inf == float("-inf") and nan != nan


POSTED = ["2023-06-16 13:44:15", "2023-06-16", "2023-02-30 00:00:00", "2023-06-16 25:00:00", "2023-6-16 13:44:15", "bad", "2023-06-16 13:44:15\n", None]


def test_posted_time_is_utc_in_any_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            wall = apply(spark, lambda c: utc_wall_clock(utc_timestamp(c)), POSTED + ["2023-03-12 02:30:00"])
            want = [datetime(2023, 6, 16, 13, 44, 15)] + [None] * 7 + [datetime(2023, 3, 12, 2, 30)]
            assert wall == want, zone
            seconds = apply(spark, lambda c: F.unix_seconds(utc_timestamp(c)), POSTED[:1])
            assert seconds == [1686923055]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def raw(spark, *rows):
    names = ["job_id", *RAW_COLUMNS]
    data = [tuple(r.get(n) for n in names) for r in rows]
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))


DIRTY = {
    "job_id": " 7 ",
    "job_title": " Data　Engineer\t",
    "company_name": "  ",
    "job_posted_date": " 2023-06-16 13:44:15 ",
    "job_work_from_home": "yes",
    "salary_year_avg": " 12.5 ",
    "salary_hour_avg": "n/a",
    "job_skills": " [' SQL', None, 'Python\t'] ",
    "job_type_skills": " {'a': ['b']} ",
}


def test_clean_postings(spark):
    df = cleaning.clean_postings(raw(spark, DIRTY, {"job_id": "x"}))
    assert quality.wrong_types(df, CLEAN_TYPES) == []
    first, second = df.orderBy(F.col("job_id").asc_nulls_last()).collect()
    assert first.job_id == 7
    assert first.job_title == "Data　Engineer"
    assert first.company_name is None
    assert first.job_work_from_home is True and first.job_health_insurance is None
    assert (first.salary_year_avg, first.salary_hour_avg) == (12.5, 0.0)
    assert first.job_skills == ["sql", None, "python"]
    assert first.job_type_skills == "{'a': ['b']}"
    assert second.job_id is None and second.job_skills == [] and second.salary_year_avg == 0.0


def test_unknown_salaries_may_stay_null(spark):
    row = cleaning.clean_postings(raw(spark, DIRTY), fill=None).first()
    assert (row.salary_year_avg, row.salary_hour_avg) == (12.5, None)


def test_cleaning_is_one_narrow_stage(spark):
    plan = cleaning.clean_postings(raw(spark, DIRTY))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_decimals(spark):
    df = spark.createDataFrame([(12345678.999, 12.345)], "a double, b double")
    row = df.select(F.col("a").try_cast("decimal(8,2)").alias("a"), F.col("b").try_cast("decimal(8,2)").alias("b")).first()
    assert (row.a, row.b) == (None, Decimal("12.35"))


def test_json_of_lists(spark):
    df = spark.createDataFrame([(1, ["a", 'q"', None]), (2, [])], "job_id int, job_skills array<string>")
    assert [r.job_skills for r in cleaning.skills_as_json(df).orderBy("job_id").collect()] == ['["a","q\\"",null]', "[]"]
