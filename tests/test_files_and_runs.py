from collections import Counter
from types import SimpleNamespace

import pytest
from plans import plan
from pyspark.sql import functions as F

from postmill.fixed import RAW_COLUMNS
from postmill.operators import keys, quality
from postmill.plans import marts, warehouse
from postmill.session import scratch_path, shared_folder
from postmill.sources import files, tables

HEADER = ",".join(RAW_COLUMNS)


def line(title, skills="['sql']", company="acme", title_short="DE"):
    values = dict.fromkeys(RAW_COLUMNS, "")
    values |= {"job_title_short": title_short, "job_title": title, "company_name": company, "job_location": "Here", "job_posted_date": "2023-06-16 13:44:15"}
    quoted = {c: '"' + v.replace('"', '""') + '"' if any(x in v for x in ',"\n') else v for c, v in values.items()}
    skills = '"' + skills.replace('"', '""') + '"'
    return ",".join([*(quoted[c] for c in RAW_COLUMNS[:-2]), skills, ""])


def write(path, *lines):
    path.write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")


def test_quoted_newlines_quotes_and_blanks(spark, tmp_path):
    write(tmp_path / "a.csv", line('He said "hi",\nthen left'), line("plain"))
    rows = files.read_postings(spark, str(tmp_path)).collect()
    assert [r.job_title for r in rows] == ['He said "hi",\nthen left', "plain"]
    assert rows[0].job_skills == "['sql']" and rows[0].job_via is None


def test_only_files_with_open_quotes_are_read_whole(spark, tmp_path):
    write(tmp_path / "one.csv", line("two\nlines"), line("x"))
    write(tmp_path / "two.csv", line('with "quotes"'), line("y"))
    found = files.layouts(spark, str(tmp_path))
    assert [f.rsplit("/", 1)[1] for f, layout in found.items() if layout.open_quotes] == ["one.csv"]
    got = files.read_postings(spark, str(tmp_path))
    assert Counter(r.job_title for r in got.collect()) == Counter(["two\nlines", "x", 'with "quotes"', "y"])
    ids = keys.file_row_ids(got)
    assert [(r.job_id, r.job_title) for r in ids.orderBy("job_id").collect()] == [(1, "two\nlines"), (2, "x"), (3, 'with "quotes"'), (4, "y")]


def test_job_ids_in_the_file_are_kept(spark, tmp_path):
    (tmp_path / "a.csv").write_text(f"job_id,{HEADER}\n5,{line('a')}\n", encoding="utf-8")
    raw = files.read_postings(spark, str(tmp_path))
    assert warehouse.with_job_ids(raw).first().job_id == "5"


def test_row_ids_over_many_pieces_of_many_files(spark, tmp_path):
    """Files larger than a scan piece, read by tasks that hold several pieces each."""
    want = []
    for f in range(3):
        lines = [line(f"{f}-{i:05d} " + "x" * (i % 50)) for i in range(1500)]
        write(tmp_path / f"part-{f}.csv", *lines)
        want += [f"{f}-{i:05d}" for i in range(1500)]
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
        raw = files.read_postings(spark, str(tmp_path), multi_line=False)
        assert raw.rdd.getNumPartitions() > 12
        ids = keys.file_row_ids(raw).select("job_id", F.substring_index("job_title", " ", 1).alias("t"))
        assert [(r.job_id, r.t) for r in ids.orderBy("job_id").collect()] == list(enumerate(want, 1))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_csv_roundtrip_keeps_null_blank_and_spaces(spark, tmp_path):
    values = [None, "", " a ", 'q"', "x\ny", "é,", "\\", "'"]
    df = spark.createDataFrame([tuple([v] * 17) for v in values], ", ".join(f"{c} string" for c in RAW_COLUMNS))
    files.write_csv(df.coalesce(1), str(tmp_path / "out"))
    back = files.read_postings(spark, str(tmp_path / "out"))
    assert Counter(map(tuple, back.select(RAW_COLUMNS).collect())) == Counter(map(tuple, df.collect()))


# --- runs -------------------------------------------------------------------


def test_a_run_from_files(spark, tmp_path):
    write(tmp_path / "a.csv", line("one", "['SQL', 'Python']"), line("two", "['sql']", company=""), line("three", "oops", company="b"))
    run = warehouse.run_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    assert run.staged_rows == 3 and run.unique_jobs
    assert {tuple(r) for r in run["dim_skill"].collect()} == {(1, "python"), (2, "sql")}
    assert {tuple(r) for r in run["bridge_job_skill"].collect()} == {(1, 1), (1, 2), (2, 2)}
    assert {(r.job_id, r.company_id) for r in run["jobs"].collect()} == {(1, 1), (2, None), (3, 2)}
    assert {tuple(r) for r in run["skill_counts"].collect()} == {("sql", 2), ("python", 1)}
    assert run["data_jobs_raw"].where("job_id = 3").first().job_skills == "[]"
    assert {r.violations for r in warehouse.core_report(run).collect()} == {0}


def test_a_run_writes_over_no_other(spark, tmp_path):
    write(tmp_path / "a.csv", line("one"))
    warehouse.run_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))
    with pytest.raises(Exception, match="already exists"):
        warehouse.run_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "out"))


def test_a_bad_run_stops_before_the_marts(spark, tmp_path):
    kinds = "job_id long, " + ", ".join(f"{c} string" for c in RAW_COLUMNS)
    raw = spark.createDataFrame([(None, *[None] * 17)], kinds)
    with pytest.raises(quality.ChecksFailed, match="null_job_id: 1"):
        warehouse.run_batch(raw, str(tmp_path / "out"))
    assert not (tmp_path / "out" / "marts").exists()


def test_published_tables_and_view(spark, tmp_path):
    write(tmp_path / "a.csv", line("one", "['sql']"), line("two", "['sql', 'r']", company="b"))
    run = warehouse.run_csv(spark, str(tmp_path / "a.csv"), str(tmp_path / "v1"))
    warehouse.publish_run(spark, run, "t_")
    assert spark.table("t_core.dim_skill").count() == 2
    view = spark.table("t_marts.job_skills")
    assert view.columns == warehouse.MART_COLUMNS
    want = marts.job_skills(run["jobs"], run["bridge_job_skill"], run["dim_skill"], run["dim_company"])
    assert Counter(map(tuple, view.collect())) == Counter(map(tuple, want.collect()))

    write(tmp_path / "b.csv", line("three", "['sql']"))
    warehouse.publish_run(spark, warehouse.run_csv(spark, str(tmp_path / "b.csv"), str(tmp_path / "v2")), "t_")
    assert spark.table("t_core.dim_skill").count() == 1 and spark.table("t_marts.job_skills").count() == 1
    assert run["dim_skill"].count() == 2  # files of the earlier run are untouched


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    ids = spark.range(1000).select(F.col("id").alias("job_id"))
    spark.sql("CREATE DATABASE IF NOT EXISTS t_buckets")
    jobs = tables.write_bucketed(ids.withColumn("job_title_short", F.lit("x")), "t_buckets.jobs", "job_id", 4, str(tmp_path / "j"))
    pairs = tables.write_bucketed(ids.withColumn("skill_id", F.lit(1)), "t_buckets.pairs", "job_id", 4, str(tmp_path / "p"))
    joined = jobs.join(pairs.hint("merge"), "job_id")
    assert "Exchange" not in plan(joined) and joined.count() == 1000


class Session:
    """The parts of a session that name its folder."""

    def __init__(self, named, known, master):
        settings = {} if named is None else {"spark.checkpoint.dir": named}
        self.conf = SimpleNamespace(get=settings.get)
        self.sparkContext = SimpleNamespace(getCheckpointDir=lambda: known, master=master)


def test_shared_folder_is_the_one_the_session_names():
    assert shared_folder(Session("/shared", "/other", "yarn")) == "/shared"
    assert scratch_path(Session("/shared/", None, "yarn"), "x").startswith("/shared/postmill/x-")
    assert shared_folder(Session(None, "/set", "yarn")) == "/set"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session(None, None, "spark://host"))
