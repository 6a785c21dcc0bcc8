"""The one-shot run: raw postings in, staging, core, normalized and mart tables out.

It builds everything from the postings it is given. Deliveries that follow each other go to
`ledger`, which adds what is new.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from postmill.fixed import MART_COLUMNS
from postmill.operators import quality
from postmill.operators.cleaning import clean_postings, core_columns, skills_as_json
from postmill.operators.dimensions import dim_company, dim_skill, locations
from postmill.operators.keys import file_row_ids
from postmill.operators.loading import backfill_key, one_per_key, with_empty_key
from postmill.operators.skills import all_skills, bridge, relation_in_row, skill_pairs, skill_pairs_by_job, skills_by_job
from postmill.plans import marts, normalized
from postmill.session import written
from postmill.sources.files import read_postings
from postmill.sources.tables import create_layers, publish, write_table


@dataclass
class Run:
    """What a run wrote: tables by layer and name, and the rows it staged."""

    root: str
    tables: dict[tuple[str, str], DataFrame] = field(default_factory=dict)
    staged_rows: int = 0
    unique_jobs: bool = False

    def __getitem__(self, name: str) -> DataFrame:
        return next(df for (_, table), df in list(self.tables.items()) if table == name)

    def write(self, layer: str, name: str, df: DataFrame) -> DataFrame:
        self.tables[layer, name] = write_table(df, self.root, layer, name)
        return self.tables[layer, name]


def with_job_ids(raw: DataFrame) -> DataFrame:
    """Postings that came without job_id are numbered in file order."""
    return raw if "job_id" in raw.columns else file_row_ids(raw)


def stage(run: Run, raw: DataFrame) -> DataFrame:
    """Clean postings and write them; rows are counted by the write itself.

    Whether job ids repeat is looked up once, by a shuffle of ids alone: if none
    does, no later step has to shuffle postings or skills to make them distinct.
    """
    loaded = Observation("staging")
    staging = skills_as_json(clean_postings(with_job_ids(raw))).observe(loaded, F.count("*").alias("rows"))
    table = run.write("staging", "data_jobs_raw", staging)
    run.staged_rows = loaded.get["rows"]
    run.unique_jobs = quality.duplicate_keys(table, ["job_id"]).isEmpty()
    return table


def together(*builders: Callable[[], object]) -> None:
    """Run builders of independent tables at the same time.

    Small tables keep few tasks busy each; side by side they fill the cluster that
    one after the other they would leave idle.
    """
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(builders)) as pool:
        for done in [pool.submit(in_session(build)) for build in builders]:
            done.result()


def build_core(run: Run, staging: DataFrame) -> None:
    """Skill relation, dimensions, bridge and jobs."""
    together(lambda: build_skills(run, staging), lambda: build_jobs(run, staging))


def build_skills(run: Run, staging: DataFrame) -> None:
    unique = run.unique_jobs
    # Texts are parsed and names folded once, for the relation as for the pairs.
    by_job = written(skills_by_job(staging), "skills-by-job") if unique else None
    relation = run.write("staging", "job_skill_all", relation_in_row(by_job) if unique else all_skills(staging))
    skills = run.write("core", "dim_skill", dim_skill(relation))
    pairs = skill_pairs_by_job(by_job) if unique else skill_pairs(relation)
    run.write("core", "bridge_job_skill", bridge(pairs, skills))


def build_jobs(run: Run, staging: DataFrame) -> None:
    batch = core_columns(staging).where(F.col("job_id").isNotNull())
    jobs = with_empty_key(batch if run.unique_jobs else one_per_key(batch, "job_id"), "company_id")
    jobs = run.write("staging", "jobs_to_key", jobs)
    companies = run.write("core", "dim_company", dim_company(jobs))
    run.write("core", "jobs", backfill_key(jobs, companies, "company_name", "company_id"))


def build_normalized(run: Run) -> None:
    together(lambda: normalized_skills(run), lambda: normalized_jobs(run))


def normalized_skills(run: Run) -> None:
    relation = run["job_skill_all"]
    types = run.write("normalized", "skill_types", normalized.skill_types(relation))
    run.write("normalized", "skills", normalized.skills(run["dim_skill"], relation, types))
    # Skills keep the ids of dim_skill, so the junction table is the bridge.
    run.write("normalized", "job_skills_3nf", run["bridge_job_skill"])


def normalized_jobs(run: Run) -> None:
    jobs = run["jobs"]
    makers = {
        "companies": normalized.companies,
        "locations": locations,
        "platforms": normalized.platforms,
        "schedule_types": normalized.schedule_types,
    }
    together(*[partial(_write_made, run, name, make, jobs) for name, make in makers.items()])
    fact = normalized.jobs_fact(jobs, *[run[name] for name in makers])
    run.write("normalized", "jobs_3nf", fact)


def _write_made(run: Run, name: str, make: Callable[[DataFrame], DataFrame], source: DataFrame) -> None:
    run.write("normalized", name, make(source))


def build_marts(run: Run) -> None:
    """The counting marts as tables; job_skills stays a view."""
    tables = {name: df for name, df in mart_views(run).items() if name != "job_skills"}
    together(*[partial(run.write, "marts", name, df) for name, df in tables.items()])


def mart_views(run: Run) -> dict[str, DataFrame]:
    jobs, pairs, skills = run["jobs"], run["bridge_job_skill"], run["dim_skill"]
    return {
        "job_skills": marts.job_skills(jobs, pairs, skills, run["dim_company"]),
        "skill_counts": marts.skill_counts(jobs, pairs, skills),
        "skill_counts_by_title": marts.skill_counts_by_title(jobs, pairs, skills),
        "skill_counts_by_country": marts.skill_counts_by_country(jobs, pairs, skills),
    }


def core_report(run: Run) -> DataFrame:
    """All checks that a good load passes with zero violations."""
    return quality.unite(
        [
            quality.staging_contract(run["data_jobs_raw"]),
            quality.core_constraints(run["jobs"], run["bridge_job_skill"], run["dim_skill"], run["dim_company"]),
        ]
    )


def run_batch(raw: DataFrame, root: str, strict: bool = True) -> Run:
    """One complete run below `root`, a new folder.

    With `strict` a run that breaks a rule raises before its marts are written.
    """
    run = Run(root)
    staging = stage(run, raw)
    build_core(run, staging)
    if strict:
        together(lambda: quality.enforce(core_report(run)), lambda: build_normalized(run))
    else:
        build_normalized(run)
    build_marts(run)
    return run


def run_csv(spark: SparkSession, path: str, root: str) -> Run:
    return run_batch(read_postings(spark, path), root)


def publish_run(spark: SparkSession, run: Run, prefix: str = "") -> None:
    """Catalog tables for the run, and the job_skills mart as a view over them."""
    create_layers(spark, prefix)
    for layer, name in run.tables:
        publish(spark, run.root, layer, name, prefix)
    spark.sql(
        f"""
        CREATE OR REPLACE VIEW `{prefix}marts`.`job_skills` AS
        SELECT {", ".join("c.company_name" if c == "company_name" else c for c in MART_COLUMNS)}
        FROM (SELECT * EXCEPT (company_name) FROM `{prefix}core`.`jobs`)
        JOIN `{prefix}core`.`bridge_job_skill` USING (job_id)
        JOIN `{prefix}core`.`dim_skill` USING (skill_id)
        LEFT JOIN `{prefix}core`.`dim_company` c USING (company_id)
        """
    )
