"""Every operator as a query over the order tables, read as job postings.

A query takes (spark, sf_dir) and returns a frame. Timestamps leave as
timestamp_ntz, lists as JSON text.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postmill.fixed import RAW_COLUMNS
from postmill.operators import cleaning, dimensions, keys, loading, losses, profiling, quality, skills
from postmill.plans import ledger, marts, normalized, warehouse
from postmill.session import scratch_path, written
from postmill.sources.derived import postings
from postmill.sources.files import read_postings, write_csv

TITLE = "HIGH"
COUNTRY = "NATION_7"


class Feed:
    """Tables derived from one folder, each made when first asked for.

    A table that is read more than once is written once.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    @cached_property
    def raw(self) -> DataFrame:
        return postings(self.spark, self.sf_dir)

    @cached_property
    def landed(self) -> DataFrame:
        return written(self.raw, "raw")

    @cached_property
    def clean(self) -> DataFrame:
        return cleaning.clean_postings(self.raw)

    @cached_property
    def unique(self) -> bool:
        """Whether no job_id repeats, found by a shuffle of ids alone."""
        return quality.duplicate_keys(self.raw.select("job_id"), ["job_id"]).isEmpty()

    @cached_property
    def by_job(self) -> DataFrame:
        return written(skills.skills_by_job(self.raw), "skills-by-job")

    @cached_property
    def relation(self) -> DataFrame:
        return skills.relation_in_row(self.by_job) if self.unique else written(skills.all_skills(self.raw), "relation")

    @cached_property
    def pairs(self) -> DataFrame:
        return skills.skill_pairs_by_job(self.by_job) if self.unique else skills.skill_pairs(self.relation)

    @cached_property
    def dim_skill(self) -> DataFrame:
        return dimensions.dim_skill(self.relation)

    @cached_property
    def lazy_bridge(self) -> DataFrame:
        return skills.bridge(self.pairs, self.dim_skill)

    @cached_property
    def bridge(self) -> DataFrame:
        return written(self.lazy_bridge, "bridge")

    @cached_property
    def lazy_jobs(self) -> DataFrame:
        """Of the raw postings only the orders and customers are read."""
        return cleaning.core_columns(self.clean)

    @cached_property
    def flat_jobs(self) -> DataFrame:
        return written(self.lazy_jobs, "jobs")

    @cached_property
    def dim_company(self) -> DataFrame:
        return dimensions.dim_company(self.flat_jobs)

    @cached_property
    def jobs(self) -> DataFrame:
        keyless = loading.with_empty_key(self.flat_jobs, "company_id")
        return loading.backfill_key(keyless, self.dim_company, "company_name", "company_id")

    @cached_property
    def keyed_jobs(self) -> DataFrame:
        """The jobs written with their companies, for queries that read them more than once."""
        return written(self.jobs, "keyed-jobs")

    @cached_property
    def deliveries(self) -> list[DataFrame]:
        """The contract jobs under an older title, then every posting."""
        older = F.concat(F.rtrim("job_title"), F.lit(" old"))
        return [self.landed.where("job_schedule_type = 'Contractor'").withColumn("job_title", older), self.landed]

    @cached_property
    def second_run(self) -> ledger.State:
        """The warehouse after both deliveries."""
        root = scratch_path(self.spark, "ledger")
        return [ledger.append(delivery, root) for delivery in self.deliveries][-1]

    def loaded(self, name: str) -> DataFrame:
        return ledger.table(self.spark, self.second_run, name)

    @cached_property
    def dirty_delivery(self) -> DataFrame:
        """Every posting, some with a text that cannot be kept, chosen by id."""
        of = lambda n: F.col("job_id") % n == 0
        other = {
            "job_skills": F.when(of(43), "[oops"),
            "job_title": F.when(of(59), "t" * 501),
            "salary_year_avg": F.when(of(61), "1e11"),
            "job_country": F.when(of(67), "c" * 101),
            "job_id": F.when(of(47), None).when(of(53), F.concat(F.lit("x"), "job_id")).otherwise(F.col("job_id").cast("string")),
        }
        number = other.pop("job_id")
        kept = [(F.when(other[c].isNotNull(), other[c]).otherwise(F.col(c)) if c in other else F.col(c)).alias(c) for c in RAW_COLUMNS]
        return written(self.raw.select(number.alias("job_id"), *kept), "dirty")

    @cached_property
    def dirty_bridge(self) -> DataFrame:
        """The bridge and, for each job without a company, one pair without its parents
        and one copy of all its pairs."""
        nameless = self.flat_jobs.where("company_name is null").select("job_id")
        strays = nameless.select((-F.col("job_id")).alias("job_id"), F.lit(None).cast("long").alias("skill_id"))
        copies = self.bridge.join(nameless, "job_id", "left_semi")
        return self.bridge.unionByName(strays).unionByName(copies)


Query = Callable[[Feed], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


# --- cleaning ---------------------------------------------------------------


@query
def raw_postings(feed: Feed) -> DataFrame:
    return feed.raw


@query
def strip_strings(feed: Feed) -> DataFrame:
    return cleaning.strip_strings(feed.raw)


@query
def blank_to_null(feed: Feed) -> DataFrame:
    return cleaning.blanks_to_null(cleaning.strip_strings(feed.raw))


@query
def bool_tokens(feed: Feed) -> DataFrame:
    return cleaning.with_booleans(feed.raw).select("job_id", *cleaning.BOOLEAN_COLUMNS)


@query
def parse_timestamp(feed: Feed) -> DataFrame:
    return cleaning.with_wall_clocks(cleaning.with_posted_time(feed.raw).select("job_id", "job_posted_date"))


@query
def numeric_lenient_zero(feed: Feed) -> DataFrame:
    numbers = cleaning.with_salaries(feed.raw, fill=None).select("job_id", *cleaning.SALARY_COLUMNS)
    return cleaning.fill_floats(numbers)


@query
def numeric_lenient(feed: Feed) -> DataFrame:
    return cleaning.with_salaries(feed.raw, fill=None).select("job_id", *cleaning.SALARY_COLUMNS)


@query
def clean_postings(feed: Feed) -> DataFrame:
    return cleaning.with_wall_clocks(cleaning.skills_as_json(feed.clean))


@query
def skills_as_json(feed: Feed) -> DataFrame:
    staged = feed.clean.select("job_id", F.size("job_skills").alias("skills"), "job_skills")
    return cleaning.skills_as_json(staged)


# --- skills and keys --------------------------------------------------------


@query
def row_ids(feed: Feed) -> DataFrame:
    rows = feed.raw.select("job_posted_date", "job_id", "job_title")
    return keys.dense_ids(rows, ["job_posted_date", "job_id"], "row_id")


@query
def skills_from_list(feed: Feed) -> DataFrame:
    return skills.list_skills(feed.raw)


@query
def skills_from_dict(feed: Feed) -> DataFrame:
    return skills.typed_skills(feed.raw)


@query
def job_skill_union(feed: Feed) -> DataFrame:
    return skills.all_skills(feed.raw)


@query
def job_skill_union_unique_ids(feed: Feed) -> DataFrame:
    return skills.all_skills(feed.raw, unique_jobs=True)


@query
def dim_skill(feed: Feed) -> DataFrame:
    return dimensions.dim_skill(skills.all_skills(feed.raw))


@query
def bridge_job_skill(feed: Feed) -> DataFrame:
    return feed.lazy_bridge


@query
def bridge_unique_ids(feed: Feed) -> DataFrame:
    pairs = written(skills.skill_pairs_in_row(feed.raw), "pairs")
    return skills.bridge(pairs, dimensions.dim_skill(pairs))


# --- core -------------------------------------------------------------------


@query
def dim_company(feed: Feed) -> DataFrame:
    return dimensions.dim_company(feed.clean)


@query
def company_names(feed: Feed) -> DataFrame:
    return feed.dim_company.select("company_name")


@query
def core_jobs(feed: Feed) -> DataFrame:
    return cleaning.with_wall_clocks(feed.jobs)


@query
def insert_if_absent_jobs(feed: Feed) -> DataFrame:
    """The contract jobs are held already, under an older title; then every posting
    is delivered twice, once with a longer title."""
    jobs = feed.flat_jobs
    retitled = {mark: jobs.withColumn("job_title", F.concat("job_title", F.lit(mark))) for mark in (" old", " again")}
    held = retitled[" old"].where("job_schedule_type = 'Contractor'")
    batch = jobs.unionByName(retitled[" again"])
    return cleaning.with_wall_clocks(loading.insert_absent(held, batch, "job_id"))


@query
def insert_if_absent_companies(feed: Feed) -> DataFrame:
    """Companies of contract jobs are held already; then all jobs arrive."""
    held = dimensions.dim_company(feed.flat_jobs.where("job_schedule_type = 'Contractor'"))
    return loading.insert_absent_names(held, feed.flat_jobs, "company_name", "company_id")


@query
def cascade_delete(feed: Feed) -> DataFrame:
    """Jobs without a company are deleted, and with them their skills."""
    deleted = feed.flat_jobs.where("company_name is null")
    return loading.without_deleted(feed.bridge, deleted, "job_id")


@query
def cascade_delete_skills(feed: Feed) -> DataFrame:
    """Skills whose main group is the first one are deleted, and with them their jobs."""
    groups = dimensions.main_groups(feed.relation).where("skill_group = 'economy'")
    deleted = feed.dim_skill.join(groups, "skill_name", "left_semi")
    return loading.without_deleted(feed.bridge, deleted, "skill_id")


# --- marts ------------------------------------------------------------------


@query
def mart_job_skills(feed: Feed) -> DataFrame:
    mart = marts.job_skills(feed.jobs, feed.bridge, feed.dim_skill, feed.dim_company)
    return cleaning.with_wall_clocks(mart)


@query
def skill_postings_direct(feed: Feed) -> DataFrame:
    counts = marts.postings_per_skill(feed.lazy_bridge, feed.dim_skill)
    return counts.orderBy(F.desc("postings"), "skill_name")


def _facts(feed: Feed) -> tuple[DataFrame, DataFrame, DataFrame]:
    return feed.lazy_jobs, feed.lazy_bridge, feed.dim_skill


@query
def skill_counts(feed: Feed) -> DataFrame:
    return marts.skill_counts(*_facts(feed)).orderBy(F.desc("postings"), "skill_name")


@query
def skill_counts_by_title(feed: Feed) -> DataFrame:
    return marts.skill_counts_by_title(*_facts(feed))


@query
def skill_counts_by_country(feed: Feed) -> DataFrame:
    return marts.skill_counts_by_country(*_facts(feed))


@query
def top20_skills(feed: Feed) -> DataFrame:
    return marts.most_wanted(marts.skill_counts(*_facts(feed)))


@query
def top20_skills_title(feed: Feed) -> DataFrame:
    counts = marts.skill_counts_by_title(*_facts(feed))
    return marts.most_wanted(counts.where(F.col("job_title_short") == TITLE))


@query
def top20_skills_country(feed: Feed) -> DataFrame:
    counts = marts.skill_counts_by_country(*_facts(feed))
    return marts.most_wanted(counts.where(F.col("job_country") == COUNTRY))


@query
def preview_jobs(feed: Feed) -> DataFrame:
    return cleaning.with_wall_clocks(feed.lazy_jobs.orderBy("job_id").limit(10))


# --- profiles ---------------------------------------------------------------


@query
def layer_counts(feed: Feed) -> DataFrame:
    return profiling.row_counts(
        {
            "raw_rows": feed.raw,
            "jobs_rows": feed.flat_jobs,
            "skills_rows": feed.dim_skill,
            "bridge_rows": feed.lazy_bridge,
            "companies_rows": feed.dim_company,
        }
    )


FIELDS = ledger.PROFILED


@query
def distinct_profile(feed: Feed) -> DataFrame:
    return profiling.distinct_counts(feed.clean, FIELDS)


@query
def distinct_profile_approximate(feed: Feed) -> DataFrame:
    return profiling.distinct_counts(feed.clean, FIELDS, approximate=True)


@query
def null_profile(feed: Feed) -> DataFrame:
    return profiling.null_profile(feed.clean)


@query
def dup_rows(feed: Feed) -> DataFrame:
    """Postings that differ in nothing but their id and their skills."""
    return profiling.duplicate_members(
        feed.lazy_jobs, ignore=("job_id", *cleaning.SALARY_COLUMNS)
    )


@query
def skill_profile(feed: Feed) -> DataFrame:
    return profiling.skill_profile(skills.all_skills(feed.raw))


@query
def table_summary(feed: Feed) -> DataFrame:
    return profiling.table_summary(feed.clean)


# --- checks -----------------------------------------------------------------


@query
def dq_orphans(feed: Feed) -> DataFrame:
    """References of the dirty bridge, and of jobs to the companies of contract jobs."""
    held = feed.keyed_jobs.where("job_schedule_type = 'Contractor'").select("company_id").distinct()
    return quality.references(feed.keyed_jobs, feed.dirty_bridge, feed.dim_skill, held)


@query
def dq_duplicate_pairs(feed: Feed) -> DataFrame:
    return quality.duplicate_keys(feed.dirty_bridge, ["job_id", "skill_id"])


@query
def dq_duplicates(feed: Feed) -> DataFrame:
    bridge = feed.dirty_bridge
    return quality.unite(
        [
            quality.duplicated(bridge, ["job_id", "skill_id"], "dup_pairs"),
            quality.duplicated(bridge, ["job_id"], "dup_job_ids"),
            quality.duplicated(bridge, ["skill_id"], "dup_skill_ids"),
            quality.duplicated(feed.relation, ["skill_name"], "dup_skill_names"),
            quality.duplicated(feed.keyed_jobs, ["company_name"], "dup_company_names"),
            quality.duplicated(feed.keyed_jobs, ["company_id"], "dup_company_ids"),
        ]
    )


@query
def dq_nulls(feed: Feed) -> DataFrame:
    return quality.null_sums(feed.dirty_bridge, {"null_job_id": "job_id", "null_skill_id": "skill_id"})


@query
def dq_missing_fk(feed: Feed) -> DataFrame:
    """Only companies of contract jobs are known, so other jobs lack theirs."""
    known = dimensions.dim_company(feed.flat_jobs.where("job_schedule_type = 'Contractor'"))
    jobs = loading.with_empty_key(feed.flat_jobs, "company_id")
    jobs = loading.backfill_key(jobs, known, "company_name", "company_id")
    return quality.missing_keys(jobs, "company_name", "company_id", "missing_company_id")


@query
def dq_parse_errors(feed: Feed) -> DataFrame:
    return quality.lost_text(feed.raw)


@query
def dq_lengths(feed: Feed) -> DataFrame:
    """Limits tight enough for the data to break: names of eight letters at most."""
    jobs = feed.clean
    return quality.size_limits(jobs, {column: 8 for column in quality.TEXT_LIMITS})


@query
def dq_skill_lengths(feed: Feed) -> DataFrame:
    return quality.too_long(skills.all_skills(feed.raw), {"skill_name": 8, "skill_group": 6})


@query
def dq_contract(feed: Feed) -> DataFrame:
    """Every contract's tables come from postings that were written once."""
    feed.raw = feed.landed
    return quality.unite(
        [
            quality.staging_contract(feed.clean),
            quality.relation_contract(skills.list_skills(feed.raw)),
            quality.core_constraints(feed.keyed_jobs, feed.bridge, feed.dim_skill, feed.dim_company),
        ]
    )


@query
def dq_contract_broken(feed: Feed) -> DataFrame:
    """The staging and relation contracts on tables that break them: two columns are gone, two have other
    types, and every skill of a job without a company comes twice, once blank."""
    staging = feed.clean.drop("job_via", "company_name").withColumns({c: F.col(c).cast("string") for c in cleaning.SALARY_COLUMNS})
    late = staging.withColumn("job_id", F.when(F.col("job_id") % 11 != 0, F.col("job_id")))
    listed = written(skills.list_skills(feed.landed), "listed")
    nameless = feed.flat_jobs.where("company_name is null").select("job_id")
    again = listed.join(nameless, "job_id", "left_semi")
    listed = listed.unionByName(again).unionByName(again.withColumn("skill_name", F.lit("")))
    return quality.unite([quality.staging_contract(late), quality.relation_contract(listed)])


@query
def dq_normalized(feed: Feed) -> DataFrame:
    """Every declared rule of the normalized tables, over tables that break some of each kind."""
    jobs, pairs = feed.flat_jobs, feed.pairs
    made = {
        "companies": normalized.companies(jobs),
        "locations": dimensions.locations(jobs),
        "platforms": normalized.platforms(jobs),
        "schedule_types": normalized.schedule_types(jobs),
        "skill_types": normalized.skill_types(feed.relation),
    }
    made["skills"] = normalized.skills(feed.dim_skill, feed.relation, made["skill_types"])
    made["job_skills_3nf"] = normalized.job_skills(pairs, made["skills"])
    fact = normalized.jobs_fact(jobs, *[made[t] for t in ("companies", "locations", "platforms", "schedule_types")])
    strays = F.when(F.col("job_id") % 43 == 0, -F.col("company_id")).otherwise(F.col("company_id"))
    made["jobs_3nf"] = fact.withColumn("company_id", strays)
    copied = {"platforms": "platform_id % 2 = 0", "jobs_3nf": "job_id % 47 = 0", "job_skills_3nf": "job_id % 53 = 0"}
    for name, which in copied.items():
        made[name] = made[name].unionByName(made[name].where(which))
    nameless = made["companies"].where("company_id % 50 = 0").withColumn("company_id", F.lit(None).cast("long"))
    made["companies"] = made["companies"].unionByName(nameless)
    even = F.col("schedule_type_id") % 2 == 0
    made["schedule_types"] = made["schedule_types"].withColumn("name", F.when(~even, F.col("name")))
    made["skills"] = made["skills"].where("skill_id % 10 <> 0")
    made["skill_types"] = made["skill_types"].where("skill_type_id <> 1")
    return quality.declared_constraints(made)


# --- normalized model -------------------------------------------------------


@query
def companies(feed: Feed) -> DataFrame:
    return normalized.companies(feed.clean)


@query
def locations(feed: Feed) -> DataFrame:
    return dimensions.locations(feed.clean)


@query
def platforms(feed: Feed) -> DataFrame:
    return normalized.platforms(feed.clean)


@query
def schedule_types(feed: Feed) -> DataFrame:
    return normalized.schedule_types(feed.clean)


@query
def skill_types(feed: Feed) -> DataFrame:
    return normalized.skill_types(skills.all_skills(feed.raw))


@query
def skills_typed(feed: Feed) -> DataFrame:
    return normalized.skills(feed.dim_skill, feed.relation, normalized.skill_types(feed.relation))


@query
def jobs_3nf(feed: Feed) -> DataFrame:
    jobs = feed.flat_jobs
    return normalized.jobs_fact(
        jobs,
        normalized.companies(jobs),
        dimensions.locations(jobs),
        normalized.platforms(jobs),
        normalized.schedule_types(jobs),
    )


@query
def job_skills_3nf(feed: Feed) -> DataFrame:
    typed = normalized.skills(feed.dim_skill, feed.relation, normalized.skill_types(feed.relation))
    return normalized.job_skills(feed.pairs, typed)


# --- files and tables -------------------------------------------------------


@query
def csv_roundtrip(feed: Feed) -> DataFrame:
    """Postings written as files in id order without ids, read back and numbered by file."""
    path = scratch_path(feed.spark, "csv")
    ordered = feed.raw.repartitionByRange("job_id").sortWithinPartitions("job_id")
    write_csv(ordered.drop("job_id"), path)
    return keys.file_row_ids(read_postings(feed.spark, path))


@query
def written_tables(feed: Feed) -> DataFrame:
    """Row counts of all tables of a whole run, read back from what it wrote."""
    run = warehouse.run_batch(feed.landed, scratch_path(feed.spark, "run"))
    counts = [
        df.agg(F.lit(f"{layer}.{name}").alias("table"), F.count("*").alias("rows"))
        for (layer, name), df in run.tables.items()
    ]
    return quality.unite(counts)


@query
def csv_shuffled_columns(feed: Feed) -> DataFrame:
    """Postings in two folders of files, one with its columns in another order and one more."""
    path = scratch_path(feed.spark, "csv")
    parity = F.col("job_id") % 2
    write_csv(feed.landed.where(parity == 0), f"{path}/kind=a")
    other = feed.landed.where(parity == 1).select(*RAW_COLUMNS[::-1], F.lit("note").alias("note"), "job_id")
    write_csv(other, f"{path}/kind=b")
    return read_postings(feed.spark, f"{path}/*")


@query
def csv_ragged(feed: Feed) -> DataFrame:
    """Whole postings in some files, and in others records that end after two fields or go on after the last."""
    path = scratch_path(feed.spark, "csv")
    write_csv(feed.landed, f"{path}/kind=whole")
    few = F.concat(F.col("job_id").cast("string"), F.lit(","), "job_country")
    many = F.concat(few, F.lit("," * len(RAW_COLUMNS)), F.lit("more"))
    record = F.when(F.col("job_id") % 2 == 0, few).otherwise(many)
    # The first record of every file comes with the header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << keys.POSITION_BITS) - 1)) == 0
    header = F.lit(",".join(["job_id", *RAW_COLUMNS]) + "\n")
    lines = feed.landed.select(F.when(first, F.concat(header, record)).otherwise(record))
    lines.write.text(f"{path}/kind=ragged")
    rows = read_postings(feed.spark, f"{path}/*", ragged=losses.RAGGED_COLUMN)
    ragged = F.col(losses.RAGGED_COLUMN)
    return rows.select(F.coalesce(ragged, F.concat(F.lit("whole "), "job_id")).alias("record"), ragged.isNotNull().alias("ragged"))


# --- loads after loads ------------------------------------------------------


@query
def second_run_jobs(feed: Feed) -> DataFrame:
    """Jobs after both deliveries, and after the second has come once more."""
    state = ledger.append(feed.deliveries[1], feed.second_run.root)
    return cleaning.with_wall_clocks(ledger.table(feed.spark, state, "core.jobs"))


@query
def second_run_bridge(feed: Feed) -> DataFrame:
    return feed.loaded("core.bridge_job_skill")


@query
def second_run_skill_counts(feed: Feed) -> DataFrame:
    """The three counting marts, added up from what each load counted of its own jobs."""
    parts = {"skill_counts": F.lit(None), "skill_counts_by_title": F.col("job_title_short"), "skill_counts_by_country": F.col("job_country")}
    rows = [
        feed.loaded(f"marts.{name}").select(F.lit(name).alias("mart"), by.cast("string").alias("value"), "skill_name", "postings")
        for name, by in parts.items()
    ]
    return quality.unite(rows)


@query
def second_run_companies_3nf(feed: Feed) -> DataFrame:
    return feed.loaded("normalized.companies")


@query
def second_run_skills_3nf(feed: Feed) -> DataFrame:
    """Skills with the type that the jobs of both loads give most, by names."""
    types = feed.loaded("normalized.skill_types").withColumnRenamed("name", "skill_type")
    return feed.loaded("normalized.skills").join(types, "skill_type_id", "left").select("skill_id", "name", "skill_type")


@query
def second_run_layer_counts(feed: Feed) -> DataFrame:
    """Rows of the core tables and the last delivery, as the loads counted them while they wrote."""
    kept = ("staging.records", "core.jobs", "core.dim_company", "core.dim_skill", "core.bridge_job_skill")
    return ledger.layer_counts(feed.spark, feed.second_run).where(F.col("table").isin(*kept))


@query
def second_run_unnumbered(feed: Feed) -> DataFrame:
    """Files without ids: the contract jobs, then every posting; records are known by their content."""
    root = scratch_path(feed.spark, "ledger")
    for i, delivery in enumerate([feed.landed.where("job_schedule_type = 'Contractor'"), feed.landed]):
        path = scratch_path(feed.spark, f"csv-{i}")
        ordered = delivery.repartitionByRange("job_id").sortWithinPartitions("job_id")
        write_csv(ordered.drop("job_id"), path, gzip=True)
        state = ledger.append_csv(feed.spark, path, root)
    return cleaning.with_wall_clocks(ledger.table(feed.spark, state, "core.jobs")).drop("company_id")


@query
def run_report(feed: Feed) -> DataFrame:
    """What a load of dirty postings lost, by reason."""
    state = ledger.append(feed.dirty_delivery, scratch_path(feed.spark, "ledger"), {"missing": 1.0, "unparsable job_id": 1.0})
    return state.table(feed.spark, "quality.run_report").drop("load")


@query
def published_mart(feed: Feed) -> DataFrame:
    """The job_skills mart as the catalog shows it after the first load and then the second were published."""
    place = scratch_path(feed.spark, "catalog")
    prefix = f"p{place[-12:]}_"
    for state in ledger.states(feed.spark, feed.second_run.root):
        ledger.publish(feed.spark, state, prefix, place)
    return cleaning.with_wall_clocks(feed.spark.table(f"{prefix}marts.job_skills"))


@query
def distinct_estimates(feed: Feed) -> DataFrame:
    """Whether the estimates merged over both loads lie within their declared error of the exact counts."""
    exact = quality.as_rows(profiling.distinct_counts(feed.loaded("core.jobs"), FIELDS), "field", "exact")
    near = ledger.distinct_profile(feed.spark, feed.second_run).join(exact, "field")
    return near.select("field", (F.abs(F.col("estimate") - F.col("exact")) <= ledger.SKETCH_ERROR * F.col("exact")).alias("within_error"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bound(function: Query) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: function(Feed(spark, sf_dir))

    return {name: bound(function) for name, function in REGISTRY.items()}
