"""The warehouse as a ledger: every load appends what is new and rewrites nothing.

A load writes below a folder of its own and then one manifest, which names the folders of every
table as of that load and the highest id given out so far. Until the manifest is there, nothing of
the load is seen; what an interrupted load left behind is never read.

What is new is told by job_id, or, in deliveries without one, by the digest of the whole record:
a record that a delivery holds more often than all earlier ones together is new as many times as
it is more. Numbers go on from the highest id. A job's skills come with the job, so the bridge,
the counts of the marts and the profiles are sums and unions over loads, and a load reads only
its own postings, the key columns of known tables and the registries of names.

Names keep their ids for good: one registry per dimension serves core and normalized tables.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postmill.fixed import JOB_COLUMNS, MART_COLUMNS, RAW_COLUMNS
from postmill.operators import losses, quality, skills
from postmill.operators.dimensions import given_names
from postmill.operators.joins import fits_broadcast, lookup, without_ids
from postmill.operators.keys import PLACE, dense_ids, picked_rows, placed_row_ids
from postmill.operators.loading import backfill_key, one_per_key, with_empty_key
from postmill.plans import normalized
from postmill.session import written
from postmill.sources.files import read_postings
from postmill.sources.tables import create_layers

#: Largest share of a delivery's records that may lose something, by rule or by reason; whatever is not named may.
ALLOWED = {losses.MISSING: 0.0, "unparsable job_id": 0.0}

PROFILED = {
    "distinct_companies": "company_name",
    "distinct_job_locations": "job_location",
    "distinct_schedule_types": "job_schedule_type",
    "distinct_sources": "job_via",
    "distinct_countries": "job_country",
}
#: Buckets of a sketch as a power of two, and the relative error that estimates keep within.
SKETCH_BITS = 12
SKETCH_ERROR = 0.05

BY_SKILL, BY_TITLE, BY_COUNTRY = 3, 1, 2

#: What is read of new postings once they are told.
NEW_COLUMNS = [*JOB_COLUMNS, "pairs"]


@dataclass(frozen=True)
class State:
    """The warehouse as of one load."""

    root: str
    number: int = 0
    numbered: bool | None = None
    paths: dict[str, list[str]] = field(default_factory=dict)
    schemas: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)
    marks: dict[str, int] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(self.schemas[name]))
        return spark.read.schema(schema).parquet(*self.paths[name])


def manifests(root: str) -> str:
    return f"{root.rstrip('/')}/ledger"


def states(spark: SparkSession, root: str) -> list[State]:
    """All committed states, oldest first."""
    try:
        rows = spark.read.text(f"{manifests(root)}/*").collect()
    except AnalysisException:
        return []
    return sorted((State(root=root, **json.loads(r.value)) for r in rows), key=lambda s: s.number)


def current(spark: SparkSession, root: str) -> State:
    return (states(spark, root) or [State(root)])[-1]


class Load:
    """A load in progress: the state it began with and what it has written so far."""

    def __init__(self, spark: SparkSession, before: State):
        self.spark, self.before = spark, before
        self.number = before.number + 1
        self.folder = f"{before.root.rstrip('/')}/loads/{self.number:08d}-{uuid.uuid4().hex[:12]}"
        self.paths, self.schemas = dict(before.paths), dict(before.schemas)
        self.rows, self.marks = dict(before.rows), dict(before.marks)
        self.fresh: dict[str, DataFrame] = {}
        self.report: DataFrame | None = None

    def add(self, name: str, df: DataFrame, replace: bool = False, seen: dict | None = None) -> DataFrame:
        """Write df as this load's part of a table, or as all of it, and count what is written.

        seen: further aggregates to take of the rows as they are written; their values replace them.
        """
        counted = Observation(f"{name}-{uuid.uuid4().hex}")
        totals = {f"c{i}": total.alias(f"c{i}") for i, total in enumerate((seen or {}).values())}
        path = f"{self.folder}/{name}"
        df.observe(counted, F.count("*").alias("rows"), *totals.values()).write.mode("errorifexists").parquet(path)
        found = counted.get
        for i, key in enumerate(seen or {}):
            seen[key] = found[f"c{i}"]
        earlier = [] if replace else self.before.paths.get(name, [])
        self.paths[name] = [*earlier, path]
        self.schemas[name] = df.schema.json()
        self.rows[name] = found["rows"] + (0 if replace else self.before.rows.get(name, 0))
        self.fresh[name] = self.spark.read.schema(df.schema).parquet(path)
        return self.fresh[name]

    def known(self, name: str) -> DataFrame | None:
        """The table as it was before this load."""
        return self.before.table(self.spark, name) if name in self.before.paths else None

    def whole(self, name: str) -> DataFrame:
        """The table as it will be after this load."""
        return self.after().table(self.spark, name)

    def after(self, numbered: bool | None = None) -> State:
        return State(self.before.root, self.number, numbered, self.paths, self.schemas, self.rows, self.marks)

    def commit(self, numbered: bool) -> State:
        """Write the manifest. Of two loads that began with one state the second fails here."""
        state = self.after(numbered)
        text = json.dumps({k: v for k, v in state.__dict__.items() if k != "root"})
        rows = self.spark.createDataFrame([(text,)], "value string").coalesce(1)
        rows.write.mode("errorifexists").text(f"{manifests(state.root)}/{self.number:08d}")
        return state


def together(*builders: Callable[[], object]) -> None:
    """Build independent tables at the same time."""
    in_session = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(len(builders)) as pool:
        for done in [pool.submit(in_session(build)) for build in builders]:
            done.result()


# --- what is new ------------------------------------------------------------


def with_digest(raw: DataFrame) -> DataFrame:
    """Records without job_id with the digest of all their columns; null and blank are different."""
    body = F.to_json(F.struct(*RAW_COLUMNS))
    return raw.withColumn("record", F.unhex(F.md5(body)))


def new_by_id(load: Load, records: DataFrame) -> DataFrame:
    """Records whose job_id no earlier load held."""
    rows = records.where(F.col("job_id").isNotNull() & losses.whole(losses.RAGGED_COLUMN in records.columns))
    known = load.known("core.jobs")
    if known is None:
        return rows
    held = known.select("job_id")
    delivered = rows.select("job_id")
    if fits_broadcast(delivered):
        # One scan of the key column; the known jobs are not shuffled.
        held = held.join(F.broadcast(delivered), "job_id", "left_semi")
    return load.add("staging.new_postings", without_ids(rows.select(*NEW_COLUMNS), held, "job_id"), replace=True)


def new_by_digest(load: Load, records: DataFrame, ragged: int) -> DataFrame:
    """Records that are delivered more often than they are known, numbered on in file order.

    Copies of a record are counted, not compared: those that are more than known come from one
    of them, at its place. `ragged` records are left out. Digests and places are shuffled, records are not.
    """
    rows = placed_row_ids(records, "_row")
    rows = rows.where(losses.whole(losses.RAGGED_COLUMN in records.columns))
    held = load.known("staging.known_records")
    if held is None:
        load.add("staging.known_records", rows.groupBy("record").agg(F.count("*").alias("copies")))
        # Where no row is left out, its number follows from its place alone.
        picked = rows.select("_row", F.lit(1).cast("long").alias("copies")) if ragged else None
    else:
        picked = places_of_new(load, rows.select("record", "_row"), held)
    kept = ["_row", *[c for c in NEW_COLUMNS if c != "job_id"]]
    found = rows.select(*kept)
    if picked is None:
        found = found.withColumnRenamed("_row", "job_id")
    else:
        found = picked_rows(found, picked, "_row", "job_id", after=load.marks.get("job_id", 0))
    return load.add("staging.new_postings", found.select(*NEW_COLUMNS), replace=True)


def places_of_new(load: Load, digests: DataFrame, held: DataFrame) -> DataFrame:
    """(_row, copies): where records stand that are new, and as how many they count there.

    All copies of an unknown record stand at their own place, those of one that is known at the first.
    """
    delivered = digests.select("record")
    if fits_broadcast(delivered):
        # One scan of what is known, which is not shuffled.
        held = held.join(F.broadcast(delivered), "record", "left_semi")
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    given = digests.select("record", "_row", one.alias("given"), none.alias("copies"))
    known = held.select("record", F.lit(None).cast("long").alias("_row"), none.alias("given"), "copies")
    counts = given.unionByName(known).groupBy("record").agg(F.min("_row").alias("_row"), F.sum("given").alias("given"), F.sum("copies").alias("copies"))
    apart = (F.col("copies") == 0) & (F.col("given") > 1)
    more = counts.where("given > copies").select("record", "_row", (F.col("given") - F.col("copies")).alias("more"), apart.alias("apart"))
    more = written(more, "more-records")
    load.add("staging.known_records", more.select("record", F.col("more").alias("copies")))
    at_first = more.where("not apart").select("_row", F.col("more").alias("copies"))
    at_own = lookup(digests, more.where("apart").select("record"), ["record"], "left_semi").select("_row", one.alias("copies"))
    return written(at_first.unionByName(at_own), "new-places")


# --- names ------------------------------------------------------------------


def register(load: Load, table: str, id_name: str, names: DataFrame) -> DataFrame:
    """Give ids to names the registry does not hold yet, in their order, after the highest one; the whole registry.

    names: distinct rows, whose columns may be null.
    """
    known = load.known(table)
    fresh = written(names, "names")
    if known is not None:
        same = [fresh[c].eqNullSafe(known[c]) for c in names.columns]
        fresh = fresh.join(known, same, "left_anti")
    mark = load.marks.get(table, 0)
    added = {"highest": F.max(id_name)}
    load.add(table, dense_ids(fresh, names.columns, id_name, after=mark), seen=added)
    load.marks[table] = added["highest"] or mark
    return load.whole(table)


def build_skills(load: Load, new: DataFrame, unique: bool) -> None:
    relation = load.add("staging.job_skill_all", skills.relation_of(new, unique), replace=True)
    pairs = skills.skill_pairs_by_job(new) if unique else skills.skill_pairs(relation)
    # Names and groups are those of the counts, so the relation is read once.
    counts = written(relation.groupBy("skill_name", "skill_group").agg(F.count("*").alias("jobs")), "group-counts")

    def bridge() -> None:
        names = register(load, "core.dim_skill", "skill_id", counts.select("skill_name").distinct())
        load.add("core.bridge_job_skill", skills.bridge(pairs, names))

    together(bridge, lambda: register(load, "normalized.skill_types", "skill_type_id", given_names(counts, "skill_group", "name")))
    types = load.whole("normalized.skill_types").withColumnRenamed("name", "skill_group")
    counts = lookup(lookup(counts.where("skill_group <> ''"), types, ["skill_group"]), load.whole("core.dim_skill"), ["skill_name"])
    load.add("normalized.skill_type_jobs", counts.select("skill_id", "skill_type_id", "jobs"))


def build_jobs(load: Load, new: DataFrame, unique: bool) -> None:
    jobs = new.select(*JOB_COLUMNS)
    jobs = with_empty_key(jobs if unique else written(one_per_key(written(jobs, "batch"), "job_id"), "jobs-to-key"), "company_id")
    place = jobs.select("job_location", "search_location", F.col("job_country").alias("country"))
    names = {
        "core.dim_company": ("company_id", given_names(jobs, "company_name")),
        "normalized.platforms": ("platform_id", given_names(jobs, "job_via", "name")),
        "normalized.schedule_types": ("schedule_type_id", given_names(jobs, "job_schedule_type", "name")),
        "normalized.locations": ("location_id", place.where(F.coalesce(*place.columns).isNotNull()).distinct()),
    }
    together(*[lambda t=table, of=of: register(load, t, *of) for table, of in names.items()])
    company = load.whole("core.dim_company")
    keyed = load.add("core.jobs", backfill_key(jobs, company, "company_name", "company_id"), seen=(highest := {"job_id": F.max("job_id")}))
    load.marks["job_id"] = max(highest["job_id"] or 0, load.marks.get("job_id", 0))
    dimensions = [load.whole(f"normalized.{t}") for t in ("locations", "platforms", "schedule_types")]
    # The core table's company key is that of the one registry, so it is not looked up again.
    fact = normalized.jobs_fact(keyed, None, *dimensions)
    sketched = [F.hll_sketch_agg(c, F.lit(SKETCH_BITS)).alias(name) for name, c in PROFILED.items()]
    together(
        lambda: load.add("normalized.jobs_3nf", fact),
        lambda: load.add("quality.sketches", keyed.agg(*sketched)),
    )


def build_counts(load: Load) -> None:
    """Postings of this load's jobs by skill, by title and skill, and by country and skill: one join, one table."""
    jobs = load.fresh["core.jobs"].select("job_id", "job_title_short", "job_country")
    facts = jobs.join(load.fresh["core.bridge_job_skill"], "job_id")
    title, country, skill = F.col("job_title_short"), F.col("job_country"), F.col("skill_id")
    finest = facts.groupBy(title, country, skill).agg(F.count("*").alias("postings"))
    sets = finest.groupingSets([[skill], [title, skill], [country, skill]], title, country, skill)
    # The grouping's bits, highest first: title, country, skill; a bit is set where the column is rolled up.
    counts = sets.agg(F.sum("postings").alias("postings"), F.grouping_id().alias("bits"))
    load.add("marts.partial_counts", counts.withColumn("grouping", F.shiftright("bits", 1).cast("int")).drop("bits"))


# --- loads ------------------------------------------------------------------


class WrongColumns(ValueError):
    """A delivery that is no table of postings."""


def check_columns(raw: DataFrame) -> None:
    """Every column of a posting is there, and those without job_id come with their places."""
    missing = quality.missing_columns(raw, RAW_COLUMNS)
    if "job_id" not in raw.columns:
        missing += quality.missing_columns(raw, PLACE)
    if missing:
        raise WrongColumns(f"no column {', '.join(missing)}")


class TooMuchLost(ValueError):
    """A delivery lost more than it may."""


def check_allowance(found: dict[str, int], records: int, allowed: dict[str, float]) -> None:
    beyond = []
    for name, lost in found.items():
        share = allowed.get(name, allowed.get(next((r for r in allowed if name.startswith(f"{r} ")), ""), 1.0))
        if lost > share * records:
            beyond.append(f"{name}: {lost} of {records}")
    if beyond:
        raise TooMuchLost(", ".join(beyond))


def append(raw: DataFrame, root: str, allowed: dict[str, float] | None = None) -> State:
    """Load a delivery of raw postings into the warehouse below root; the state after it.

    raw: text columns as `read_postings` gives them, with job_id or with the rows' places. Before
    anything is published the load is held against `allowed` (ALLOWED where it names nothing) and every
    declared rule; a load that breaks one raises and leaves the warehouse as it was.
    """
    check_columns(raw)
    spark = raw.sparkSession
    before = current(spark, root)
    numbered = "job_id" in raw.columns
    if before.number and before.numbered != numbered:
        raise ValueError("a warehouse takes deliveries with job_id or deliveries without, not both")
    load = Load(spark, before)
    ragged = losses.RAGGED_COLUMN in raw.columns
    found = losses.loss_counts(numbered, ragged)
    records = load.add("staging.records", losses.typed(raw if numbered else with_digest(raw)), replace=True, seen=found)
    given = load.rows["staging.records"]
    check_allowance(found, given, {**ALLOWED, **(allowed or {})})

    keys = ["job_id"] if numbered else ["record"]
    new = new_by_id(load, records) if numbered else new_by_digest(load, records, found.get("ragged record", 0))
    unique = not numbered or quality.duplicate_keys(new, ["job_id"]).isEmpty()
    together(
        lambda: build_skills(load, new, unique),
        lambda: build_jobs(load, new, unique),
        lambda: load.add("quality.losses", losses.losses(records, keys).withColumn("load", F.lit(load.number))),
    )
    rules = quality.core_constraints(
        load.fresh["core.jobs"], load.fresh["core.bridge_job_skill"], load.whole("core.dim_skill"), load.whole("core.dim_company")
    )
    together(lambda: build_counts(load), lambda: quality.enforce(rules))
    found |= {"empty delivery": int(given == 0)}
    rows = [(load.number, name, n) for name, n in found.items()]
    load.add("quality.run_report", spark.createDataFrame(rows, "load int, check string, violations long").coalesce(1))
    return load.commit(numbered)


def append_csv(spark: SparkSession, path: str, root: str, allowed: dict[str, float] | None = None) -> State:
    return append(read_postings(spark, path, ragged=losses.RAGGED_COLUMN), root, allowed)


# --- what readers see -------------------------------------------------------


def sources(state: State, *names: str) -> dict[str, str]:
    """Each table as a subquery over the files of one state, so that a view never mixes two."""

    def scan(path: str) -> str:
        quoted = path.replace("`", "``")
        return f"SELECT * FROM parquet.`{quoted}`"

    return {name.split(".")[1]: f"({' UNION ALL '.join(map(scan, state.paths[name]))})" for name in names}


def views(state: State) -> dict[str, str]:
    """SQL of every published table of a state, by layer and name."""
    of = sources(state, *[t for t in state.paths if t.split(".")[0] in ("core", "normalized", "marts", "quality", "staging")])
    staged = ", ".join(["job_id" if state.numbered else "record", *RAW_COLUMNS])
    sql = {name: f"SELECT * FROM {of[name.split('.')[1]]}" for name in state.paths if name.split(".")[0] in ("core", "normalized")}
    sql.pop("normalized.skill_type_jobs", None)
    sql["staging.data_jobs_raw"] = f"SELECT {staged} FROM {of['records']}"
    sql["normalized.companies"] = f"SELECT company_id, company_name AS name FROM {of['dim_company']}"
    sql["normalized.job_skills_3nf"] = f"SELECT job_id, skill_id FROM {of['bridge_job_skill']}"
    sql["normalized.skills"] = f"""
        SELECT skill_id, skill_name AS name, skill_type_id FROM {of['dim_skill']} LEFT JOIN (
          SELECT skill_id, min_by(skill_type_id, struct(-jobs, name)) AS skill_type_id
          FROM (SELECT skill_id, skill_type_id, sum(jobs) AS jobs FROM {of['skill_type_jobs']} GROUP BY ALL)
          JOIN {of['skill_types']} USING (skill_type_id) GROUP BY skill_id) USING (skill_id)"""
    mart = ", ".join("c.company_name" if c == "company_name" else c for c in MART_COLUMNS)
    sql["marts.job_skills"] = f"""
        SELECT {mart} FROM (SELECT * EXCEPT (company_name) FROM {of['jobs']}) JOIN {of['bridge_job_skill']} USING (job_id)
        JOIN {of['dim_skill']} USING (skill_id) LEFT JOIN {of['dim_company']} c USING (company_id)"""
    for name, by, kind in (("skill_counts", "", BY_SKILL), ("skill_counts_by_title", "job_title_short, ", BY_TITLE), ("skill_counts_by_country", "job_country, ", BY_COUNTRY)):
        sql[f"marts.{name}"] = f"""
        SELECT {by}skill_name, postings FROM (
          SELECT {by}skill_id, sum(postings) AS postings FROM {of['partial_counts']} WHERE grouping = {kind} GROUP BY ALL)
        JOIN {of['dim_skill']} USING (skill_id)"""
    return sql


def table(spark: SparkSession, state: State, name: str) -> DataFrame:
    """A published table of a state, by layer and name."""
    return spark.sql(views(state)[name])


def publish(spark: SparkSession, state: State, prefix: str = "", folder: str | None = None) -> None:
    """Views in the catalog for a state. Each is replaced by one statement and reads files of this state only."""
    create_layers(spark, prefix, folder)
    for name, sql in views(state).items():
        layer, view = name.split(".")
        spark.sql(f"CREATE OR REPLACE VIEW `{prefix}{layer}`.`{view}` AS {sql}")


def distinct_profile(spark: SparkSession, state: State) -> DataFrame:
    """Estimated number of distinct values of every profiled field: (field, estimate), from one sketch per load."""
    sketches = state.table(spark, "quality.sketches")
    merged = sketches.agg(*[F.hll_sketch_estimate(F.hll_union_agg(name)).alias(name) for name in PROFILED])
    return quality.as_rows(merged, "field", "estimate")


def layer_counts(spark: SparkSession, state: State) -> DataFrame:
    """Rows of every stored table, as counted while they were written."""
    rows = sorted(state.rows.items())
    return spark.createDataFrame(rows, "`table` string, rows long")
