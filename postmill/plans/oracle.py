"""The same queries as plain SQL for another engine, on the same tables.

Skill relations come straight from line items and parts and parse no literal text,
so they check the parsers independently. Cleaning is restated on the raw postings.
"""

from __future__ import annotations

from postmill.fixed import JOB_COLUMNS, MART_COLUMNS, RAW_COLUMNS, TEXT_LIMITS
from postmill.operators.quality import NORMALIZED, promises
from postmill.plans.queries import COUNTRY, FIELDS, TITLE

RAW = """
li as (
  select l_orderkey, p_type,
         concat(chr(39), case when l_linenumber % 3 = 0 then concat(' ', upper(p_name), ' ') else p_name end, chr(39)) as nm
  from lineitem join part on l_partkey = p_partkey),
s as (select l_orderkey, string_agg(nm, ', ' order by nm) as js from li group by l_orderkey),
g as (select l_orderkey, p_type, string_agg(nm, ', ' order by nm) as gl from li group by l_orderkey, p_type),
ge as (select l_orderkey, concat(chr(39), p_type, chr(39), ': [', gl, ']') as e from g),
t as (select l_orderkey, string_agg(e, ', ' order by e) as jt from ge group by l_orderkey),
raw as (
  select o_orderkey + 1 as job_id,
    substr(o_orderpriority, 3) as job_title_short,
    concat('  ', o_orderpriority, ' ', o_orderstatus, ' ') as job_title,
    case when o_orderkey % 29 = 0 then '' when o_orderkey % 31 = 0 then null else concat(c_name, ' ') end as company_name,
    case when o_orderkey % 9 = 0 then null else n_name end as job_location,
    concat('via ', c_mktsegment) as job_via,
    case o_orderstatus when 'O' then 'Full-time' when 'F' then 'Contractor' else '' end as job_schedule_type,
    case o_orderkey % 4 when 0 then 'True' when 1 then 'yes' when 2 then 'False' else null end as job_work_from_home,
    r_name as search_location,
    case when o_orderkey % 37 = 0 then 'not a date' else cast(o_orderdate as varchar) end as job_posted_date,
    case o_orderkey % 3 when 0 then '1' when 1 then '0' else 'False' end as job_no_degree_mention,
    case when o_orderkey % 2 = 0 then 'TRUE' else 'n' end as job_health_insurance,
    n_name as job_country,
    case o_orderkey % 3 when 0 then 'year' when 1 then 'hour' else null end as salary_rate,
    case when o_orderkey % 41 = 0 then 'n/a' when o_orderkey % 3 = 0 then cast(o_totalprice as varchar) else null end as salary_year_avg,
    case when o_orderkey % 3 = 1 then concat(cast(o_custkey % 90 + 10 as varchar), '.5') else null end as salary_hour_avg,
    case when o_orderkey % 13 = 0 then null when o_orderkey % 17 = 0 then '[]'
         when js is null then null else concat('[', js, ']') end as job_skills,
    case when o_orderkey % 7 = 0 then null when o_orderkey % 19 = 0 then 'not a dict'
         when o_orderkey % 23 = 0 or jt is null then '{}'
         when o_orderkey % 5 = 0 then concat('{', jt, ', ', chr(39), 'OTHER', chr(39), ': None}')
         else concat('{', jt, '}') end as job_type_skills
  from orders
  join customer on c_custkey = o_custkey
  join nation on n_nationkey = c_nationkey
  join region on r_regionkey = n_regionkey
  left join s on s.l_orderkey = o_orderkey
  left join t on t.l_orderkey = o_orderkey)"""

STRIPPED = ", ".join(f"trim({c}) as {c}" for c in RAW_COLUMNS)
NULLED = ", ".join(f"nullif(trim({c}), '') as {c}" for c in RAW_COLUMNS)


def _token(column: str) -> str:
    return f"lower(nullif(trim({column}), '')) in ('true', '1', 'yes', 'y') as {column}"


BOOLS = ", ".join(_token(c) for c in ("job_work_from_home", "job_no_degree_mention", "job_health_insurance"))
POSTED = "try_strptime(job_posted_date, '%Y-%m-%d %H:%M:%S') as job_posted_date"
SALARY_NULL = ", ".join(f"try_cast({c} as double) as {c}" for c in ("salary_year_avg", "salary_hour_avg"))
SALARY_ZERO = ", ".join(
    f"coalesce(try_cast({c} as double), 0.0) as {c}" for c in ("salary_year_avg", "salary_hour_avg")
)
TEXTS = ", ".join(
    f"nullif(trim({c}), '') as {c}"
    for c in (
        "job_title_short",
        "job_title",
        "company_name",
        "job_location",
        "job_via",
        "job_schedule_type",
        "search_location",
        "job_country",
        "salary_rate",
    )
)

# Cleaned scalar columns: the flat jobs table without skills.
FLAT = f"{RAW},\nflat as (select job_id, {TEXTS}, {BOOLS}, {POSTED}, {SALARY_ZERO} from raw)"

# Job-to-skill relations from the base tables.
LISTED = """
listed as (
  select distinct o_orderkey + 1 as job_id, lower(p_name) as skill_name
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  where o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0)"""
TYPED = """
typed as (
  select distinct o_orderkey + 1 as job_id, lower(p_type) as skill_group, lower(p_name) as skill_name
  from orders join lineitem on l_orderkey = o_orderkey join part on p_partkey = l_partkey
  where o_orderkey % 7 <> 0 and o_orderkey % 19 <> 0 and o_orderkey % 23 <> 0)"""
RELATION = f"""{LISTED},{TYPED},
relation as (
  select job_id, cast(null as varchar) as skill_group, skill_name from listed
  union select job_id, skill_group, skill_name from typed)"""
SKILLS = f"""{RELATION},
dim_skill as (
  select row_number() over (order by skill_name) as skill_id, skill_name
  from (select distinct skill_name from relation)),
bridge as (select distinct job_id, skill_id from relation join dim_skill using (skill_name))"""

COMPANIES = """
dim_company as (
  select row_number() over (order by company_name) as company_id, company_name
  from (select distinct company_name from flat where company_name is not null and company_name <> ''))"""
JOBS = f"""{FLAT},{COMPANIES},
jobs as (select flat.*, company_id from flat left join dim_company using (company_name))"""
CORE = f"{JOBS},{SKILLS}"
JOB_LIST = ", ".join(JOB_COLUMNS)
FLAT_CORE = f"{FLAT},{SKILLS}"
MART = f"""{CORE},
mart as (
  select jobs.*, skill_name from jobs join bridge using (job_id) join dim_skill using (skill_id))"""

DIRTY = f"""{CORE},
nameless as (select job_id from flat where company_name is null),
dirty as (
  select job_id, skill_id from bridge
  union all select -job_id, null from nameless
  union all select bridge.job_id, skill_id from bridge join nameless using (job_id))"""

CONTRACT = "job_schedule_type = 'Contractor'"

CONTRACT_COMPANIES = f"""
held as (
  select row_number() over (order by company_name) as company_id, company_name
  from (select distinct company_name from flat where company_name is not null and {CONTRACT}))"""


def _names(column: str, id_name: str, table: str) -> str:
    return f"""
{table} as (
  select row_number() over (order by name) as {id_name}, name
  from (select distinct {column} as name from flat where {column} is not null))"""


PLACES = """
locations as (
  select row_number() over (
           order by job_location nulls first, search_location nulls first, country nulls first) as location_id, *
  from (select distinct job_location, search_location, job_country as country from flat
        where coalesce(job_location, search_location, job_country) is not null))"""
NORMAL = ",".join(
    [
        FLAT,
        _names("company_name", "company_id", "companies"),
        PLACES,
        _names("job_via", "platform_id", "platforms"),
        _names("job_schedule_type", "schedule_type_id", "schedule_types"),
    ]
)
GROUPS = f"""{RELATION},
skill_types as (
  select row_number() over (order by name) as skill_type_id, name
  from (select distinct skill_group as name from typed)),
group_jobs as (select skill_name, skill_group, count(*) as n from typed group by all),
main_group as (
  select skill_name, skill_group from group_jobs
  qualify row_number() over (partition by skill_name order by n desc, skill_group) = 1),
skills as (
  select row_number() over (order by skill_name) as skill_id, skill_name as name, skill_type_id
  from (select distinct skill_name from relation)
  left join main_group using (skill_name)
  left join skill_types on skill_types.name = skill_group)"""


# What two loads leave: the contract jobs under their older title, then all others.
TWO_RUNS = f"""{FLAT},{RELATION.removeprefix(chr(10))},
old as (select job_id from flat where {CONTRACT}),
all_jobs as (
  select * replace (case when {CONTRACT} then concat(job_title, ' old') else job_title end as job_title) from flat),
held as (
  select row_number() over (order by company_name) as company_id, company_name
  from (select distinct company_name from flat where company_name is not null and {CONTRACT})),
companies as (
  select company_id, company_name from held
  union all
  select (select count(*) from held) + row_number() over (order by company_name), company_name
  from (select distinct company_name from flat where company_name is not null except select company_name from held)),
old_skills as (
  select row_number() over (order by skill_name) as skill_id, skill_name
  from (select distinct skill_name from relation where job_id in (from old))),
two_skills as (
  select * from old_skills
  union all
  select (select count(*) from old_skills) + row_number() over (order by skill_name), skill_name
  from (select distinct skill_name from relation except select skill_name from old_skills)),
two_bridge as (select distinct job_id, skill_id from relation join two_skills using (skill_name)),
two_mart as (
  select all_jobs.*, skill_name from all_jobs join two_bridge using (job_id) join two_skills using (skill_id))"""


def _lost(rows: dict[str, str]) -> str:
    given = {c: "false" for c in TEXT_LIMITS} | {"skill_name": "false", "skill_group": "false"}
    every = {f"too long {c}": rule for c, rule in given.items()} | {"unparsable salary_hour_avg": "false", "too large salary_hour_avg": "false"}
    return " union all ".join(
        f"select '{name}' as \"check\", cast(count(*) filter ({rule}) as bigint) as violations from raw" for name, rule in {**every, **rows}.items()
    )


def _checks(rows: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{name}' as \"check\", cast(({count}) as bigint) as violations" for name, count in rows.items()
    )


def _dup(table: str, keys: str, condition: str = "true") -> str:
    return f"select count(*) from (select {keys} from {table} where {condition} group by {keys} having count(*) > 1)"


def _orphans(child: str, key: str, parent: str, skip_null: bool = False) -> str:
    rule = f"c.{key} is not null and p.{key} is null" if skip_null else f"p.{key} is null"
    return (
        f"select count(*) from {child} c left join (select distinct {key} from {parent}) p on p.{key} = c.{key} where {rule}"
    )


def _counts(by: str) -> str:
    return f"select {by}, count(*) as postings from mart group by {by}"


def _top(by: str, value: str) -> str:
    return (
        f"with {MART} select {by}, skill_name, count(*) as postings from mart where {by} = '{value}' "
        f"group by all order by postings desc, skill_name limit 20"
    )


LENGTHS = {c: f"select count(*) from flat where length({c}) > 8" for c in TEXT_LIMITS} | {
    c: f"select count(*) from flat where {c} is not null and try_cast({c} as {kind}) is null"
    for c, kind in {"salary_year_avg": "decimal(12,2)", "salary_hour_avg": "decimal(8,2)"}.items()
}

CLEAN_COLUMNS = ["job_id", *RAW_COLUMNS]
STAGED = f"""{FLAT},
items as (
  select o_orderkey + 1 as job_id, to_json(list(lower(p_name) order by nm)) as names, count(*) as n
  from orders join (
    select l_orderkey, p_name,
           case when l_linenumber % 3 = 0 then concat(' ', upper(p_name), ' ') else p_name end as nm
    from lineitem join part on l_partkey = p_partkey) on l_orderkey = o_orderkey
  where o_orderkey % 13 <> 0 and o_orderkey % 17 <> 0
  group by o_orderkey),
staged as (
  select flat.*, cast(coalesce(names, '[]') as varchar) as job_skills,
         cast(coalesce(n, 0) as integer) as skills, nullif(trim(raw.job_type_skills), '') as job_type_skills
  from flat join raw using (job_id) left join items using (job_id))"""

SUMMARY_TYPES = {
    "job_id": "bigint",
    "job_posted_date": "timestamp",
    "job_work_from_home": "boolean",
    "job_no_degree_mention": "boolean",
    "job_health_insurance": "boolean",
    "salary_year_avg": "double",
    "salary_hour_avg": "double",
    "job_skills": "array<string>",
}

WRITTEN = {
    "staging.data_jobs_raw": "raw",
    "staging.job_skill_all": "relation",
    "staging.jobs_to_key": "flat",
    "core.dim_skill": "dim_skill",
    "core.bridge_job_skill": "bridge",
    "core.dim_company": "dim_company",
    "core.jobs": "jobs",
    "normalized.companies": "dim_company",
    "normalized.locations": "locations",
    "normalized.platforms": "(select distinct job_via from flat where job_via is not null)",
    "normalized.schedule_types": "(select distinct job_schedule_type from flat where job_schedule_type is not null)",
    "normalized.skill_types": "(select distinct skill_group from typed)",
    "normalized.skills": "dim_skill",
    "normalized.jobs_3nf": "flat",
    "normalized.job_skills_3nf": "bridge",
    "marts.skill_counts": "(select distinct skill_name from mart)",
    "marts.skill_counts_by_title": "(select distinct job_title_short, skill_name from mart)",
    "marts.skill_counts_by_country": "(select distinct job_country, skill_name from mart)",
}

CONTRACT_CHECKS = {
    "missing_columns": "0",
    "missing_input_columns": "0",
    "wrong_types": "0",
    "null_job_id": "select count(*) from flat where job_id is null",
    "empty_load": "select case when count(*) = 0 then 1 else 0 end from flat",
    "blank_skill_name": "select count(*) from listed where skill_name is null or skill_name = ''",
    "skill_name_type": "0",
    "duplicate_job_skill": _dup("listed", "job_id, skill_name"),
    "jobs_pk_null": "select count(*) from jobs where job_id is null",
    "jobs_pk_duplicate": _dup("jobs", "job_id"),
    "dim_skill_pk_null": "select count(*) from dim_skill where skill_id is null",
    "dim_skill_pk_duplicate": _dup("dim_skill", "skill_id"),
    "dim_skill_name_duplicate": _dup("dim_skill", "skill_name"),
    "bridge_job_skill_pk_null": "select count(*) from bridge where job_id is null or skill_id is null",
    "bridge_job_skill_pk_duplicate": _dup("bridge", "job_id, skill_id"),
    "dim_company_pk_null": "select count(*) from dim_company where company_id is null",
    "dim_company_pk_duplicate": _dup("dim_company", "company_id"),
    "dim_company_name_duplicate": _dup("dim_company", "company_name"),
    "orphan_job_ids": _orphans("bridge", "job_id", "jobs"),
    "orphan_skill_ids": _orphans("bridge", "skill_id", "dim_skill"),
    "orphan_company_ids": _orphans("jobs", "company_id", "dim_company", skip_null=True),
    "missing_company_id": "select count(*) from jobs where company_name <> '' and company_id is null",
}


def oracle_sql() -> dict[str, str]:
    distinct = ", ".join(f"count(distinct {c}) as {name}" for name, c in FIELDS.items())
    nulls = " union all ".join(
        f"select '{c}' as \"column\", count(*) filter (where {c} is null) as nulls from staged" for c in CLEAN_COLUMNS
    )
    summary = " union all ".join(
        f"select '{c}' as \"column\", '{SUMMARY_TYPES.get(c, 'string')}' as type, count(*) as rows, "
        f"count(*) filter (where {c} is null) as nulls from staged"
        for c in CLEAN_COLUMNS
    )
    mart = ", ".join("dim_company.company_name" if c == "company_name" else c for c in MART_COLUMNS)
    batch_columns = [c for c in JOB_COLUMNS if c not in ("job_id", *("salary_year_avg", "salary_hour_avg"))]
    return {
        "raw_postings": f"with {RAW} select * from raw",
        "strip_strings": f"with {RAW} select job_id, {STRIPPED} from raw",
        "blank_to_null": f"with {RAW} select job_id, {NULLED} from raw",
        "bool_tokens": f"with {RAW} select job_id, {BOOLS} from raw",
        "parse_timestamp": f"with {RAW} select job_id, {POSTED} from raw",
        "numeric_lenient_zero": f"with {RAW} select job_id, {SALARY_ZERO} from raw",
        "numeric_lenient": f"with {RAW} select job_id, {SALARY_NULL} from raw",
        "clean_postings": f"with {STAGED} select {', '.join(CLEAN_COLUMNS)} from staged",
        "skills_as_json": f"with {STAGED} select job_id, skills, job_skills from staged",
        "row_ids": f"with {RAW} select row_number() over (order by job_posted_date, job_id) as row_id, "
        "job_posted_date, job_id, job_title from raw",
        "skills_from_list": f"with {LISTED} select * from listed",
        "skills_from_dict": f"with {TYPED} select * from typed",
        "job_skill_union": f"with {RELATION} select * from relation",
        "job_skill_union_unique_ids": f"with {RELATION} select * from relation",
        "dim_skill": f"with {SKILLS} select * from dim_skill",
        "bridge_job_skill": f"with {SKILLS} select * from bridge",
        "bridge_unique_ids": f"with {SKILLS} select * from bridge",
        "dim_company": f"with {FLAT},{COMPANIES} select * from dim_company",
        "company_names": f"with {FLAT},{COMPANIES} select company_name from dim_company",
        "core_jobs": f"with {JOBS} select {JOB_LIST}, company_id from jobs",
        "insert_if_absent_jobs": f"""with {FLAT}
            select {JOB_LIST} from (
              select * replace (concat(job_title, ' old') as job_title) from flat where {CONTRACT}
              union all by name select * from flat where job_schedule_type is null or not {CONTRACT})""",
        "insert_if_absent_companies": f"""with {FLAT},{CONTRACT_COMPANIES}
            select company_id, company_name from held
            union all
            select (select max(company_id) from held) + row_number() over (order by company_name), company_name
            from (select distinct company_name from flat where company_name is not null
                  except select company_name from held)""",
        "cascade_delete": f"""with {FLAT_CORE}
            select job_id, skill_id from bridge
            where job_id not in (select job_id from flat where company_name is null)""",
        "cascade_delete_skills": f"""with {SKILLS},
            group_jobs as (select skill_name, skill_group, count(*) as n from typed group by all)
            select job_id, skill_id from bridge join dim_skill using (skill_id)
            where skill_name not in (
              select skill_name from group_jobs
              qualify row_number() over (partition by skill_name order by n desc, skill_group) = 1
                  and skill_group = 'economy')""",
        "mart_job_skills": f"with {MART} select {mart} from mart left join dim_company using (company_id)",
        "skill_postings_direct": f"""with {SKILLS}
            select skill_name, count(*) as postings from bridge join dim_skill using (skill_id)
            group by skill_name order by postings desc, skill_name""",
        "skill_counts": f"with {MART} {_counts('skill_name')} order by postings desc, skill_name",
        "skill_counts_by_title": f"with {MART} {_counts('job_title_short, skill_name')}",
        "skill_counts_by_country": f"with {MART} {_counts('job_country, skill_name')}",
        "top20_skills": f"with {MART} {_counts('skill_name')} order by postings desc, skill_name limit 20",
        "top20_skills_title": _top("job_title_short", TITLE),
        "top20_skills_country": _top("job_country", COUNTRY),
        "preview_jobs": f"with {FLAT} select {JOB_LIST} from flat order by job_id limit 10",
        "layer_counts": f"""with {CORE}
            select (select count(*) from raw) as raw_rows, (select count(*) from jobs) as jobs_rows,
                   (select count(*) from dim_skill) as skills_rows, (select count(*) from bridge) as bridge_rows,
                   (select count(*) from dim_company) as companies_rows""",
        "distinct_profile": f"with {FLAT} select {distinct} from flat",
        "null_profile": f"with {STAGED} {nulls}",
        "dup_rows": f"""with {FLAT}
            select cast(coalesce(sum(n), 0) as bigint) as duplicate_rows
            from (select count(*) as n from flat group by {', '.join(batch_columns)} having count(*) > 1)""",
        "skill_profile": f"""with {RELATION}
            select count(*) as rows, count(distinct job_id) as jobs_with_skills,
                   count(distinct skill_name) as unique_skills from relation""",
        "table_summary": f"with {STAGED} {summary}",
        "dq_orphans": f"with {DIRTY}, contract as (select distinct company_id from jobs where {CONTRACT}) "
        + _checks(
            {
                "orphan_job_ids": _orphans("dirty", "job_id", "jobs"),
                "orphan_skill_ids": _orphans("dirty", "skill_id", "dim_skill"),
                "orphan_company_ids": _orphans("jobs", "company_id", "contract", skip_null=True),
            }
        ),
        "dq_duplicate_pairs": f"""with {DIRTY}
            select job_id, skill_id, count(*) as rows from dirty group by job_id, skill_id having count(*) > 1""",
        "dq_duplicates": f"with {DIRTY} "
        + _checks(
            {
                "dup_pairs": _dup("dirty", "job_id, skill_id"),
                "dup_job_ids": _dup("dirty", "job_id"),
                "dup_skill_ids": _dup("dirty", "skill_id"),
                "dup_skill_names": _dup("relation", "skill_name"),
                "dup_company_names": _dup("jobs", "company_name"),
                "dup_company_ids": _dup("jobs", "company_id"),
            }
        ),
        "dq_nulls": f"""with {DIRTY}
            select cast(sum(cast(job_id is null as integer)) as bigint) as null_job_id,
                   cast(sum(cast(skill_id is null as integer)) as bigint) as null_skill_id from dirty""",
        "dq_missing_fk": f"with {FLAT},{CONTRACT_COMPANIES} "
        + _checks(
            {
                "missing_company_id": "select count(*) from flat left join held using (company_name) "
                "where company_name <> '' and company_id is null"
            }
        ),
        "dq_parse_errors": f"with {RAW} "
        + _checks(
            {
                "job_skills": "0",
                "job_type_skills": "select count(*) from raw where job_type_skills = 'not a dict'",
                "job_posted_date": "select count(*) from raw where job_posted_date = 'not a date'",
                "salary_year_avg": "select count(*) from raw where salary_year_avg = 'n/a'",
                "salary_hour_avg": "0",
            }
        ),
        "dq_lengths": f"with {FLAT} {_checks(LENGTHS)}",
        "dq_skill_lengths": f"with {RELATION} "
        + _checks(
            {
                "skill_name": "select count(*) from relation where length(skill_name) > 8",
                "skill_group": "select count(*) from relation where length(skill_group) > 6",
            }
        ),
        "dq_contract": f"with {CORE} {_checks(CONTRACT_CHECKS)}",
        "companies": f"with {NORMAL} select * from companies",
        "locations": f"with {NORMAL} select * from locations",
        "platforms": f"with {NORMAL} select * from platforms",
        "schedule_types": f"with {NORMAL} select * from schedule_types",
        "skill_types": f"with {GROUPS} select * from skill_types",
        "skills_typed": f"with {GROUPS} select * from skills",
        "jobs_3nf": f"""with {NORMAL}
            select job_id, job_title, job_title_short, company_id, location_id, platform_id, schedule_type_id,
                   job_work_from_home as work_from_home, job_posted_date as posted_date,
                   job_no_degree_mention as no_degree_mention, job_health_insurance as health_insurance, salary_rate,
                   try_cast(nullif(salary_year_avg, 0.0) as decimal(12, 2)) as salary_year_avg,
                   try_cast(nullif(salary_hour_avg, 0.0) as decimal(8, 2)) as salary_hour_avg
            from flat
            left join companies on companies.name = company_name
            left join platforms on platforms.name = job_via
            left join schedule_types on schedule_types.name = job_schedule_type
            left join locations l on l.job_location is not distinct from flat.job_location
                                 and l.search_location is not distinct from flat.search_location
                                 and l.country is not distinct from flat.job_country""",
        "job_skills_3nf": f"""with {GROUPS}
            select distinct job_id, skill_id from relation join skills on skills.name = skill_name""",
        "csv_roundtrip": f"""with {RAW}
            select row_number() over (order by job_id) as job_id, {', '.join(RAW_COLUMNS)} from raw""",
        "dq_contract_broken": f"""with {FLAT},{LISTED},
            again as (select listed.* from listed join flat using (job_id) where company_name is null),
            every as (select * from listed union all select * from again union all select job_id, '' from again),
            pairs as (select job_id, skill_name, count(*) as n from every group by all)
            select unnest(['missing_columns', 'missing_input_columns', 'wrong_types', 'empty_load', 'skill_name_type']) as "check",
                   cast(unnest([2, 1, 2, 0, 0]) as bigint) as violations
            union all select 'null_job_id', count(*) from raw where job_id % 11 = 0
            union all select 'blank_skill_name', count(*) from again
            union all select 'duplicate_job_skill', count(*) from pairs where n > 1""",
        "dq_normalized": f"""with {NORMAL},{GROUPS},
            pairs as (select distinct job_id, skill_id from relation join skills on skills.name = skill_name),
            zero as (select unnest([{", ".join(f"'{name}'" for t, d in NORMALIZED.items() for name in promises(t, d))}]) as "check"),
            broken as (
              select 'companies_company_id_null' as "check", count(*) as n from companies where company_id % 50 = 0
              union all select 'companies_name_duplicate', count(*) from companies where company_id % 50 = 0
              union all select unnest(['platforms_pk_duplicate', 'platforms_name_duplicate']), count(*) from platforms where platform_id % 2 = 0
              union all select 'schedule_types_name_null', count(*) from schedule_types where schedule_type_id % 2 = 0
              union all select 'skills_skill_type_id_orphan', count(*) from skills where skill_id % 10 <> 0 and skill_type_id = 1
              union all select 'jobs_3nf_pk_duplicate', count(*) from flat where job_id % 47 = 0
              union all select 'jobs_3nf_company_id_orphan', sum(case when job_id % 47 = 0 then 2 else 1 end)
                        from flat where job_id % 43 = 0 and company_name is not null
              union all select 'job_skills_3nf_pk_duplicate', count(*) from pairs where job_id % 53 = 0
              union all select 'job_skills_3nf_skill_id_orphan', sum(case when job_id % 53 = 0 then 2 else 1 end) from pairs where skill_id % 10 = 0)
            select "check", cast(coalesce(n, 0) as bigint) as violations from zero left join broken using ("check")""",
        "csv_shuffled_columns": f"""with {RAW}
            select cast(job_id as varchar) as job_id, {', '.join(RAW_COLUMNS)} from raw""",
        "csv_ragged": f"""with {RAW}
            select concat('whole ', job_id) as record, false as ragged from raw
            union all
            select concat(job_id, ',', job_country, case when job_id % 2 = 0 then '' else '{"," * len(RAW_COLUMNS)}more' end), true from raw""",
        "second_run_jobs": f"""with {TWO_RUNS}
            select {JOB_LIST}, company_id from all_jobs left join companies using (company_name)""",
        "second_run_bridge": f"with {TWO_RUNS} select job_id, skill_id from two_bridge",
        "second_run_skill_counts": f"""with {TWO_RUNS}
            select 'skill_counts' as mart, null as value, skill_name, count(*) as postings from two_mart group by all
            union all
            select 'skill_counts_by_title', job_title_short, skill_name, count(*) from two_mart group by all
            union all
            select 'skill_counts_by_country', job_country, skill_name, count(*) from two_mart group by all""",
        "second_run_companies_3nf": f"with {TWO_RUNS} select company_id, company_name as name from companies",
        "second_run_skills_3nf": f"""with {TWO_RUNS},
            group_jobs as (select skill_name, skill_group, count(*) as n from typed group by all),
            main_group as (
              select skill_name, skill_group from group_jobs
              qualify row_number() over (partition by skill_name order by n desc, skill_group) = 1)
            select skill_id, skill_name as name, skill_group as skill_type from two_skills left join main_group using (skill_name)""",
        "second_run_layer_counts": f"""with {TWO_RUNS}
            select 'staging.records' as "table", count(*) as rows from flat
            union all select 'core.jobs', count(*) from all_jobs
            union all select 'core.dim_company', count(*) from companies
            union all select 'core.dim_skill', count(*) from two_skills
            union all select 'core.bridge_job_skill', count(*) from two_bridge""",
        "second_run_unnumbered": f"""with {FLAT}
            select row_number() over (order by coalesce({CONTRACT}, false) desc, job_id) as job_id, {', '.join(RAW_COLUMNS[:15])} from flat""",
        "run_report": f"""with {RAW}
            {_lost({
                "missing job_id": "job_id % 47 = 0",
                "unparsable job_id": "job_id % 53 = 0 and job_id % 47 <> 0",
                "unparsable job_skills": "job_id % 43 = 0",
                "unparsable job_type_skills": "(job_id - 1) % 19 = 0 and (job_id - 1) % 7 <> 0",
                "unparsable job_posted_date": "(job_id - 1) % 37 = 0",
                "unparsable salary_year_avg": "(job_id - 1) % 41 = 0 and job_id % 61 <> 0",
                "too large salary_year_avg": "job_id % 61 = 0",
                "too long job_title": "job_id % 59 = 0",
                "too long job_country": "job_id % 67 = 0",
                "empty delivery": "false",
            })}""",
        "published_mart": f"""with {TWO_RUNS}
            select {', '.join(MART_COLUMNS)} from two_mart""",
        "distinct_estimates": "select unnest([" + ", ".join(f"'{f}'" for f in FIELDS) + "]) as field, true as within_error",
        "written_tables": f"with {CORE},{PLACES}, mart as (select * from jobs join bridge using (job_id) "
        "join dim_skill using (skill_id)) "
        + " union all ".join(
            f"select '{name}' as \"table\", count(*) as rows from {source}" for name, source in WRITTEN.items()
        ),
    }
