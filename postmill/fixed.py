"""Names, tokens, formats and limits that results depend on."""

# --- fixed values -----------------------------------------------------------

# Columns of a raw posting file, in file order. job_id may precede them.
RAW_COLUMNS = [
    "job_title_short",
    "job_title",
    "company_name",
    "job_location",
    "job_via",
    "job_schedule_type",
    "job_work_from_home",
    "search_location",
    "job_posted_date",
    "job_no_degree_mention",
    "job_health_insurance",
    "job_country",
    "salary_rate",
    "salary_year_avg",
    "salary_hour_avg",
    "job_skills",
    "job_type_skills",
]

BOOLEAN_COLUMNS = ["job_work_from_home", "job_no_degree_mention", "job_health_insurance"]
SALARY_COLUMNS = ["salary_year_avg", "salary_hour_avg"]

# Columns of the core jobs table, before company_id is added.
JOB_COLUMNS = ["job_id"] + RAW_COLUMNS[:15]

# Columns of the job_skills mart.
MART_COLUMNS = [
    "job_id",
    "job_title_short",
    "job_title",
    "job_country",
    "search_location",
    "job_location",
    "job_schedule_type",
    "job_work_from_home",
    "job_posted_date",
    "salary_rate",
    "salary_year_avg",
    "salary_hour_avg",
    "company_name",
    "skill_name",
]

# Types a cleaned posting must have.
CLEAN_TYPES = {
    "job_posted_date": "timestamp",
    "job_work_from_home": "boolean",
    "job_no_degree_mention": "boolean",
    "job_health_insurance": "boolean",
    "job_country": "string",
    "salary_rate": "string",
    "salary_year_avg": "double",
    "salary_hour_avg": "double",
}

# Columns an input must carry before a load is attempted.
REQUIRED_INPUT = ["job_title", "company_name", "job_location"]

# Texts that mean true, in lower case; any other text means false.
TRUE_TOKENS = ["true", "1", "yes", "y"]

# Texts that mean "no skills here".
EMPTY_TOKENS = ["", "null", "None", "[]", "{}"]

# Posting time, read as UTC wall clock: YYYY-MM-DD HH:MM:SS.
POSTED_FORMAT = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\z"

# Declared maximum lengths of the normalized text columns.
TEXT_LIMITS = {
    "job_title": 500,
    "job_title_short": 255,
    "company_name": 255,
    "job_location": 255,
    "search_location": 255,
    "job_country": 100,
    "job_via": 100,
    "job_schedule_type": 50,
    "salary_rate": 50,
}
SKILL_LIMITS = {"skill_name": 100, "skill_group": 100}

# Declared decimal types of the normalized salaries.
SALARY_DECIMALS = {"salary_year_avg": "decimal(12,2)", "salary_hour_avg": "decimal(8,2)"}

# Code points with the Unicode White_Space property.
WHITESPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Layers of the warehouse.
LAYERS = ["staging", "core", "normalized", "marts"]

# ----------------------------------------------------------------------------
