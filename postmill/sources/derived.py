"""Raw postings derived from the order tables, one posting per order.

Every order gives one posting and every line item one skill, so work grows with
the tables. Order keys choose which kind of dirt a posting carries (blank and null
names, bad dates and numbers, None groups, texts that are no literal), never
whether it is there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Columns read from each table. Stated, so that no file footer is read to plan a query.
SOURCE_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_type string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int",
}


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        table: spark.read.schema(columns).parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")
        for table, columns in SOURCE_COLUMNS.items()
    }


def _every(n: int) -> Column:
    return F.col("o_orderkey") % n == 0


def skill_literals(tables: dict[str, DataFrame]) -> DataFrame:
    """(l_orderkey, js, jt): body of the list and dict literal of each order.

    Line items are grouped by order once; the names of a type are told apart inside the order's row.
    """
    padded = F.when(
        F.col("l_linenumber") % 3 == 0, F.concat(F.lit(" "), F.upper("p_name"), F.lit(" "))
    ).otherwise(F.col("p_name"))
    quoted = F.concat(F.lit("'"), padded, F.lit("'"))
    lines = (
        tables["lineitem"]
        .join(tables["part"], F.col("l_partkey") == F.col("p_partkey"))
        .select("l_orderkey", F.struct(F.col("p_type").alias("type"), quoted.alias("name")).alias("line"))
        .repartition("l_orderkey")
    )
    # Sorted by type and name, so the names of a type are in order too.
    orders = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list("line")).alias("lines"))

    def entry(kind: Column) -> Column:
        names = F.filter("lines", lambda line: line["type"] == kind)["name"]
        return F.concat(F.lit("'"), kind, F.lit("': ["), F.array_join(names, ", "), F.lit("]"))

    entries = F.transform(F.array_distinct("lines.type"), entry)
    return orders.select(
        "l_orderkey",
        F.array_join(F.sort_array("lines.name"), ", ").alias("js"),
        F.array_join(F.sort_array(entries), ", ").alias("jt"),
    )


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw postings with job_id, all other columns text."""
    t = load(spark, sf_dir)
    rows = (
        t["orders"]
        .join(t["customer"], F.col("c_custkey") == F.col("o_custkey"))
        .join(t["nation"], F.col("n_nationkey") == F.col("c_nationkey"))
        .join(t["region"], F.col("r_regionkey") == F.col("n_regionkey"))
        .join(skill_literals(t), F.col("l_orderkey") == F.col("o_orderkey"), "left")
    )
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    return rows.select(
        (key + 1).alias("job_id"),
        F.substr("o_orderpriority", F.lit(3)).alias("job_title_short"),
        F.concat(F.lit("  "), "o_orderpriority", F.lit(" "), status, F.lit(" ")).alias("job_title"),
        F.when(_every(29), "")
        .when(_every(31), None)
        .otherwise(F.concat("c_name", F.lit(" ")))
        .alias("company_name"),
        F.when(~_every(9), F.col("n_name")).alias("job_location"),
        F.concat(F.lit("via "), "c_mktsegment").alias("job_via"),
        F.when(status == "O", "Full-time").when(status == "F", "Contractor").otherwise("").alias("job_schedule_type"),
        F.when(key % 4 == 0, "True").when(key % 4 == 1, "yes").when(key % 4 == 2, "False").alias("job_work_from_home"),
        F.col("r_name").alias("search_location"),
        F.when(_every(37), "not a date").otherwise(F.col("o_orderdate").cast("string")).alias("job_posted_date"),
        F.when(key % 3 == 0, "1").when(key % 3 == 1, "0").otherwise("False").alias("job_no_degree_mention"),
        F.when(_every(2), "TRUE").otherwise("n").alias("job_health_insurance"),
        F.col("n_name").alias("job_country"),
        F.when(key % 3 == 0, "year").when(key % 3 == 1, "hour").alias("salary_rate"),
        F.when(_every(41), "n/a").when(_every(3), F.col("o_totalprice").cast("string")).alias("salary_year_avg"),
        F.when(key % 3 == 1, F.concat((F.col("o_custkey") % 90 + 10).cast("string"), F.lit(".5"))).alias(
            "salary_hour_avg"
        ),
        F.when(_every(13), None)
        .when(_every(17), "[]")
        .when(F.col("js").isNotNull(), F.concat(F.lit("["), "js", F.lit("]")))
        .alias("job_skills"),
        F.when(_every(7), None)
        .when(_every(19), "not a dict")
        .when(_every(23) | F.col("jt").isNull(), "{}")
        .when(_every(5), F.concat(F.lit("{"), "jt", F.lit(", 'OTHER': None}")))
        .otherwise(F.concat(F.lit("{"), "jt", F.lit("}")))
        .alias("job_type_skills"),
    )
