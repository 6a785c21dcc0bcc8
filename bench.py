"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. Every query starts
from the given tables and is drained without collecting rows. Where the folder has a
sibling sf0.001, each query first runs there once, untimed, so that what is timed is
the work and not the loading of classes.
"""

from __future__ import annotations

import json
import os
import time

from postmill.plans.queries import queries
from postmill.session import build_session

HEADLINE = [
    "skill_postings_direct",
    "clean_postings",
    "job_skill_union",
    "bridge_job_skill",
    "core_jobs",
    "mart_job_skills",
    "skill_counts",
    "skill_counts_by_title",
    "skill_counts_by_country",
    "dq_contract",
    "dq_parse_errors",
    "jobs_3nf",
    "csv_roundtrip",
    "written_tables",
]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "bench",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(cpus)),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    small = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        for name in HEADLINE:
            drain(known[name](spark, small))
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        drain(known[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
