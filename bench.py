"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8). Every query
runs to completion into a sink that discards rows, after one untimed pass over small tables that loads the classes.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from tallyforge.session import build_session
from workload.queries import QUERIES

HEADLINE = [
    "bronze_ingest",
    "bronze_source_filter",
    "latest_batch",
    "run_audit",
    "silver_transform",
    "silver_rejects",
    "constraint_violations",
    "upsert_silver",
    "upsert_gold",
    "dedup_last_by_key",
    "monthly_trends",
    "cause_summary",
    "cause_summary_union",
    "prior_year_impact",
    "prior_year_window",
    "scalar_pct",
    "dq_report",
    "layered_impact_by_entity",
]


def run(name: str, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", shuffle_partitions=int(cpus) if cpus.isdigit() else 8, master=f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    small = Path(sf_dir).parent / "sf0.001"
    if small.exists():
        for name in HEADLINE[:-1]:
            run(name, spark, str(small))
    seconds = {name: run(name, spark, sf_dir) for name in HEADLINE}
    total = round(sum(seconds.values()), 3)
    scale = Path(sf_dir).name.removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": scale}))
    spark.stop()


if __name__ == "__main__":
    main()
