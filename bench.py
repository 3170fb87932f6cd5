"""Benchmark: every headline query end to end from the raw tables, nothing reused.

Prints one JSON line. BENCH_SF_DIR, BENCH_CPUS and BENCH_RUNS set the input
folder, the local cores and the timed runs per query (their median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import time

from contestry.session import local_session, scope
from workload import queries

HEADLINE = (
    "silver_results",
    "expectation_report",
    "duplicate_report",
    "share_checks",
    "fact_matches",
    "match_sequence",
    "fact_rating",
    "rating_many_teams",
    "team_record",
    "season_start_end_rating",
    "continuity_check",
    "next_round_features",
    "training_frame",
    "home_win_model_metrics",
    "csv_batch_ingest",
    "stream_bronze_to_silver",
)


def run(spark, name: str, sf_dir: str) -> float:
    queries.forget()
    with scope(spark):
        start = time.perf_counter()
        queries.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds = time.perf_counter() - start
    queries.forget()
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cpus)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "fact_rating", sf_dir)  # warms up the JVM and the Python workers
    seconds = {n: round(statistics.median(run(spark, n, sf_dir) for _ in range(runs)), 3) for n in names}
    spark.stop()
    result = {
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
