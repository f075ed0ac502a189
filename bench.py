"""Time the headline queries: one JSON line. ``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose data and cores."""

from __future__ import annotations

import json
import os
import time

from telescale.plans.catalog import QUERIES, parse_log
from telescale.session import build_session

HEADLINE = (
    "job_end_records", "stage_features", "stage_rescaling_ratio", "job_rescaling_ratio", "stage_job_mapping",
    "stage_pairing", "last_known_timeline", "alive_executor_count", "scale_out_intervals", "scale_decisions",
    "effective_recommendation", "stage_metric_ratios", "stage_rdd_totals", "app_start_records",
    "missing_required_config", "jobs_without_stages", "latest_attempt_per_stage", "parse_log", "scan_stage_events",
    "scan_task_totals",
)
#: Beside the queries: reading and parsing all log lines, which the queries on parsed logs find done.
TIMED = {**QUERIES, "parse_log": parse_log}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app_name="bench", master=f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE

    def run(name: str) -> float:
        start = time.perf_counter()
        TIMED[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)  # warm up: class loading and, for log queries, writing the log
        seconds[name] = round(run(name), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
