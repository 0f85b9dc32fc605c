"""Headline-query benchmark.

Runs each headline query to completion through the ``noop`` sink (full
execution, nothing collected) at $BENCH_SF_DIR on local[$BENCH_CPUS]; reports
the median of three timed runs after one warm-up run, and the ETL's rows/s.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "run_etl", "daily_event_metrics", "daily_aggregate_metrics", "session_metrics", "session_kpis",
    "purchase_denormalized", "dedup_denormalized", "type_date_lookup", "product_inner_join",
    "insurance_type_last_days", "user_product_mix", "channel_product_performance",
    "event_gaps", "missing_event_gaps", "quality_check_log", "health_dashboard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [k for k in os.environ.get("BENCH_QUERIES", "").split(",") if k]
    from eventide.plans.registry import raw_queries
    from eventide.session import build_session

    spark = build_session(f"local[{cpus}]", max(2 * cpus, 8), app="eventide-bench")
    qs = raw_queries()
    times: dict[str, float] = {}
    for name in (only or HEADLINE):
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    if not only:
        from eventide.plans import serving
        from eventide.sources.tables import Tables
        t0 = time.perf_counter()
        paths = serving.materialize(Tables(spark, sf_dir))
        times["materialize_serving_tables"] = round(time.perf_counter() - t0, 3)
        tables = serving.open_tables(spark, paths)
        for name, q in serving.SERVING.items():
            samples = []
            for i in range(runs + 1):
                t0 = time.perf_counter()
                q(tables).write.format("noop").mode("overwrite").save()
                if i > 0:
                    samples.append(time.perf_counter() - t0)
            times[name] = round(statistics.median(samples), 3)
    etl_rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {
        "metric": "headline_queries_total_median_sec",
        "value": round(sum(v for k, v in times.items() if k in HEADLINE), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "serving_total_sec": round(sum(v for k, v in times.items() if k.startswith("serve_")), 3),
        "etl_input_rows_per_sec": round(etl_rows / times["run_etl"], 1) if "run_etl" in times else None,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
