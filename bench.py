"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is executed to completion through the no-op sink (full evaluation, nothing
collected). Stand-in document files are written once up front and timed as ``setup``.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rillflow.plans import bindings as B  # noqa: E402
from rillflow.plans.catalog import QUERIES  # noqa: E402
from rillflow.session import build_session  # noqa: E402

HEADLINE = [
    "anomaly_details", "anomaly_summary", "anomaly_top10", "day_stats", "current_day_select", "history_stats",
    "flatten_readings", "history_from_file", "scan_json_documents", "dedup_exact", "record_identity",
    "parse_timestamps", "parse_litres", "normalize_dates", "store_upsert", "store_insert_absent", "history_scan",
    "list_candidate_files", "phase_profile", "sink_json_roundtrip",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or (os.environ["BENCH_QUERIES"].split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE)
    extra = {"spark.driver.memory": "16g"}
    for kv in filter(None, os.environ.get("BENCH_CONF", "").split(",")):
        k, v = kv.split("=", 1)
        extra[k] = v
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="rillflow-bench",
                          extra=extra)
    t0 = time.perf_counter()
    B.write_event_documents(spark, sf_dir)
    setup = time.perf_counter() - t0
    timings = {}
    for name in names:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t, 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "setup_seconds": round(setup, 3), "sf": float(sf) if sf else sf_dir,
                      "cpus": int(cpus)}))
    spark.stop()


if __name__ == "__main__":
    main()
