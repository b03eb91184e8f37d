"""Command line / spark-submit entry: one batch run, result printed as one JSON line.

    spark-submit --py-files rillflow.zip -m rillflow --directory /data/inbox --store /data/store --out /data/out
    python -m rillflow --directory /data/inbox --dry-run
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from rillflow.plans.batch import BatchOptions, run_batch
from rillflow.session import apply_confs


def parse_args(argv=None) -> BatchOptions:
    p = argparse.ArgumentParser(prog="rillflow", description="Run one meter-reading batch.")
    p.add_argument("--sources", default="", help="comma-separated JSON files (first priority)")
    p.add_argument("--directory", help="folder of *.json files")
    p.add_argument("--base", default="", help="base folder for --names")
    p.add_argument("--names", default="", help="comma-separated file names under --base")
    p.add_argument("--start-date", help="date window end (yyyy-MM-dd)")
    p.add_argument("--days-back", type=int, default=0)
    p.add_argument("--max-files", type=int, default=0)
    p.add_argument("--sample-size", type=int, default=0, help="random sample of a named list; 0: all files")
    p.add_argument("--lookback-days", type=int, default=2)
    p.add_argument("--low-ratio", type=float, default=0.8)
    p.add_argument("--high-ratio", type=float, default=1.2)
    p.add_argument("--history-file", help="history JSON file or folder (overrides the store)")
    p.add_argument("--store", help="upsert store folder (also the history source)")
    p.add_argument("--insert-store", help="insert-only store folder")
    p.add_argument("--truncated-store", help="upsert store with truncated payloads")
    p.add_argument("--out", help="output folder for records, report and run result")
    p.add_argument("--run-log", help="run-log table folder")
    p.add_argument("--run-id")
    p.add_argument("--as-of", help="'now' for cutoffs and save times (yyyy-MM-ddTHH:mm:ss)")
    p.add_argument("--dry-run", action="store_true", help="skip store writes")
    a = p.parse_args(argv)
    return BatchOptions(
        sources=a.sources, directory=a.directory, base=a.base, names=a.names, start_date=a.start_date,
        days_back=a.days_back, max_files=a.max_files, sample_size=a.sample_size, lookback_days=a.lookback_days,
        low_ratio=a.low_ratio, high_ratio=a.high_ratio, history_file=a.history_file, store_path=a.store,
        insert_store_path=a.insert_store, truncated_store_path=a.truncated_store, output_dir=a.out,
        run_log_path=a.run_log, write_stores=not a.dry_run, run_id=a.run_id,
        as_of=dt.datetime.fromisoformat(a.as_of) if a.as_of else None)


def main(argv=None) -> dict:
    opts = parse_args(argv)
    spark = apply_confs(SparkSession.builder.appName("rillflow").getOrCreate())
    res = run_batch(spark, opts)
    out = res.result or {"status": res.status, "run_id": res.run_id, "error": res.error}
    if res.report is not None:
        out = {**out, "anomalies": res.report.summary.first().asDict()}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main()
