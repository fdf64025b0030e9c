"""Entry point for a scheduled notification run (``spark-submit``).

    spark-submit --py-files opslog.zip opslog/plans/run_notification.py \\
        --history <parquet> --steps <parquet> --jobs <parquet> \\
        --event-messages <parquet> --ignore <parquet> --server NAME \\
        --state-root <dir> --report-root <dir>

Both folders must be durable and shared: the state carries over from run to run.
The ignore list must keep its declared layout and key: a job listed twice, or a
row without a job, fails the run.
Prints one JSON line with the written versions and the report folder.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from opslog.plans.notification import run_failure_notification
from opslog.schemas import IGNORE_JOBS, IGNORE_JOBS_KEY, JOB_FAILURES, conform
from opslog.sources.snapshots import SnapshotStore


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    ap = argparse.ArgumentParser(description="Fold job runs into the failure state and write the failure report.")
    for name in ("history", "steps", "jobs", "event-messages", "ignore"):
        ap.add_argument(f"--{name}", required=True, help="parquet path")
    ap.add_argument("--server", required=True, help="server name shown in the report heading")
    ap.add_argument("--state-root", required=True)
    ap.add_argument("--report-root", required=True)
    ap.add_argument("--refresh-duration", action="store_true")
    a = ap.parse_args(argv)
    spark = spark or SparkSession.builder.appName("opslog-notification").getOrCreate()
    store = SnapshotStore(spark, a.state_root, JOB_FAILURES)
    read = spark.read.parquet
    out = run_failure_notification(
        spark, store, history=read(a.history), steps=read(a.steps), jobs=read(a.jobs),
        event_messages=read(a.event_messages), ignore=conform(read(a.ignore), IGNORE_JOBS, IGNORE_JOBS_KEY),
        report_root=a.report_root, server=a.server,
        refresh_duration=a.refresh_duration,
    )
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
