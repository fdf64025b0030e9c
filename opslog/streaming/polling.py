"""Run the failure notification on every micro-batch of a trigger stream.

The source procedure is polled by a scheduler: each run compares the current
job state with the stored one. Here any streaming DataFrame can be the clock
(new history files arriving, or a ``rate`` source); each micro-batch runs the
notification run over the current tables. It reads whole tables, not only
the batch's rows, because a step missing from the source must be deleted
from the state. The stream's checkpoint gives restart after failure. A batch that
comes again after a failure is recognised where the state is a ``BucketStore``: the
batch's number is committed with the rows, and a batch that was folded in and
acknowledged neither writes nor reports again. (With a ``SnapshotStore`` it would
write further versions and repeat a report whose run had stopped half-way.)
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from opslog.plans.notification import run_failure_notification, run_failure_notification_once
from opslog.sources.buckets import BucketStore
from opslog.sources.snapshots import SnapshotStore


def start_failure_polling(spark: SparkSession, ticks: DataFrame, inputs: Callable[[], dict],
                          store: SnapshotStore | BucketStore, report_root: str, server: str, checkpoint: str,
                          interval: str = "5 minutes", available_now: bool = False) -> StreamingQuery:
    """Start the polling query. ``inputs()`` returns the keyword tables of
    ``run_failure_notification`` (history, steps, jobs, event_messages, ignore).
    ``available_now=True`` processes what has arrived and stops (catch-up runs)."""

    def _batch(_df: DataFrame, epoch: int) -> None:
        if isinstance(store, BucketStore):
            run_failure_notification_once(spark, store, epoch, report_root=report_root, server=server, **inputs())
        else:
            run_failure_notification(spark, store, report_root=report_root, server=server, **inputs())

    return (
        ticks.writeStream.foreachBatch(_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**({"availableNow": True} if available_now else {"processingTime": interval}))
        .start()
    )
