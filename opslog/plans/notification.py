"""The failure notification run as a sequence of Spark jobs.

    last_job_run -> merge_state -> suppress_ignored -> enrich_failures   (one plan)
      -> write state version n+1                                        (action 1)
      -> new_failures on the written version; if any -> write report    (action 2, 3)
      -> acknowledge -> write state version n+2                         (action 4)

Each stored version cuts the lineage, so a lost executor only recomputes from
the last written version. The order is at-least-once, like the source
procedure: if the run stops after the report but before the acknowledged
version is written, the next run reports the same failures again.

``run_failure_notification_once`` does the same over a copy-on-write ``BucketStore``:
a run writes the buckets of changed steps only, and the number of the batch it
stands for is committed with the rows, so that a batch that comes again folds
nothing twice and reports nothing twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.operators.jobs import last_job_run, last_package_error
from opslog.operators.notify import failure_report, write_report
from opslog.operators.state import acknowledge, enrich_failures, failure_rows, merge_state, suppress_ignored
from opslog.sources.buckets import BucketStore
from opslog.sources.snapshots import SnapshotStore


def fold_new_runs(state: DataFrame, *, history: DataFrame, steps: DataFrame, jobs: DataFrame,
                  event_messages: DataFrame, ignore: DataFrame, refresh_duration: bool = False) -> DataFrame:
    """State after merge, ignore-list suppression and error enrichment (lazy)."""
    merged = merge_state(state, last_job_run(history, steps, jobs), refresh_duration)
    suppressed = suppress_ignored(merged, ignore)
    return enrich_failures(suppressed, last_package_error(steps, event_messages))


def run_failure_notification(spark: SparkSession, store: SnapshotStore, *, history: DataFrame, steps: DataFrame,
                         jobs: DataFrame, event_messages: DataFrame, ignore: DataFrame, report_root: str,
                         server: str, refresh_duration: bool = False) -> dict:
    """Run once; returns the written versions and the report folder (None when
    there was nothing to report)."""
    folded = fold_new_runs(store.read(), history=history, steps=steps, jobs=jobs,
                           event_messages=event_messages, ignore=ignore, refresh_duration=refresh_duration)
    state_version = store.write(folded)
    written = store.read(state_version)
    report_path = None
    if not failure_rows(written).isEmpty():
        report_path = f"{report_root.rstrip('/')}/v{state_version:08d}"
        write_report(failure_report(written, server), report_path)
    final_version = store.write(acknowledge(written))
    return {"state_version": state_version, "final_version": final_version, "report_path": report_path}


# Notes in the state's manifests: the batch last folded in, and the batch last reported and acknowledged.
FOLDED, DONE = "folded_batch", "done_batch"


def run_failure_notification_once(spark: SparkSession, store: BucketStore, batch: int, *, history: DataFrame,
                                  steps: DataFrame, jobs: DataFrame, event_messages: DataFrame, ignore: DataFrame,
                                  report_root: str, server: str, refresh_duration: bool = False) -> dict:
    """The run of batch number ``batch`` (rising). Versions and report folder are None where there was nothing left to do.

    A batch at or below the last acknowledged one is skipped. One that was folded in but not
    acknowledged goes on from its stored state: its report is written again in place, under the
    batch's own name, so readers see one report a batch. Two runs of one batch at the same time:
    the one that commits second raises ``ConcurrentCommit``.
    """
    done = {"state_version": None, "final_version": None, "report_path": None}
    version = store.latest()
    notes = store.notes(version) if version else {}
    if notes.get(DONE, -1) >= batch:
        return done
    if notes.get(FOLDED, -1) < batch:
        folded = fold_new_runs(store.read(version), history=history, steps=steps, jobs=jobs,
                               event_messages=event_messages, ignore=ignore, refresh_duration=refresh_duration)
        version = store.commit(folded, version, {FOLDED: batch})
    written = store.read(version)
    done["state_version"] = version
    if not failure_rows(written).isEmpty():
        done["report_path"] = f"{report_root.rstrip('/')}/batch-{batch:08d}"
        write_report(failure_report(written, server), done["report_path"], mode="overwrite")
    reported = acknowledge(written.where("UpdateFlag <> 0")).withColumn("_op", F.lit("put"))
    done["final_version"] = store.apply(reported, version, {DONE: batch})
    return done
