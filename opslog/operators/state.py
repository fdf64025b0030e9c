"""Failure-state operators. Each is a pure function snapshot -> snapshot.

The source system mutates one table in place (MERGE, then UPDATEs). Here a
state is a DataFrame with the ``JOB_FAILURES`` columns; the plan driver writes
each new snapshot as a new version (see ``opslog.sources.snapshots``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.functions.text import text_equals
from opslog.operators.jobs import PACKAGE_SUBSYSTEM
from opslog.operators.ordering import sort_balanced
from opslog.schemas import JOB_FAILURES, STATE_COLUMNS

_TYPES = {f.name: f.dataType for f in JOB_FAILURES.fields}

# MERGE source columns (last_job_run output) -> state columns.
_SOURCE_TO_STATE = {
    "InstanceID": "instance_id",
    "JobName": "name",
    "JobID": "job_id",
    "StepName": "step_name",
    "StepID": "step_id",
    "StepMessage": "message",
    "LastRunOutcome": "last_run_outcome",
    "LastRunDateTime": "LastRunDateTime",
    "LastRunDuration": "LastRunDuration",
    "SubSystem": "subsystem",
}
# Columns a matched row takes from the source when its instance changed.
# LastRunDuration is set on insert only and stays as first written.
_UPDATED = ["InstanceID", "JobName", "StepName", "StepMessage", "LastRunOutcome", "LastRunDateTime", "SubSystem"]


def to_state_rows(last_run: DataFrame, update_flag: int = 1) -> DataFrame:
    """last_job_run rows in the state layout with a constant UpdateFlag."""
    cols = [F.col(src).cast(_TYPES[dst]).alias(dst) for dst, src in _SOURCE_TO_STATE.items()]
    cols.append(F.lit(update_flag).cast("int").alias("UpdateFlag"))
    return last_run.select(*cols).select(*STATE_COLUMNS)


def merge_state(state: DataFrame, last_run: DataFrame, refresh_duration: bool = False) -> DataFrame:
    """Fold the latest run of every job step into the state, keyed by (JobID, StepID).

    * new key              -> inserted with UpdateFlag 1
    * key gone from source -> deleted (a NULL key never matches, so it goes too)
    * instance changed     -> run columns replaced, UpdateFlag 1
    * instance unchanged   -> row kept as it was
    Two source rows for one existing key raise an error, as the MERGE does; a
    key that the state holds twice is updated twice, as there.

    Plan: the MERGE's three-way match is one outer join that keeps every
    source row (target-only rows are the deletions, so they are simply not
    kept). Source rows are counted per key before the join, by a window on the
    join's own keys, so a sort-merge join reuses its partitioning. The test is
    a filter, which no reader's choice of columns can remove.
    """
    src = to_state_rows(last_run, 1).select(*[F.col(c).alias(f"s_{c}") for c in STATE_COLUMNS])
    src = src.withColumn("s_n", F.count(F.lit(1)).over(Window.partitionBy("s_JobID", "s_StepID")))
    tgt = state.select(*[F.col(c).alias(f"t_{c}") for c in STATE_COLUMNS], F.lit(True).alias("t_present"))
    j = tgt.join(
        src,
        (F.col("t_JobID") == F.col("s_JobID")) & (F.col("t_StepID") == F.col("s_StepID")),
        "right_outer",
    )
    in_tgt = F.col("t_present").isNotNull()
    changed = in_tgt & (F.col("s_InstanceID") != F.col("t_InstanceID"))
    twice = F.when(in_tgt & (F.col("s_n") > 1), F.raise_error(F.lit("merge_state: several source rows for one (JobID, StepID)")))
    j = j.filter(F.coalesce(twice.cast("boolean"), F.lit(True)))
    updated = set(_UPDATED) | ({"LastRunDuration"} if refresh_duration else set())

    out = []
    for c in STATE_COLUMNS:
        if c == "UpdateFlag":
            e = F.when(~in_tgt | changed, F.lit(1)).otherwise(F.col("t_UpdateFlag"))
        elif c in updated:
            e = F.when(~in_tgt | changed, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        else:  # key columns and the stale duration
            e = F.when(~in_tgt, F.col(f"s_{c}")).otherwise(F.col(f"t_{c}"))
        out.append(e.cast(_TYPES[c]).alias(c))
    return j.select(*out)


def suppress_ignored(state: DataFrame, ignore: DataFrame) -> DataFrame:
    """UpdateFlag 0 for every row whose JobID is in the ignore list (all its steps)."""
    keys = ignore.select(F.col("JobID").alias("_ign")).distinct()
    j = state.join(keys, state["JobID"] == keys["_ign"], "left")
    flag = F.when(F.col("_ign").isNotNull(), F.lit(0)).otherwise(F.col("UpdateFlag")).cast("int")
    return j.select(*[flag.alias(c) if c == "UpdateFlag" else F.col(c) for c in STATE_COLUMNS])


def enrich_failures(state: DataFrame, package_errors: DataFrame, subsystem: str = PACKAGE_SUBSYSTEM,
                    case_sensitive: bool = True) -> DataFrame:
    """StepMessage of every failed package step := its package's last error message.

    Applies to all failed steps of that subsystem (not only new ones); a step
    without a found message gets NULL. If several messages match one step the
    smallest is taken, so the result is deterministic.
    """
    pe = package_errors.groupBy("job_id", "step_id").agg(F.min("ErrorMessage").alias("_err"))
    j = state.join(pe, (state["JobID"] == pe["job_id"]) & (state["StepID"] == pe["step_id"]), "left")
    failed = (F.col("LastRunOutcome") == 0) & text_equals("SubSystem", subsystem, case_sensitive)
    msg = F.when(failed, F.col("_err")).otherwise(F.col("StepMessage"))
    return j.select(*[msg.alias(c) if c == "StepMessage" else F.col(c) for c in STATE_COLUMNS])


def failure_rows(state: DataFrame) -> DataFrame:
    """Rows to notify (unordered): changed or new (UpdateFlag 1), failed, with a known run time."""
    return state.filter(
        (F.col("UpdateFlag") == 1) & (F.col("LastRunOutcome") == 0) & F.col("LastRunDateTime").isNotNull()
    )


def new_failures(state: DataFrame, ordered: bool = True) -> DataFrame:
    """Rows to notify, by job name, step name and run time."""
    return sort_balanced(failure_rows(state), "JobName", "StepName", "LastRunDateTime", ordered=ordered)


def acknowledge(state: DataFrame) -> DataFrame:
    """All rows acknowledged: UpdateFlag 0."""
    return state.select(*[F.lit(0).cast("int").alias(c) if c == "UpdateFlag" else F.col(c) for c in STATE_COLUMNS])
