"""Job-history operators: latest run per job step, last package error per step."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opslog.functions.temporal import coded_datetime, coded_duration_text
from opslog.functions.text import package_file_name, text_equals, text_key, text_like

# LIKE mask of a GUID-shaped job name (13 any, -, 4, -, 4, -, 12 any);
# package steps (subsystem, command pattern, file extension, path separator);
# the error event name and the length an error message is cut to.
GUID_NAME_MASK = "_____________-____-____-____________"
PACKAGE_SUBSYSTEM = "SSIS"
PACKAGE_COMMAND_PATTERN = "%ssis%"
PACKAGE_EXTENSION = ".dtsx"
PACKAGE_PATH_SEPARATOR = "\\"
ERROR_EVENT = "OnError"
ERROR_MESSAGE_LENGTH = 4000


def last_job_run(history: DataFrame, steps: DataFrame, jobs: DataFrame,
                 exclude_guid_names: bool = True, enabled_only: bool = True) -> DataFrame:
    """Newest history row of every step of enabled jobs, with decoded run time.

    history: instance_id, job_id, step_id, message
    steps:   job_id, step_id, step_name, subsystem, last_run_outcome,
             last_run_date (yyyymmdd), last_run_time (hhmmss), last_run_duration (hhmmss)
    jobs:    job_id, name, enabled

    Plan: the newest instance per (job_id, step_id) is a hash aggregate over
    three narrow columns (map-side combine, so a job with a third of all
    history rows costs one row per map task in the shuffle), cut to the steps
    of live jobs, then joined back to the history by instance to fetch the
    message. The second scan streams against that small side; no message
    text is sorted or kept in an aggregation buffer.
    """
    job_filter = F.lit(True)
    if enabled_only:
        job_filter = job_filter & (F.col("enabled") == 1)
    if exclude_guid_names:
        job_filter = job_filter & ~F.col("name").like(GUID_NAME_MASK)
    live_jobs = jobs.filter(job_filter).select("job_id", "name")
    newest = (history.groupBy("job_id", "step_id").agg(F.max("instance_id").alias("instance_id"))
              .join(live_jobs, "job_id", "inner"))
    s = steps.select(
        "job_id", "step_id", "step_name", "subsystem", "last_run_outcome",
        coded_datetime("last_run_date", "last_run_time").alias("LastRunDateTime"),
        coded_duration_text("last_run_duration").alias("LastRunDuration"),
    )
    latest = history.select("job_id", "step_id", "instance_id", "message").join(
        s.join(newest, ["job_id", "step_id"], "inner"), ["job_id", "step_id", "instance_id"], "inner")
    return (
        latest
        .select(
            "instance_id", "name", "job_id", "step_name", "step_id", "message",
            "last_run_outcome", "LastRunDateTime", "LastRunDuration", "subsystem",
        )
    )


def last_package_error(steps: DataFrame, event_messages: DataFrame, *,
                       subsystem: str = PACKAGE_SUBSYSTEM, command_pattern: str = PACKAGE_COMMAND_PATTERN,
                       extension: str = PACKAGE_EXTENSION, separator: str = PACKAGE_PATH_SEPARATOR,
                       error_event: str = ERROR_EVENT, max_length: int = ERROR_MESSAGE_LENGTH,
                       case_sensitive: bool = True) -> DataFrame:
    """First error message of the newest operation of each step's package, for all steps.

    Set-based form of the per-step table function: returns job_id, step_id,
    PackageName, ErrorMessage, RankNum (always 1). Semantics kept:

    * the newest operation of a package counts all its events, not only errors,
      so a package whose newest run was clean yields no row;
    * the rank is over the *operation*: when one operation ran several packages,
      only the package holding the operation's first error gets a row.

    Plan: newest operation per package is a partial+final aggregate; the errors
    are joined to it (one row per package on the small side); the rank-1 filter
    becomes a WindowGroupLimit applied before and after the shuffle, so a huge
    operation contributes at most its first rows to the exchange.
    """
    cs = case_sensitive
    sp = (
        steps.filter(text_equals("subsystem", subsystem, cs) & text_like("command", command_pattern, cs))
        .select("job_id", "step_id", package_file_name("command", extension, separator, cs).alias("PackageName"))
        .filter(F.col("PackageName").isNotNull())
    )
    # one name for all spellings that the comparison takes as equal
    folded = event_messages.withColumn("_package", text_key("package_name", cs))
    newest = folded.groupBy("_package").agg(F.max("operation_id").alias("operation_id"))
    errors = folded.filter(text_equals("event_name", error_event, cs)).join(
        newest, ["operation_id", "_package"], "inner"
    )
    w = Window.partitionBy("operation_id").orderBy(F.col("message_time").asc(), F.col("event_message_id").asc())
    first_errors = (
        errors.select(
            "_package",
            F.left(F.col("message"), F.lit(max_length)).alias("ErrorMessage"),
            F.rank().over(w).alias("RankNum"),
        )
        .filter(F.col("RankNum") == 1)
    )
    name = text_key("PackageName", cs)
    return sp.join(first_errors, name == F.col("_package"), "inner").select(
        "job_id", "step_id", "PackageName", "ErrorMessage", "RankNum"
    )


def package_error_for(package_errors: DataFrame, job_id, step_id) -> DataFrame:
    """Parameterised form (one job step) over the set-based result."""
    return package_errors.filter((F.col("job_id") == job_id) & (F.col("step_id") == step_id)).select(
        "PackageName", "ErrorMessage", "RankNum"
    )
