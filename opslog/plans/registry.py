"""Named queries over the stand-in tables: one per operator.

Each entry takes (spark, sf_dir) and returns a lazy DataFrame. The matching
DuckDB SQL for every entry lives in ``opslog.plans.oracle``.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog import operators as op
from opslog.functions.numeric import int_div
from opslog.functions.temporal import second_boundaries, seconds_as_time_text
from opslog.functions.text import parent_folder
from opslog.operators.reports import ts_lit
from opslog.plans import params as P
from opslog.schemas import STATE_COLUMNS
from opslog.sources.standins import standin
from opslog.sources.testdata import read_table


class Tables:
    """Lazy stand-in tables for one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return standin(self.spark, self.sf_dir, name)

    def events_before(self, cutoff: str) -> DataFrame:
        ev = read_table(self.spark, self.sf_dir, "events")
        return ev.filter(F.col("ts") < ts_lit(cutoff))


# ---------------------------------------------------------------- jobs
def q_last_job_run(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.last_job_run(t.job_history, t.job_steps, t.jobs)


def q_last_package_error(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.last_package_error(t.job_steps, t.event_messages)


def previous_state(spark, sf_dir) -> DataFrame:
    """Previous failure state: the last runs as of the cutoff, acknowledged,
    plus rows for jobs that no longer exist."""
    t = Tables(spark, sf_dir)
    ev = t.events_before(P.SNAPSHOT_CUTOFF)
    hist = standin(spark, sf_dir, "job_history", events=ev)
    steps = standin(spark, sf_dir, "job_steps", events=ev)
    base = op.to_state_rows(op.last_job_run(hist, steps, t.jobs), update_flag=0)
    extra = spark.sql(re.sub(r"TS\('([^']*)'\)", r"TIMESTAMP_NTZ '\1'", P.PREVIOUS_EXTRA_ROWS_SQL))
    return base.unionByName(extra.select(*STATE_COLUMNS))


def _merged(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.merge_state(previous_state(spark, sf_dir), op.last_job_run(t.job_history, t.job_steps, t.jobs))


def _suppressed(spark, sf_dir):
    return op.suppress_ignored(_merged(spark, sf_dir), Tables(spark, sf_dir).ignore_jobs)


def _enriched(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.enrich_failures(_suppressed(spark, sf_dir), op.last_package_error(t.job_steps, t.event_messages))


def q_lateral_table_function(spark, sf_dir):
    """Enrichment through the SQL table function under LEFT JOIN LATERAL."""
    from opslog.plans.sql_surface import enrich_with_lateral, register_package_error_function

    t = Tables(spark, sf_dir)
    fn = register_package_error_function(spark, t.job_steps, t.event_messages)
    return enrich_with_lateral(spark, _suppressed(spark, sf_dir), fn)


def q_merge_state(spark, sf_dir):
    return _merged(spark, sf_dir)


def q_suppress_ignored(spark, sf_dir):
    return _suppressed(spark, sf_dir)


def q_enrich_failures(spark, sf_dir):
    return _enriched(spark, sf_dir)


def q_new_failures(spark, sf_dir):
    return op.new_failures(_enriched(spark, sf_dir))


def q_failure_report(spark, sf_dir):
    return op.failure_report(_enriched(spark, sf_dir), P.SERVER)


def q_acknowledge(spark, sf_dir):
    return op.acknowledge(_enriched(spark, sf_dir))


def q_failure_notification(spark, sf_dir):
    """Runs the whole notification procedure with its writes (state versions, report) under
    the session's checkpoint folder; returns the final stored state."""
    from opslog.plans.notification import run_failure_notification
    from opslog.session import scratch_path
    import uuid

    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "failure-notification", uuid.uuid4().hex)
    from opslog.schemas import JOB_FAILURES
    from opslog.sources.snapshots import SnapshotStore

    store = SnapshotStore(spark, f"{root}/state", JOB_FAILURES)
    store.write(previous_state(spark, sf_dir))
    res = run_failure_notification(
        spark, store, history=t.job_history, steps=t.job_steps, jobs=t.jobs,
        event_messages=t.event_messages, ignore=t.ignore_jobs,
        report_root=f"{root}/reports", server=P.SERVER,
    )
    return store.read(res["final_version"])


def q_written_report(spark, sf_dir):
    """The report as written: its lines in document order, read back from the files."""
    import uuid

    from opslog.operators.notify import read_report, write_report
    from opslog.session import scratch_path

    path = scratch_path(spark, "written-report", uuid.uuid4().hex)
    write_report(op.failure_report(_enriched(spark, sf_dir), P.SERVER), path)
    return read_report(spark, path)


# ---------------------------------------------------------------- reports
def q_execution_history(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.execution_history(t.execution_log, t.catalog, P.DOMAIN)


def q_running_now(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.running_now(t.running_jobs, t.users, now=P.NOW)


def q_report_runs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.report_runs(t.execution_log, t.catalog, P.SINCE, P.REPORT_NAME)


def q_runs_since(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.runs_since(t.execution_log, t.catalog, P.SINCE)


def q_running_requests(spark, sf_dir):
    return op.running_requests(Tables(spark, sf_dir).running_jobs)


def q_large_renders(spark, sf_dir):
    return op.large_renders(Tables(spark, sf_dir).execution_log, P.MIN_KB)


def q_runs_in_range(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.runs_in_range(t.execution_log, t.catalog, P.RANGE_START, P.RANGE_END)


def q_report_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.report_stats(t.execution_log, t.catalog, P.SINCE)


def q_run_detail(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.run_detail(t.execution_log, t.catalog, P.SINCE)


def q_runs_in_range_by_period(spark, sf_dir):
    """Q12 over the log stored by period: the range reads only its folders. Every call stores the log anew."""
    import uuid

    from opslog.session import scratch_path
    from opslog.sources.logstore import write_by_period

    t = Tables(spark, sf_dir)
    path = scratch_path(spark, "log-by-month", uuid.uuid4().hex)
    # the stand-in log spans years with few rows a day: monthly folders
    write_by_period(t.execution_log, path, "TimeStart", granularity="month")
    return op.runs_in_range(spark.read.parquet(path), t.catalog, P.RANGE_START, P.RANGE_END)


def q_runs_per_user(spark, sf_dir):
    return op.runs_per_user(Tables(spark, sf_dir).execution_log, P.RANGE_START, P.RANGE_END)


# ---------------------------------------------------------------- catalog
def q_reports_with_sources(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.reports_with_sources(t.catalog, t.data_source, t.users)


def q_catalog_types(spark, sf_dir):
    return op.catalog_types(Tables(spark, sf_dir).catalog)


def q_subscription_jobs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.subscription_jobs(t.report_schedule, t.jobs, t.job_steps, t.subscriptions, t.catalog)


def q_user_permissions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.user_permissions(t.users, t.policy_user_role, t.policies, t.roles, t.catalog, P.PRINCIPAL)


def q_path_permissions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.path_permissions(t.catalog, t.policies, t.policy_user_role, t.users, t.roles, P.PATH_PREFIX)


def q_shared_data_sources(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.shared_data_sources(t.catalog, t.users, t.data_source, t.sec_data, P.DATA_SOURCE_NS)


def q_data_source_dependents(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.data_source_dependents(t.catalog, t.users, t.data_source, t.sec_data, None, P.DATA_SOURCE_NS)


def q_configuration(spark, sf_dir):
    return op.configuration(Tables(spark, sf_dir).configuration)


def q_report_queries(spark, sf_dir):
    return op.report_queries(Tables(spark, sf_dir).catalog)


def q_one_data_source(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.data_source_dependents(t.catalog, t.users, t.data_source, t.sec_data, P.DATA_SOURCE_PATH, P.DATA_SOURCE_NS)


def q_report_queries_binary(spark, sf_dir):
    """The same documents as bytes with a byte-order mark, as the source stores them."""
    c = Tables(spark, sf_dir).catalog
    bom = F.lit(bytearray(b"\xef\xbb\xbf"))
    return op.report_queries(c.withColumn("Content", F.concat(bom, F.encode("Content", "UTF-8"))))


def _view(view: str) -> Callable[[SparkSession, str], DataFrame]:
    """A query that reads one of the registered views."""
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        from opslog.plans.sql_surface import register_views

        t = Tables(spark, sf_dir)
        register_views(spark, history=t.job_history, steps=t.job_steps, jobs=t.jobs, event_messages=t.event_messages,
                       execution_log=t.execution_log, catalog=t.catalog, running_jobs=t.running_jobs, users=t.users,
                       domain=P.DOMAIN, now=P.NOW)
        return spark.table(view)

    return query


def q_subscriptions_matching(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.subscriptions_matching(t.catalog, t.subscriptions, P.SETTING_TEXT)


# ---------------------------------------------------------------- generic operators
def q_parent_folder(spark, sf_dir):
    c = Tables(spark, sf_dir).catalog
    return c.select("ItemID", "Path", parent_folder("Path").alias("Folder"))


def q_second_boundaries(spark, sf_dir):
    l = Tables(spark, sf_dir).execution_log
    d = second_boundaries("TimeStart", "TimeEnd")
    return l.select("ReportID", "Parameters", d.alias("Seconds"), seconds_as_time_text(d).alias("Clock"))


def _bucket_state(spark, sf_dir, name):
    """A state store by key bucket that holds the previous state's rows with a key."""
    import uuid

    from opslog.schemas import JOB_FAILURES
    from opslog.session import scratch_path
    from opslog.sources.buckets import BucketStore

    store = BucketStore(spark, scratch_path(spark, name, uuid.uuid4().hex), JOB_FAILURES, ["JobID", "StepID"], buckets=16)
    return store, store.commit(previous_state(spark, sf_dir), None)


def q_merge_state_by_bucket(spark, sf_dir):
    """N6 into the copy-on-write store, read back: only buckets with changed keys are written."""
    store, base = _bucket_state(spark, sf_dir, "bucket-state")
    return store.read(store.commit(_merged(spark, sf_dir), base))


def q_last_job_run_incremental(spark, sf_dir):
    """N1 from the stored newest runs, refreshed after each of three loads of the history."""
    import uuid

    from opslog.operators.newest import newest_store, refresh_newest
    from opslog.session import scratch_path
    from opslog.sources.logstore import write_by_period

    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "newest-runs", uuid.uuid4().hex)
    store = newest_store(spark, f"{root}/state", buckets=16)
    events = read_table(spark, sf_dir, "events")
    history = standin(spark, sf_dir, "job_history").join(events.select(F.col("event_id").alias("instance_id"), "ts"), "instance_id")
    for lo, hi in zip((None, *P.HISTORY_LOADS), (*P.HISTORY_LOADS, None)):
        load = history.filter((F.col("ts") >= ts_lit(lo) if lo else F.lit(True)) & (F.col("ts") < ts_lit(hi) if hi else F.lit(True)))
        write_by_period(load, f"{root}/history", "ts", mode="append")
        refresh_newest(store, spark.read.parquet(f"{root}/history"))
    return op.last_job_run(store.read(), t.job_steps, t.jobs)


def _log_by_month(spark, sf_dir):
    """The log stored by month (the stand-in log has few rows a day), and its root folder."""
    import uuid

    from opslog.session import scratch_path
    from opslog.sources.logstore import write_by_period

    root = scratch_path(spark, "log-and-rollup", uuid.uuid4().hex)
    write_by_period(Tables(spark, sf_dir).execution_log, f"{root}/log", "TimeStart", granularity="month")
    return spark.read.parquet(f"{root}/log"), root


def q_report_stats_from_rollup(spark, sf_dir):
    """Q13 from monthly states per report, with a start that cuts a month."""
    from opslog.sources.rollup import refresh_rollup

    log, root = _log_by_month(spark, sf_dir)
    refresh_rollup(log, f"{root}/rollup", ["ReportID"], "TimeProcessing")
    return op.report_stats_from_rollup(spark.read.parquet(f"{root}/rollup"), log, Tables(spark, sf_dir).catalog, P.SINCE_MIDDAY)


def q_runs_per_user_from_rollup(spark, sf_dir):
    """Q15 from monthly states per user, with a range that cuts two months."""
    from opslog.sources.rollup import refresh_rollup

    log, root = _log_by_month(spark, sf_dir)
    refresh_rollup(log, f"{root}/rollup", ["UserName"], "TimeProcessing")
    return op.runs_per_user_from_rollup(spark.read.parquet(f"{root}/rollup"), log, P.SINCE_MIDDAY, P.UNTIL_MIDDAY)


def _mixed(df: DataFrame, column: str, number: str) -> DataFrame:
    """``column`` in upper case with trailing blanks, in lower case, or as it is, by ``number``."""
    c, n = F.col(column), F.col(number) % 3
    return df.withColumn(column, F.when(n == 0, F.concat(F.upper(c), F.lit("  "))).when(n == 1, F.lower(c)).otherwise(c))


def q_collated_subscription_jobs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    jobs = t.jobs.withColumn("name", F.concat(F.lower("name"), F.lit(" ")))
    return op.subscription_jobs(t.report_schedule, jobs, t.job_steps, t.subscriptions, t.catalog)


def q_collated_user_permissions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.user_permissions(_mixed(t.users, "UserName", "UserID"), t.policy_user_role, t.policies, t.roles, t.catalog,
                               P.PRINCIPAL.upper() + " ", case_sensitive=False)


def q_collated_path_permissions(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.path_permissions(_mixed(t.catalog, "Path", "ItemID"), t.policies, t.policy_user_role, t.users, t.roles,
                               P.PATH_PREFIX.lower(), case_sensitive=False)


def q_collated_one_data_source(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.data_source_dependents(_mixed(t.catalog, "Path", "ItemID"), t.users, t.data_source, t.sec_data,
                                     P.DATA_SOURCE_PATH.upper() + "  ", P.DATA_SOURCE_NS, case_sensitive=False)


def q_collated_report_runs(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.report_runs(t.execution_log, _mixed(t.catalog, "Name", "ItemID"), P.SINCE, P.REPORT_NAME.upper() + " ",
                          case_sensitive=False)


def q_collated_report_stats(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.report_stats(t.execution_log, _mixed(t.catalog, "Name", "ItemID"), P.SINCE, case_sensitive=False)


def q_collated_runs_per_user(spark, sf_dir):
    log = _mixed(Tables(spark, sf_dir).execution_log, "UserName", "ReportID")
    return op.runs_per_user(log, P.RANGE_START, P.RANGE_END, case_sensitive=False)


def q_collated_subscriptions_matching(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return op.subscriptions_matching(t.catalog, t.subscriptions, P.SETTING_TEXT.upper(), case_sensitive=False)


def q_collated_last_package_error(spark, sf_dir):
    t = Tables(spark, sf_dir)
    events = _mixed(_mixed(t.event_messages, "package_name", "event_message_id"), "event_name", "event_message_id")
    return op.last_package_error(t.job_steps, events, case_sensitive=False)


# Total orders: the order a source query asks for, then columns that tell its rows apart.
REPORT_RUN_ORDER = ["Parameters", "ReportPath", "UserName", "TimeEnd", "Status", "TimeDataRetrieval", "TimeProcessing", "TimeRendering"]
LOG_ORDER = ["ReportID", "Parameters", "TimeStart", "TimeRendering", "UserName", "TimeEnd", "Status", "Format", "TimeDataRetrieval"]


def q_numbered_report_runs(spark, sf_dir):
    """Q8 with each run's place, newest first."""
    t = Tables(spark, sf_dir)
    runs = op.report_runs(t.execution_log, t.catalog, P.SINCE, P.REPORT_NAME, ordered=False)
    return op.numbered(runs, F.desc("TimeStart"), *REPORT_RUN_ORDER)


def q_numbered_large_renders(spark, sf_dir):
    """Q11 with each run's place, largest first."""
    runs = op.large_renders(Tables(spark, sf_dir).execution_log, P.MIN_KB, ordered=False)
    return op.numbered(runs, F.desc("ByteCount"), *LOG_ORDER)


def q_numbered_report_stats(spark, sf_dir):
    """Q13 with each report's place, slowest first."""
    t = Tables(spark, sf_dir)
    return op.numbered(op.report_stats(t.execution_log, t.catalog, P.SINCE, ordered=False), F.desc("AvgProcTimeMS"), "Name")


def q_numbered_new_failures(spark, sf_dir):
    """N9 with each failure's place in the report's order."""
    return op.numbered(op.new_failures(_enriched(spark, sf_dir), ordered=False),
                       "JobName", "StepName", "LastRunDateTime", "InstanceID")


LATEST_ORDER = ["TimeStart", "Parameters", "UserName", "RowCount", "TimeRendering", "ByteCount", "Status"]


def q_latest_per_key(spark, sf_dir):
    """Newest run of every report."""
    l = Tables(spark, sf_dir).execution_log
    return op.latest_per_key(l, ["ReportID"], LATEST_ORDER, ["TimeStart", "UserName", "Status", "Parameters"])


def q_int_avg(spark, sf_dir):
    l = Tables(spark, sf_dir).execution_log
    return l.groupBy("Format").agg(
        int_div(F.sum(F.col("TimeRendering").cast("long")), F.count("TimeRendering")).alias("AvgRendering"),
        F.count(F.lit(1)).alias("Runs"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    # named operators
    "last_job_run": q_last_job_run,
    "last_package_error": q_last_package_error,
    "execution_history": q_execution_history,
    "report_queries": q_report_queries,
    "running_now": q_running_now,
    "merge_state": q_merge_state,
    "suppress_ignored": q_suppress_ignored,
    "enrich_failures": q_enrich_failures,
    "new_failures": q_new_failures,
    "failure_report": q_failure_report,
    "acknowledge": q_acknowledge,
    "failure_notification": q_failure_notification,
    # ad-hoc catalog / log queries
    "q1_reports_with_sources": q_reports_with_sources,
    "q2_catalog_types": q_catalog_types,
    "q3_subscription_jobs": q_subscription_jobs,
    "q4_user_permissions": q_user_permissions,
    "q5_path_permissions": q_path_permissions,
    "q6_shared_data_sources": q_shared_data_sources,
    "q7_data_source_dependents": q_data_source_dependents,
    "q8_report_runs": q_report_runs,
    "q9_runs_since": q_runs_since,
    "q10_running_requests": q_running_requests,
    "q11_large_renders": q_large_renders,
    "q12_runs_in_range": q_runs_in_range,
    "q13_report_stats": q_report_stats,
    "q14_run_detail": q_run_detail,
    "q15_runs_per_user": q_runs_per_user,
    "q16_configuration": q_configuration,
    "q17_subscriptions_matching": q_subscriptions_matching,
    # generic operators
    "parent_folder": q_parent_folder,
    "second_boundaries": q_second_boundaries,
    "int_avg": q_int_avg,
    "lateral_table_function": q_lateral_table_function,
    "latest_per_key": q_latest_per_key,
    "runs_in_range_by_period": q_runs_in_range_by_period,
    "written_report": q_written_report,
    # state by key bucket, newest runs from new folders only
    "merge_state_by_bucket": q_merge_state_by_bucket,
    "last_job_run_incremental": q_last_job_run_incremental,
    # comparison under the source's collation: without case and trailing blanks
    "collated_q3_subscription_jobs": q_collated_subscription_jobs,
    "collated_q4_user_permissions": q_collated_user_permissions,
    "collated_q5_path_permissions": q_collated_path_permissions,
    "collated_q7_one_data_source": q_collated_one_data_source,
    "collated_q8_report_runs": q_collated_report_runs,
    "collated_q13_report_stats": q_collated_report_stats,
    "collated_q15_runs_per_user": q_collated_runs_per_user,
    "collated_q17_subscriptions_matching": q_collated_subscriptions_matching,
    "collated_last_package_error": q_collated_last_package_error,
    # statistics from stored partial states
    "q13_report_stats_from_rollup": q_report_stats_from_rollup,
    "q15_runs_per_user_from_rollup": q_runs_per_user_from_rollup,
    # the order of sorted results, as a column
    "numbered_report_runs": q_numbered_report_runs,
    "numbered_large_renders": q_numbered_large_renders,
    "numbered_report_stats": q_numbered_report_stats,
    "numbered_new_failures": q_numbered_new_failures,
    # binary documents, one data source by its path, the views
    "report_queries_binary": q_report_queries_binary,
    "q7_one_data_source": q_one_data_source,
    "view_last_job_run": _view("last_job_run_info"),
    "view_execution_history": _view("report_execution_history"),
    "view_report_queries": _view("report_queries"),
    "view_running_now": _view("reports_currently_running"),
}
