"""Report execution-log operators.

The log is the large table; the catalog is a dimension keyed by ItemID. Joins
are plain equi-joins: AQE turns them into broadcast joins when the catalog side
measures under the broadcast threshold and splits skewed partitions (one report
holding a large share of the log) otherwise. Time filters are written on the
log's own columns so they reach the parquet scan.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F

from opslog.functions.numeric import bytes_to_kb, int_div
from opslog.functions.temporal import elapsed_clock_text, second_boundaries, seconds_as_time_text
from opslog.functions.text import parent_folder, strip_domain, text_equals, text_key
from opslog.operators.ordering import sort_balanced
from opslog.sources.logstore import period_bounds
from opslog.sources.rollup import merged_states, states_in_range


def ts_lit(value) -> Column:
    """A TIMESTAMP_NTZ literal from a datetime, date or ISO text."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    if isinstance(value, (_dt.datetime, _dt.date)):
        value = value.isoformat(sep=" ") if isinstance(value, _dt.datetime) else value.isoformat()
    return F.lit(str(value)).cast("timestamp_ntz")


def _moment(value) -> _dt.datetime:
    """A datetime from a datetime, date or ISO text."""
    if isinstance(value, str):
        return _dt.datetime.fromisoformat(value)
    return value if isinstance(value, _dt.datetime) else _dt.datetime.combine(value, _dt.time())


def _after(log: DataFrame, since, inclusive: bool) -> DataFrame:
    """Runs started after ``since`` (or at it, when inclusive)."""
    t = ts_lit(since)
    cond = F.col("TimeStart") >= t if inclusive else F.col("TimeStart") > t
    return log.filter(cond & period_bounds(log, lo=t))


def _within(log: DataFrame, start, end) -> DataFrame:
    """Runs started within [start, end]."""
    lo, hi = ts_lit(start), ts_lit(end)
    return log.filter(F.col("TimeStart").between(lo, hi) & period_bounds(log, lo=lo, hi=hi))


def _with_report(log: DataFrame, catalog: DataFrame, *cat_cols: str) -> DataFrame:
    c = catalog.select(F.col("ItemID").alias("_item"), *cat_cols)
    return log.join(c, log["ReportID"] == c["_item"], "inner").drop("_item")


def execution_history(log: DataFrame, catalog: DataFrame, domain: str, case_sensitive: bool = True) -> DataFrame:
    """Report execution history: log joined to the catalog, with folder, duration,
    user without domain and size in KB."""
    j = _with_report(log, catalog, "Name", "Path")
    return j.select(
        F.col("Name").alias("ReportName"),
        parent_folder("Path").alias("ReportPath"),
        "TimeStart",
        "TimeEnd",
        seconds_as_time_text(second_boundaries("TimeStart", "TimeEnd")).alias("Duration"),
        "Parameters",
        strip_domain("UserName", domain, case_sensitive).alias("UserName"),
        F.col("Format").alias("ReportFormat"),
        "Status",
        "TimeDataRetrieval",
        "TimeProcessing",
        "TimeRendering",
        bytes_to_kb("ByteCount").alias("RenderedKB"),
        "RowCount",
    )


# Status codes of a running request; minimum age of a request
# to be listed (minutes); size threshold of a large render (KB).
STATUS_SUCCESS = (0, 4, 5)
STATUS_IN_PROGRESS = (1, 2, 3, 7)
MIN_RUNNING_MINUTES = 1
LARGE_RENDER_KB = 100


def running_now(running_jobs: DataFrame, users: DataFrame, now=None,
                min_age_minutes: int = MIN_RUNNING_MINUTES, total_hours: bool = False) -> DataFrame:
    """Requests started more than ``min_age_minutes`` before ``now``, with the
    user name, decoded status and elapsed ``H:MI:SS`` (hours wrap at 24 unless
    ``total_hours``). ``now`` defaults to the current time."""
    now_c = F.current_timestamp().cast("timestamp_ntz") if now is None else ts_lit(now)
    cutoff = now_c - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(min_age_minutes))
    rj = running_jobs.filter(F.col("StartDate") < cutoff)
    # Few requests run at a time, but the user table can be large, and an
    # outer join may only build (broadcast) its non-preserved side. So the
    # users are first cut down to the ids the requests reference (a semi-join
    # against a small distinct set, broadcast by AQE); the outer join then
    # sees a small right side, and the user table is never shuffled.
    ids = rj.select(F.col("UserId").alias("_ref")).distinct()
    u = users.join(ids, users["UserID"] == ids["_ref"], "left_semi").select(
        F.col("UserID").alias("_uid"), F.col("UserName"))
    j = rj.join(u, rj["UserId"] == u["_uid"], "left")
    status = (
        F.when(F.col("JobStatus").isin(*STATUS_SUCCESS), "Success")
        .when(F.col("JobStatus").isin(*STATUS_IN_PROGRESS), "InProgress")
        .otherwise("Undefined")
    )
    return j.select(
        "RequestName", "RequestPath", "ComputerName", "UserName",
        F.col("Timeout").alias("TimeoutSec"), "StartDate",
        status.alias("JobStatus"),
        elapsed_clock_text("StartDate", now_c, total_hours).alias("TimeElapsed"),
    )


def report_runs(log: DataFrame, catalog: DataFrame, since, report_name: str,
                case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Runs of one report after ``since``, newest first, with command duration."""
    l = _after(log, since, inclusive=False)
    c = catalog.filter(text_equals("Name", report_name, case_sensitive))
    j = _with_report(l, c, "Name", "Path")
    out = j.select(
        F.col("Name").alias("ReportName"), F.col("Path").alias("ReportPath"),
        "TimeStart", "TimeEnd", "Parameters", "UserName", "Status",
        "TimeDataRetrieval", "TimeProcessing", "TimeRendering",
        seconds_as_time_text(second_boundaries("TimeStart", "TimeEnd")).alias("CommandDuration"),
    )
    return sort_balanced(out, F.col("TimeStart").desc(), ordered=ordered)


def runs_since(log: DataFrame, catalog: DataFrame, since, ordered: bool = True) -> DataFrame:
    """All runs after ``since``, newest first."""
    j = _with_report(_after(log, since, inclusive=False), catalog, "Name", "Path")
    out = j.select(
        F.col("Name").alias("ReportName"), F.col("Path").alias("ReportPath"),
        "TimeStart", "TimeEnd", "Parameters", "UserName", "Status",
    )
    return sort_balanced(out, F.col("TimeStart").desc(), ordered=ordered)


def running_requests(running_jobs: DataFrame, ordered: bool = True) -> DataFrame:
    """Every running request, oldest first."""
    return sort_balanced(running_jobs.select("*"), F.col("StartDate").asc(), ordered=ordered)


def large_renders(log: DataFrame, min_kb: int = LARGE_RENDER_KB, ordered: bool = True) -> DataFrame:
    """Log rows whose size in whole KB (truncating division) exceeds ``min_kb``,
    largest first.

    ``ByteCount div 1024 > n`` is also written as the equivalent range bound on
    ByteCount, which parquet statistics can use to skip row groups.
    """
    n = int(min_kb)
    if n >= 0:
        bound = F.col("ByteCount") >= (n + 1) * 1024
    else:
        bound = F.col("ByteCount") >= (n * 1024) + 1
    exact = int_div(F.col("ByteCount"), F.lit(1024)) > n
    return sort_balanced(log.filter(bound & exact), F.col("ByteCount").desc(), ordered=ordered)


def runs_in_range(log: DataFrame, catalog: DataFrame, start, end, ordered: bool = True) -> DataFrame:
    """Runs started within [start, end], oldest first."""
    j = _with_report(_within(log, start, end), catalog, "Name")
    out = j.select("UserName", "TimeStart", "TimeEnd", "TimeDataRetrieval", "TimeProcessing", "TimeRendering", "Name")
    return sort_balanced(out, F.col("TimeStart").asc(), ordered=ordered)


def _by_name(df: DataFrame, name: str, case_sensitive: bool) -> GroupedData:
    """Groups by a name, or by it as a collated key."""
    return df.groupBy(name) if case_sensitive else df.groupBy(text_key(name, False).alias("_key"))


def _shown(name: str, case_sensitive: bool) -> list[Column]:
    """The spelling shown for a group: the name itself (no aggregate, so the plan hashes), or the smallest one."""
    return [] if case_sensitive else [F.min(name).alias(name)]


def report_stats(log: DataFrame, catalog: DataFrame, since, case_sensitive: bool = True,
                 ordered: bool = True) -> DataFrame:
    """Per report name: run count, integer mean processing time, last run.

    The log is pre-aggregated per ReportID (partial+final aggregate: a hot
    report is combined map-side) before the join, so the join moves one row per
    report instead of one per run; the second aggregate folds reports sharing a
    name. Sum and count are carried separately so the integer mean is exact.
    Without case, names that differ in case and trailing blanks only are one report,
    shown by the smallest of them.
    """
    per_report = (
        _after(log, since, inclusive=True)
        .groupBy("ReportID")
        .agg(
            F.count(F.lit(1)).alias("_runs"),
            F.sum(F.col("TimeProcessing").cast("long")).alias("_sum"),
            F.count("TimeProcessing").alias("_n"),
            F.max("TimeStart").alias("_last"),
        )
    )
    j = _with_report(per_report, catalog, "Name")
    out = _by_name(j, "Name", case_sensitive).agg(
        *_shown("Name", case_sensitive),
        F.sum("_runs").alias("TimesRun"),
        int_div(F.sum("_sum"), F.sum("_n")).alias("AvgProcTimeMS"),
        F.max("_last").alias("LastRunDate"),
    ).drop("_key")
    return sort_balanced(out, F.col("AvgProcTimeMS").desc(), ordered=ordered)


def report_stats_from_rollup(rollup: DataFrame, log: DataFrame, catalog: DataFrame, since,
                             ordered: bool = True) -> DataFrame:
    """``report_stats`` from stored states per period and ReportID (see ``opslog.sources.rollup``): whole
    periods are merged, and raw rows are read only of the period that ``since`` cuts."""
    states = merged_states(states_in_range(rollup, log, _moment(since), None, ["ReportID"], "TimeProcessing"), "ReportID")
    j = _with_report(states, catalog, "Name")
    out = merged_states(j, "Name").select(
        "Name", F.col("runs").alias("TimesRun"), int_div(F.col("total"), F.col("measured")).alias("AvgProcTimeMS"),
        F.col("latest").alias("LastRunDate"))
    return sort_balanced(out, F.col("AvgProcTimeMS").desc(), ordered=ordered)


def runs_per_user_from_rollup(rollup: DataFrame, log: DataFrame, start, end, ordered: bool = True) -> DataFrame:
    """``runs_per_user`` from stored states per period and user; raw rows are read of the two periods
    at the edges at most."""
    states = states_in_range(rollup, log, _moment(start), _moment(end), ["UserName"], "TimeProcessing")
    out = states.groupBy("UserName").agg(F.sum("runs").alias("NumReports"))
    return sort_balanced(out, "UserName", ordered=ordered)


def run_detail(log: DataFrame, catalog: DataFrame, since) -> DataFrame:
    """Run detail from ``since`` on (unordered, as the source query)."""
    j = _with_report(_after(log, since, inclusive=True), catalog, "Name")
    return j.select("UserName", "TimeStart", "TimeEnd", "TimeDataRetrieval", "TimeProcessing", "TimeRendering", "Name")


def runs_per_user(log: DataFrame, start, end, case_sensitive: bool = True, ordered: bool = True) -> DataFrame:
    """Number of runs per user within [start, end], by user name (without case:
    one row per spelling-insensitive name, shown by the smallest spelling)."""
    out = (
        _by_name(_within(log, start, end), "UserName", case_sensitive)
        .agg(*_shown("UserName", case_sensitive), F.count(F.lit(1)).alias("NumReports"))
        .drop("_key")
    )
    return sort_balanced(out, "UserName", ordered=ordered, case_sensitive=case_sensitive)
