"""Rollups of a period-partitioned log by day or month, merged at query time.

A rollup holds, per period (``log_day`` or ``log_month``, as the log has it) and key,
states that merge exactly: the number of rows, and for a measured column its sum,
its count of non-null values, and for a time column its greatest value. A query
over a time range merges the states of the periods that lie wholly inside and
reads raw rows only of the periods that the range cuts (at most two), so it costs
periods times keys instead of runs, and gives the same numbers as the raw log: a
mean is the quotient of sums and counts.

``refresh_rollup`` aggregates only folders that the rollup does not have yet. Folders
must be complete when they are rolled up.
"""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.sources.logstore import PERIOD_COLUMNS

def period_of(log: DataFrame) -> str:
    return next(c for c, _ in PERIOD_COLUMNS.values() if c in log.columns)


def period_states(log: DataFrame, keys: list[str], measure: str, at: str = "TimeStart") -> DataFrame:
    """One row per period and key: runs, total and measured (of ``measure``), latest (of ``at``)."""
    return log.groupBy(period_of(log), *keys).agg(
        F.count(F.lit(1)).alias("runs"), F.sum(F.col(measure).cast("long")).alias("total"),
        F.count(measure).alias("measured"), F.max(at).alias("latest"))


def merged_states(states: DataFrame, *keys: str | Column) -> DataFrame:
    return states.groupBy(*keys).agg(F.sum("runs").alias("runs"), F.sum("total").alias("total"),
                                     F.sum("measured").alias("measured"), F.max("latest").alias("latest"))


def stored_periods(spark: SparkSession, path: str, period: str) -> list[dt.date]:
    """Periods that the rollup at ``path`` holds: its folder names."""
    try:
        return [r[0] for r in spark.read.parquet(path).select(period).distinct().collect()]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def refresh_rollup(log: DataFrame, path: str, keys: list[str], measure: str, at: str = "TimeStart") -> None:
    """Roll up the periods of ``log`` (stored by period) that are not at ``path`` yet."""
    period = period_of(log)
    have = stored_periods(log.sparkSession, path, period)
    fresh = log.where(~F.col(period).isin(have)) if have else log
    (period_states(fresh, keys, measure, at).repartitionByRange(period, *keys).sortWithinPartitions(period, *keys)
     .write.mode("append").partitionBy(period).parquet(path))


def _floor(moment: dt.datetime, period: str) -> dt.date:
    return moment.date() if period == PERIOD_COLUMNS["day"][0] else moment.date().replace(day=1)


def cut_periods(start: dt.datetime | None, end: dt.datetime | None, period: str) -> list[dt.date]:
    """Periods that the closed range [start, end] cuts: the first unless it begins with it, the last unless
    the range goes up to its last microsecond."""
    out = set()
    if start is not None and start != dt.datetime.combine(_floor(start, period), dt.time()):
        out.add(_floor(start, period))
    if end is not None and _floor(end, period) == _floor(end + dt.timedelta.resolution, period):
        out.add(_floor(end, period))
    return sorted(out)


def states_in_range(rollup: DataFrame, log: DataFrame, start: dt.datetime | None, end: dt.datetime | None,
                    keys: list[str], measure: str, at: str = "TimeStart") -> DataFrame:
    """Unmerged states (runs, total, measured, latest by key) of the log's rows with ``at`` in [start, end]."""
    period = period_of(log)
    cut = cut_periods(start, end, period)
    inside = ~F.col(period).isin(cut) if cut else F.lit(True)
    if start is not None:
        inside = inside & (F.col(period) >= F.lit(_floor(start, period)))
    if end is not None:
        inside = inside & (F.col(period) <= F.lit(_floor(end, period)))
    states = rollup.where(inside).select(*keys, "runs", "total", "measured", "latest")
    if not cut:
        return states
    raw = log.where(F.col(period).isin(cut))  # named one by one: a partition filter
    if start is not None:
        raw = raw.where(F.col(at) >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        raw = raw.where(F.col(at) <= F.lit(end).cast("timestamp_ntz"))
    return states.unionByName(period_states(raw, keys, measure, at).drop(period))
