"""Rollup states against the raw log, for ranges that cut periods, hold them whole, or lie within one."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from opslog.operators import report_stats, report_stats_from_rollup, runs_per_user, runs_per_user_from_rollup
from opslog.sources.logstore import write_by_period
from opslog.sources.rollup import cut_periods, refresh_rollup, states_in_range


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("rollup"))
    rows = [(i % 7, f"u{i % 5}" if i % 11 else None, None if i % 13 == 0 else i,
             dt.datetime(2024, 1, 1) + dt.timedelta(minutes=37 * i)) for i in range(600)]
    rows += [(1, "u1", 5, dt.datetime(2024, 1, 3)), (1, "u1", 5, dt.datetime(2024, 1, 3, 23, 59, 59, 999999))]
    log = spark.createDataFrame(rows, "ReportID long, UserName string, TimeProcessing int, TimeStart timestamp_ntz")
    write_by_period(log.where("TimeStart < '2024-01-05'"), f"{root}/log", "TimeStart")
    for part, key in (("by_report", "ReportID"), ("by_user", "UserName")):
        refresh_rollup(spark.read.parquet(f"{root}/log"), f"{root}/{part}", [key], "TimeProcessing")
    write_by_period(log.where("TimeStart >= '2024-01-05'"), f"{root}/log", "TimeStart", mode="append")
    stored = spark.read.parquet(f"{root}/log")
    for part, key in (("by_report", "ReportID"), ("by_user", "UserName")):
        refresh_rollup(stored, f"{root}/{part}", [key], "TimeProcessing")  # adds the new days only
    catalog = spark.createDataFrame([(i, f"r{i % 4}") for i in range(6)], "ItemID long, Name string")
    return log, stored, spark.read.parquet(f"{root}/by_report"), spark.read.parquet(f"{root}/by_user"), catalog


def same(a, b):
    assert sorted(map(str, map(tuple, a.collect()))) == sorted(map(str, map(tuple, b.collect())))


RANGES = [("2024-01-02 05:00:00", "2024-01-09 10:30:00"), ("2024-01-03 00:00:00", "2024-01-03 23:59:59.999999"),
          ("2024-01-03 00:00:00", "2024-01-04 00:00:00"), ("2024-01-03 04:00:00", "2024-01-03 20:00:00"),
          ("2024-01-03 04:00:00", "2024-01-04 03:00:00"), ("2023-01-01 00:00:00", "2025-01-01 00:00:00"),
          ("2025-01-01 00:00:00", "2026-01-01 00:00:00"), ("2024-01-09 00:00:00", "2024-01-02 00:00:00")]


@pytest.mark.parametrize("start,end", RANGES)
def test_runs_per_user(stored, start, end):
    log, by_day, _, rollup, _ = stored
    same(runs_per_user_from_rollup(rollup, by_day, start, end), runs_per_user(log, start, end))


@pytest.mark.parametrize("since", ["2024-01-03 00:00:00", "2024-01-03 12:00:01", "2020-01-01 00:00:00", "2030-01-01 00:00:00"])
def test_report_stats(stored, since):
    log, by_day, rollup, _, catalog = stored
    same(report_stats_from_rollup(rollup, by_day, catalog, since), report_stats(log, catalog, since))


def test_raw_rows_are_read_of_cut_days_only(stored):
    _, by_day, rollup, _, _ = stored
    lo, hi = dt.datetime(2024, 1, 2, 5), dt.datetime(2024, 1, 9, 10, 30)
    assert cut_periods(lo, hi, "log_day") == [dt.date(2024, 1, 2), dt.date(2024, 1, 9)]
    raw = by_day.where(F.col("log_day").isin(cut_periods(lo, hi, "log_day")))
    assert {r[0] for r in raw.select("log_day").distinct().collect()} == {dt.date(2024, 1, 2), dt.date(2024, 1, 9)}
    plan = states_in_range(rollup, by_day, lo, hi, ["ReportID"], "TimeProcessing")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2 and plan.count("log_day") > 2 and "PartitionFilters: []" not in plan


def test_months():
    at = dt.datetime
    assert cut_periods(at(2024, 1, 1), at(2024, 2, 29, 23, 59, 59, 999999), "log_month") == []
    assert cut_periods(at(2024, 1, 1, 1), at(2024, 3, 1), "log_month") == [dt.date(2024, 1, 1), dt.date(2024, 3, 1)]
    assert cut_periods(at(2024, 1, 2), at(2024, 1, 3), "log_month") == [dt.date(2024, 1, 1)]
