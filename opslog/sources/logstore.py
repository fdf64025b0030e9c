"""Time-partitioned storage for large logs.

A log written with ``write_by_period`` is laid out as ``<path>/log_day=YYYY-MM-DD/``
(or ``log_month=YYYY-MM-01`` for sparse logs). The time-range operators add the
period predicate implied by their timestamp predicate whenever the log has one
of these columns, so a range reads only its folders (partition pruning),
besides the row-group skipping the timestamp predicate gets from parquet
statistics.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opslog.functions.ties import tie_breaker

# partition column per granularity, and the truncation unit it stands for
PERIOD_COLUMNS = {"day": ("log_day", None), "month": ("log_month", "MM")}


def _period_start(ts: Column, unit: str | None) -> Column:
    d = F.to_date(ts)
    return d if unit is None else F.trunc(d, unit)


def write_by_period(df: DataFrame, path: str, ts_col: str, granularity: str = "day",
                    mode: str = "errorifexists") -> None:
    """Write ``df`` partitioned by the day (or month) of ``ts_col``.

    Rows are range-partitioned on (period, time, a hash of the rest): each task
    gets a contiguous slice of periods, so it writes few folders, and a period
    holding a large share of the log is cut into many slices (hash
    partitioning on the period would give that whole period to one task).
    Each file is sorted by time, which keeps parquet min/max statistics tight.
    """
    col, unit = PERIOD_COLUMNS[granularity]
    out = df.withColumn(col, _period_start(F.col(ts_col), unit))
    out.repartitionByRange(col, ts_col, tie_breaker(out, col, ts_col)).sortWithinPartitions(col, ts_col) \
        .write.mode(mode).partitionBy(col).parquet(path)


def period_bounds(df: DataFrame, lo: Column | None = None, hi: Column | None = None) -> Column:
    """Predicate on the period partition implied by ``lo <= ts <= hi`` (TRUE when
    the frame has no period column, so it can always be and-ed in)."""
    cond = F.lit(True)
    for col, unit in PERIOD_COLUMNS.values():
        if col in df.columns:
            if lo is not None:
                cond = cond & (F.col(col) >= _period_start(lo, unit))
            if hi is not None:
                cond = cond & (F.col(col) <= _period_start(hi, unit))
    return cond
