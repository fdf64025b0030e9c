"""Bucketed tables for joins that would otherwise shuffle the log.

When the catalog is too large to broadcast, ``execution_history`` and the
other log/catalog joins shuffle the whole log on ``ReportID``. Writing the log
bucketed on ``ReportID`` and the catalog bucketed on ``ItemID`` with the same
bucket count makes the join read matching buckets side by side: no exchange
on either side (checked in ``tests/test_plans.py``). The tables live in the
session catalog (``spark.sql.warehouse.dir`` on the cluster).
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int, sort: bool = True,
                  mode: str = "errorifexists") -> None:
    """Save ``df`` as a parquet table bucketed (and sorted within buckets) on ``key``.

    Pick ``buckets`` so one bucket of the larger side is a few hundred MB;
    both sides of a join must use the same count.
    """
    w = df.write.mode(mode).format("parquet").bucketBy(buckets, key)
    if sort:
        w = w.sortBy(key)
    w.saveAsTable(table)
