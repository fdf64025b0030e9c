"""Global sorts that stay balanced when one sort value holds many rows."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from opslog.functions.text import text_key
from opslog.functions.ties import tie_breaker
from opslog.session import scratch_path


def sort_balanced(df: DataFrame, *keys: Column | str, ordered: bool = True, case_sensitive: bool = True) -> DataFrame:
    """``orderBy(*keys)`` with one hash of the remaining columns as the tie-breaker.

    A global sort range-partitions on sampled bounds of the sort key; rows with
    equal keys always land in one partition, so a value held by a third of
    the rows would be sorted by one task. With a tie-breaker the bounds can
    fall inside such a run of equal keys and split it. The sample that Spark
    collects for the bounds holds the asked keys and one long a row, never a
    document or message column. The order asked for is unchanged (ties had no
    order). ``ordered=False`` leaves the sort out, for callers that write to an
    unordered store. ``case_sensitive=False`` sorts text keys under the collation.
    """
    if not ordered:
        return df
    named = {k for k in keys if isinstance(k, str)}
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    cols = [k if isinstance(k, Column) else text_key(k, case_sensitive) if k in text else F.col(k) for k in keys]
    return df.orderBy(*cols, tie_breaker(df, *named))


def numbered(df: DataFrame, *keys: Column | str, name: str = "line_no") -> DataFrame:
    """``df`` with every row's place, from 1, in the order of ``keys``.

    The keys must order the rows totally (rows equal in all of them get places in no
    set order among themselves); further keys after the wanted ones also let a
    range boundary fall inside a value that many rows hold. Rows are dealt to key
    ranges, sorted there and written to the shared folder with their place in their
    range; the ranges' row counts (one number a range, the only thing that reaches
    the driver) give what comes before each. So no task holds more than its
    range, and the places are as durable as the written table.
    """
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "numbered", uuid.uuid4().hex)
    # monotonically_increasing_id is the task's number times 2^33, plus the row's place in the task
    (df.repartitionByRange(ranges, *keys).sortWithinPartitions(*keys)
     .withColumn("_at", F.monotonically_increasing_id()).write.parquet(path))
    rows = spark.read.parquet(path).withColumn("_range", F.shiftright("_at", 33))
    before, total = [], 0
    for r in sorted(rows.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()):
        before.append((r["_range"], total))
        total += r["n"]
    starts = F.broadcast(spark.createDataFrame(before, "_range long, _before long"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return rows.join(starts, "_range").select(*(F.col(f"`{c}`") for c in df.columns), place.alias(name))
