"""Newest run of every job step, kept up to date from the new folders of the history only.

The stored state has one row per (job_id, step_id): the newest instance and its
message. A refresh reads the history folders (``log_day`` or ``log_month``, see
``opslog.sources.logstore``) above the high-water mark, takes their newest
instance per step and puts those that are newer than the stored ones; the mark is
committed in the same manifest. Folders must be complete when they are read:
rows added later to a folder at or below the mark are not seen.

As the stored rows are the history's newest ones, ``last_job_run`` over them
equals ``last_job_run`` over the whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from opslog.sources.buckets import BucketStore
from opslog.sources.logstore import PERIOD_COLUMNS

NEWEST_RUNS = StructType([
    StructField("job_id", StringType()), StructField("step_id", IntegerType()),
    StructField("instance_id", LongType()), StructField("message", StringType())])
NEWEST_KEY = ["job_id", "step_id"]
MARK = "read_up_to"


def newest_store(spark: SparkSession, root: str, buckets: int = 64) -> BucketStore:
    return BucketStore(spark, root, NEWEST_RUNS, NEWEST_KEY, buckets)


def newest_runs(history: DataFrame) -> DataFrame:
    """The row of the greatest instance per (job_id, step_id): a narrow aggregate, joined back for the message."""
    top = history.groupBy(*NEWEST_KEY).agg(F.max("instance_id").alias("instance_id"))
    same = [F.col(f"h.{k}").eqNullSafe(F.col(f"t.{k}")) for k in NEWEST_KEY] + [F.col("h.instance_id") == F.col("t.instance_id")]
    return history.alias("h").join(top.alias("t"), same, "left_semi").select("job_id", "step_id", "instance_id", "message")


def period_column(history: DataFrame) -> str:
    return next(c for c, _ in PERIOD_COLUMNS.values() if c in history.columns)


def folders_above(history: DataFrame, mark: str | None) -> DataFrame:
    """The rows of period folders above the mark: a partition filter, so older folders are not listed as input."""
    return history if mark is None else history.filter(F.col(period_column(history)) > F.lit(mark).cast("date"))


def refresh_newest(store: BucketStore, history: DataFrame) -> int | None:
    """Fold the folders above the mark into the store; returns the version, or None without a new folder.

    ``history``: the stored log, with its period column, instance_id, job_id, step_id and message.
    """
    base = store.latest()
    mark = store.notes(base).get(MARK) if base else None
    fresh = folders_above(history, mark)
    top = fresh.agg(F.max(period_column(history))).first()[0]  # answered from the folder names
    if top is None:
        return None
    new = newest_runs(fresh.where(F.col("instance_id").isNotNull()))
    known = store.read(base).select("job_id", "step_id", F.col("instance_id").alias("_known"))
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"k.{k}")) for k in NEWEST_KEY]
    newer = (new.alias("n").join(known.alias("k"), same, "left").where("_known IS NULL OR instance_id > _known")
             .select("n.*", F.lit("put").alias("_op")))
    return store.apply(newer, base, {MARK: str(top)})
