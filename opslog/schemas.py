"""Declared schemas of the state tables (the rest are read as they come), and their enforcement on write."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampNTZType

# Failure state: one row per (JobID, StepID). UpdateFlag is 0/1, default 0.
JOB_FAILURES = StructType([
    StructField("InstanceID", LongType(), False),
    StructField("JobName", StringType(), True),
    StructField("JobID", StringType(), True),
    StructField("StepName", StringType(), True),
    StructField("StepID", IntegerType(), True),
    StructField("StepMessage", StringType(), True),
    StructField("LastRunOutcome", IntegerType(), True),
    StructField("LastRunDateTime", TimestampNTZType(), True),
    StructField("LastRunDuration", StringType(), True),
    StructField("UpdateFlag", IntegerType(), False),
    StructField("SubSystem", StringType(), True),
])

# Jobs whose failures are never reported; JobID is the key.
IGNORE_JOBS = StructType([
    StructField("JobName", StringType(), False),
    StructField("JobID", StringType(), False),
])

STATE_COLUMNS = [f.name for f in JOB_FAILURES.fields]

# Column defaults and primary keys of the declared tables.
DEFAULTS = {"UpdateFlag": 0}
IGNORE_JOBS_KEY = ["JobID"]


def conform(df: DataFrame, schema: StructType, key: list[str] | None = None) -> DataFrame:
    """``df`` in the declared layout: a column that is missing or NULL takes its
    default, a NULL in a column declared NOT NULL fails the job, and so does
    a key that occurs twice. Failing is a filter, so no reader can prune it."""
    cols, broken = [], F.lit(False)
    for f in schema.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        c = c.cast(f.dataType)
        if f.name in DEFAULTS:
            c = F.coalesce(c, F.lit(DEFAULTS[f.name]).cast(f.dataType))
        cols.append(c.alias(f.name))
        if not f.nullable:
            broken = broken | F.col(f.name).isNull()
    out = df.select(*cols)
    out = out.filter(F.coalesce(F.when(broken, F.raise_error(F.lit("NULL in a column declared NOT NULL"))).cast("boolean"), F.lit(True)))
    if key:
        out = out.withColumn("__n", F.count(F.lit(1)).over(Window.partitionBy(*key)))
        twice = F.when(F.col("__n") > 1, F.raise_error(F.lit(f"{', '.join(key)} occurs twice"))).cast("boolean")
        out = out.filter(F.coalesce(twice, F.lit(True))).drop("__n")
    return out
