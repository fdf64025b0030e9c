"""Report -> subscription -> agent job -> job step link."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.functions.temporal import coded_datetime
from opslog.functions.text import text_key
from opslog.functions.xmlvalue import xml_first_text
from opslog.operators.ordering import sort_balanced
from opslog.operators.xmlshred import FIRST_SETTING_PATH


def subscription_jobs(report_schedule: DataFrame, jobs: DataFrame, job_steps: DataFrame,
                      subscriptions: DataFrame, catalog: DataFrame, ordered: bool = True) -> DataFrame:
    """Each report subscription with the agent job that runs its schedule (the
    job is named after the schedule id, compared as the source's collation does:
    without case and trailing blanks), the
    job's steps' last run time and the first setting value."""
    r = report_schedule.select(text_key(F.col("ScheduleID").cast("string"), False).alias("_sched"),
                               F.col("SubscriptionID").alias("_r_sub"))
    j = jobs.select(F.col("job_id").alias("_jid"), text_key("name", False).alias("_jname"),
                    F.col("name").alias("JobName"),
                    F.col("date_created").alias("Date_Created"), F.col("date_modified").alias("Date_Modified"))
    sjs = job_steps.select(F.col("job_id").alias("_sjs_jid"),
                           coded_datetime("last_run_date", "last_run_time").alias("LastRunDateTime"))
    s = subscriptions.select(F.col("SubscriptionID").alias("_sub"), "Report_OID", "ExtensionSettings")
    c = catalog.select(F.col("ItemID").alias("_item"), F.col("Name").alias("ReportName"),
                       F.col("Path").alias("ReportPath"))
    # the extraction comes after the joins that cut the subscriptions to scheduled ones with a job, and
    # before the job steps multiply them: one per subscription and job. It has a stage of its own: the
    # documents are dealt to all tasks before it, and the exchange after it keeps the sort's sampling off it
    spread = int(subscriptions.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    scheduled = (
        r.join(j, F.col("_sched") == F.col("_jname"), "inner")
        .join(s, F.col("_r_sub") == F.col("_sub"), "inner")
        .repartition(spread, "_sub")
        .select("JobName", "Date_Created", "Date_Modified", "_jid", "Report_OID", F.explode(F.array(
            xml_first_text(F.col("ExtensionSettings"), FIRST_SETTING_PATH))).alias("ExtSettingsXML"))
        .repartition("_jid")
    )
    out = (
        scheduled.join(sjs, F.col("_jid") == F.col("_sjs_jid"), "inner")
        .join(c, F.col("Report_OID") == F.col("_item"), "inner")
    )
    out = out.select(
        "ReportName", "ReportPath", "JobName", "Date_Created", "Date_Modified",
        "ExtSettingsXML", "LastRunDateTime",
    )
    return sort_balanced(out, "ReportName", "LastRunDateTime", ordered=ordered)
