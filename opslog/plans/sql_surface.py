"""SQL surface: the source's views as temp views, and the per-step package
error function as a SQL table function usable with ``LATERAL``.

Spark decorrelates ``LEFT JOIN LATERAL f(t.a, t.b)`` into an ordinary left
equi-join against the set-based result, so the SQL form plans exactly like the
DataFrame form.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from opslog.operators.jobs import last_job_run, last_package_error
from opslog.operators.reports import execution_history, running_now
from opslog.operators.xmlshred import report_queries

PACKAGE_ERROR_FUNCTION = "last_package_error_message"


def register_package_error_function(spark: SparkSession, steps: DataFrame, event_messages: DataFrame,
                                    name: str | None = None) -> str:
    """``name(job_id STRING, step_id INT)`` -> (PackageName, ErrorMessage, RankNum).

    Without a name every call makes a function and view of its own, so that two
    callers in one session do not replace each other's.
    """
    name = name or f"{PACKAGE_ERROR_FUNCTION}_{uuid.uuid4().hex}"
    view = f"{name}_rows"
    last_package_error(steps, event_messages).createOrReplaceTempView(view)
    spark.sql(f"""
CREATE OR REPLACE TEMPORARY FUNCTION {name}(p_job_id STRING, p_step_id INT)
RETURNS TABLE (PackageName STRING, ErrorMessage STRING, RankNum INT)
RETURN SELECT PackageName, ErrorMessage, RankNum FROM {view} WHERE job_id = p_job_id AND step_id = p_step_id""")
    return name


def register_views(spark: SparkSession, *, history: DataFrame, steps: DataFrame, jobs: DataFrame,
                   event_messages: DataFrame, execution_log: DataFrame, catalog: DataFrame,
                   running_jobs: DataFrame, users: DataFrame, domain: str, now=None) -> list[str]:
    """Register the four views and the table function; returns the view names."""
    views = {
        "last_job_run_info": last_job_run(history, steps, jobs),
        "report_execution_history": execution_history(execution_log, catalog, domain),
        "report_queries": report_queries(catalog),
        "reports_currently_running": running_now(running_jobs, users, now=now),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    register_package_error_function(spark, steps, event_messages, PACKAGE_ERROR_FUNCTION)
    return list(views)


def enrich_with_lateral(spark: SparkSession, state: DataFrame, function: str = PACKAGE_ERROR_FUNCTION,
                        subsystem: str = "SSIS") -> DataFrame:
    """The enrichment written as the source writes it: the state OUTER APPLY the
    table function, keeping the old message unless the step is a failed package step."""
    return spark.sql(f"""
SELECT s.InstanceID, s.JobName, s.JobID, s.StepName, s.StepID,
  CASE WHEN s.LastRunOutcome = 0 AND s.SubSystem = '{subsystem}' THEN e.ErrorMessage ELSE s.StepMessage END AS StepMessage,
  s.LastRunOutcome, s.LastRunDateTime, s.LastRunDuration, s.UpdateFlag, s.SubSystem
FROM {{state}} s LEFT JOIN LATERAL {function}(s.JobID, s.StepID) e""", state=state)
