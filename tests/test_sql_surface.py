"""The source's views as temp views and its table function under LATERAL."""

from opslog.plans import params as P
from opslog.plans.registry import Tables
from opslog.plans.sql_surface import register_views

SF = "/root/testdata/sf0.001"


def test_views_and_table_function(spark):
    t = Tables(spark, SF)
    names = register_views(spark, history=t.job_history, steps=t.job_steps, jobs=t.jobs,
                           event_messages=t.event_messages, execution_log=t.execution_log, catalog=t.catalog,
                           running_jobs=t.running_jobs, users=t.users, domain=P.DOMAIN, now=P.NOW)
    assert names == ["last_job_run_info", "report_execution_history", "report_queries", "reports_currently_running"]
    for n in names:
        assert spark.sql(f"SELECT count(*) AS n FROM {n}").first()["n"] > 0
    one = spark.sql("SELECT job_id, step_id FROM last_package_error_message_rows LIMIT 1").first()
    got = spark.sql(f"SELECT * FROM last_package_error_message('{one.job_id}', {one.step_id})").collect()
    assert len(got) >= 1 and got[0]["RankNum"] == 1
    lat = spark.sql("""
        SELECT s.job_id, e.ErrorMessage FROM last_job_run_info s
        LEFT JOIN LATERAL last_package_error_message(s.job_id, s.step_id) e""")
    assert lat.count() == spark.table("last_job_run_info").count()
