"""Latest run per step and last package error."""

import datetime as dt

from opslog.operators import last_job_run, last_package_error, package_error_for
from tests.conftest import rows

HIST = "instance_id long, job_id string, step_id int, message string"
STEPS = ("job_id string, step_id int, step_name string, subsystem string, command string, last_run_outcome int, "
         "last_run_date int, last_run_time int, last_run_duration int")
JOBS = "job_id string, name string, enabled int"


def test_last_job_run(spark):
    hist = spark.createDataFrame([(1, "j1", 1, "old"), (5, "j1", 1, "new"), (3, "j1", 2, "s2"),
                                  (9, "j2", 1, "guid"), (7, "j3", 1, "off"), (8, "j9", 1, "no step")], HIST)
    steps = spark.createDataFrame([
        ("j1", 1, "a", "TSQL", "", 0, 20240105, 305, 93005),
        ("j1", 2, "b", "SSIS", "", 1, 0, 0, 5),
        ("j2", 1, "c", "TSQL", "", 1, 20240101, 0, 0),
        ("j3", 1, "d", "TSQL", "", 1, 20240101, 0, 0),
    ], STEPS)
    jobs = spark.createDataFrame([("j1", "Nightly", 1), ("j2", "0123456789ABC-DEF0-1234-56789ABCDEF0", 1),
                                  ("j3", "Disabled", 0)], JOBS)
    out = sorted(rows(last_job_run(hist, steps, jobs)), key=lambda r: r["step_id"])
    assert [(r["instance_id"], r["message"], r["step_name"]) for r in out] == [(5, "new", "a"), (3, "s2", "b")]
    assert out[0]["LastRunDateTime"] == dt.datetime(2024, 1, 5, 0, 3, 5)
    assert out[0]["LastRunDuration"] == "09:30:05"
    assert out[1]["LastRunDateTime"] is None and out[1]["LastRunDuration"] == "00:00:05"
    assert out[0]["name"] == "Nightly"


EM = ("operation_id long, event_message_id long, message_time timestamp_ntz, package_name string, "
      "event_name string, message string")


def _steps(spark):
    return spark.createDataFrame([
        ("j1", 1, "s", "SSIS", '/FILE "C:\\ssis\\A.dtsx"', 0, 0, 0, 0),
        ("j2", 1, "s", "SSIS", '/FILE "C:\\ssis\\B.dtsx"', 0, 0, 0, 0),
        ("j3", 1, "s", "SSIS", '/FILE "C:\\ssis\\C.dtsx"', 0, 0, 0, 0),
        ("j4", 1, "s", "TSQL", '/FILE "C:\\ssis\\A.dtsx"', 0, 0, 0, 0),
        ("j5", 1, "s", "SSIS", 'no package here ssis', 0, 0, 0, 0),
    ], STEPS)


def test_last_package_error_rank_semantics(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 0)
    em = spark.createDataFrame([
        # operation 10 runs A and B; the first error of the operation is B's (equal time, lower id)
        (10, 101, t, "A.dtsx", "OnError", "A failed"),
        (10, 100, t, "B.dtsx", "OnError", "B failed first"),
        # C: newest operation 21 has no error -> no row, although operation 20 failed
        (20, 200, t, "C.dtsx", "OnError", "C old failure"),
        (21, 210, t, "C.dtsx", "OnInformation", "C ok"),
        # an older operation of A does not count
        (5, 50, t, "A.dtsx", "OnError", "A ancient"),
    ], EM)
    out = rows(last_package_error(_steps(spark), em))
    assert [(r["job_id"], r["PackageName"], r["ErrorMessage"], r["RankNum"]) for r in out] == [
        ("j2", "B.dtsx", "B failed first", 1)]
    assert rows(package_error_for(last_package_error(_steps(spark), em), "j2", 1))[0]["ErrorMessage"] == "B failed first"


def test_last_package_error_message_cut(spark):
    t = dt.datetime(2024, 1, 1)
    em = spark.createDataFrame([(1, 1, t, "A.dtsx", "OnError", "x" * 5000)], EM)
    out = rows(last_package_error(_steps(spark), em))
    assert len(out) == 1 and len(out[0]["ErrorMessage"]) == 4000


def test_package_names_fold_case_throughout(spark):
    t = dt.datetime(2024, 1, 1)
    em = spark.createDataFrame([(1, 1, t, "A.DTSX", "OnError", "old failure"), (2, 2, t, "a.dtsx", "OnInformation", "ok")], EM)
    assert rows(last_package_error(_steps(spark), em, case_sensitive=False)) == []
    em = spark.createDataFrame([(1, 1, t, "a.dtsx", "OnInformation", "ok"), (2, 2, t, "A.DTSX", "onerror", "failed")], EM)
    assert [r["ErrorMessage"] for r in rows(last_package_error(_steps(spark), em, case_sensitive=False))] == ["failed"]
