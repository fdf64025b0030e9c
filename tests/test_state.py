"""Failure-state sequence: insert, unchanged, changed, vanished,
ignored, enriched, NULL key, duplicate source key; report; notification runs."""

import datetime as dt
import glob
import os
import tempfile

import pytest

from opslog.operators import (acknowledge, enrich_failures, failure_report, merge_state, new_failures,
                              suppress_ignored, to_state_rows)
from opslog.plans.notification import run_failure_notification
from opslog.schemas import JOB_FAILURES
from opslog.sources.snapshots import SnapshotStore
from tests.conftest import rows

LAST = ("instance_id long, name string, job_id string, step_name string, step_id int, message string, "
        "last_run_outcome int, LastRunDateTime timestamp_ntz, LastRunDuration string, subsystem string")
T1 = dt.datetime(2024, 1, 1, 1, 0, 0)
T2 = dt.datetime(2024, 1, 2, 1, 0, 0)


def last(spark, data):
    return spark.createDataFrame(data, LAST)


def state_of(spark, data):
    return to_state_rows(last(spark, data), 0)


def by_key(df):
    return {(r["JobID"], r["StepID"]): r for r in rows(df)}


def test_merge_three_way(spark):
    prev = state_of(spark, [
        (1, "same", "j1", "s", 1, "m1", 1, T1, "00:00:01", "TSQL"),
        (2, "chg", "j2", "s", 1, "m2", 1, T1, "00:00:02", "TSQL"),
        (3, "gone", "j3", "s", 1, "m3", 1, T1, "00:00:03", "TSQL"),
        (4, "nokey", None, "s", 1, "m4", 1, T1, "00:00:04", "TSQL"),
    ])
    src = last(spark, [
        (1, "same", "j1", "s", 1, "m1", 1, T1, "00:00:01", "TSQL"),
        (22, "chg2", "j2", "s", 1, "m22", 0, T2, "09:09:09", "SSIS"),
        (5, "new", "j5", "s", 1, "m5", 0, T2, "00:00:05", "TSQL"),
    ])
    out = by_key(merge_state(prev, src))
    assert set(out) == {("j1", 1), ("j2", 1), ("j5", 1)}
    assert out[("j1", 1)]["UpdateFlag"] == 0 and out[("j1", 1)]["InstanceID"] == 1
    c = out[("j2", 1)]
    assert (c["InstanceID"], c["JobName"], c["StepMessage"], c["LastRunOutcome"], c["SubSystem"], c["UpdateFlag"]) == (
        22, "chg2", "m22", 0, "SSIS", 1)
    assert c["LastRunDuration"] == "00:00:02"  # not refreshed on update
    assert merge_state(prev, src, refresh_duration=True).filter("JobID = 'j2'").first()["LastRunDuration"] == "09:09:09"
    assert out[("j5", 1)]["UpdateFlag"] == 1 and out[("j5", 1)]["LastRunDuration"] == "00:00:05"


def test_merge_duplicate_source_key_raises(spark):
    prev = state_of(spark, [(1, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL")])
    src = last(spark, [(2, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL"), (3, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL")])
    with pytest.raises(Exception, match="several source rows"):
        merge_state(prev, src).collect()


def test_suppress_enrich_select_report(spark):
    st = to_state_rows(last(spark, [
        (10, "A & B", "j1", "load<1>", 1, "orig", 0, T2, "00:01:00", "SSIS"),
        (11, "ignored", "j2", "s", 1, "orig", 0, T2, "00:01:00", "TSQL"),
        (12, "pkg none", "j3", "s", 1, "orig", 0, T2, "00:01:00", "SSIS"),
        (13, "ok", "j4", "s", 1, "fine", 1, T2, "00:01:00", "SSIS"),
        (14, "never", "j5", "s", 1, "x", 0, None, "00:00:00", "TSQL"),
    ]), 1)
    ignore = spark.createDataFrame([("ignored", "j2")], "JobName string, JobID string")
    s2 = suppress_ignored(st, ignore)
    assert by_key(s2)[("j2", 1)]["UpdateFlag"] == 0 and by_key(s2)[("j1", 1)]["UpdateFlag"] == 1
    pe = spark.createDataFrame([("j1", 1, "A.dtsx", "boom", 1), ("j4", 1, "B.dtsx", "old", 1)],
                               "job_id string, step_id int, PackageName string, ErrorMessage string, RankNum int")
    s3 = by_key(enrich_failures(s2, pe))
    assert s3[("j1", 1)]["StepMessage"] == "boom"
    assert s3[("j3", 1)]["StepMessage"] is None  # failed package step, nothing found -> NULL
    assert s3[("j4", 1)]["StepMessage"] == "fine"  # succeeded: untouched
    enriched = enrich_failures(s2, pe)
    assert [r["JobID"] for r in rows(new_failures(enriched))] == ["j1", "j3"]
    lines = sorted(rows(failure_report(enriched, "SRV")), key=lambda r: (r["part"], r["JobName"] or ""))
    assert [l["part"] for l in lines] == [0, 1, 1, 2]
    assert lines[0]["html"].startswith('<H1 align="center" style="font-family:Cambria;">SRV Job Failure Report</H1>')
    assert lines[1]["html"] == ("<tr><td>A &amp; B</td><td>load&lt;1&gt;</td><td>boom</td>"
                                "<td>2024-01-02 01:00:00</td><td>00:01:00</td></tr>")
    # a NULL message leaves its cell out, as the source's serialisation does
    assert lines[2]["html"] == "<tr><td>pkg none</td><td>s</td><td>2024-01-02 01:00:00</td><td>00:01:00</td></tr>"
    assert "<td></td>" in [l for l in rows(failure_report(enriched, "SRV", empty_null_cells=True)) if l["JobName"] == "pkg none"][0]["html"]
    assert lines[3]["html"] == "</table>"
    assert rows(failure_report(acknowledge(enriched), "SRV")) == []


def test_notification_three_runs(spark):
    root = tempfile.mkdtemp(prefix="opslog-pipe-")
    store = SnapshotStore(spark, os.path.join(root, "state"), JOB_FAILURES)
    hist_s = "instance_id long, job_id string, step_id int, message string"
    steps_s = ("job_id string, step_id int, step_name string, subsystem string, command string, "
               "last_run_outcome int, last_run_date int, last_run_time int, last_run_duration int")
    jobs = spark.createDataFrame([("j1", "Job one", 1), ("j2", "Job two", 1)], "job_id string, name string, enabled int")
    em = spark.createDataFrame([], "operation_id long, event_message_id long, message_time timestamp_ntz, "
                                   "package_name string, event_name string, message string")
    ignore = spark.createDataFrame([], "JobName string, JobID string")

    def run(hist, steps):
        return run_failure_notification(
            spark, store, history=spark.createDataFrame(hist, hist_s), steps=spark.createDataFrame(steps, steps_s),
            jobs=jobs, event_messages=em, ignore=ignore, report_root=os.path.join(root, "reports"), server="S")

    steps = [("j1", 1, "a", "TSQL", "", 0, 20240101, 10000, 5), ("j2", 1, "b", "TSQL", "", 1, 20240101, 0, 5)]
    r1 = run([(1, "j1", 1, "fail"), (2, "j2", 1, "ok")], steps)
    assert r1["report_path"] is not None and (r1["state_version"], r1["final_version"]) == (1, 2)
    text = "".join(open(f).read() for f in sorted(glob.glob(os.path.join(r1["report_path"], "part-*"))))
    assert "<td>Job one</td>" in text and text.rstrip().endswith("</table>")
    assert all(r["UpdateFlag"] == 0 for r in rows(store.read()))
    r2 = run([(1, "j1", 1, "fail"), (2, "j2", 1, "ok")], steps)  # nothing new
    assert r2["report_path"] is None
    r3 = run([(1, "j1", 1, "fail"), (3, "j1", 1, "fail again")], steps[:1])  # j2 vanished, j1 failed again
    assert r3["report_path"] is not None
    assert [(r["JobID"], r["InstanceID"]) for r in rows(store.read())] == [("j1", 3)]
    assert store.versions() == [1, 2, 3, 4, 5, 6]


def test_run_notification_entry_point(spark):
    from opslog.plans.registry import Tables
    from opslog.plans.run_notification import main

    root = tempfile.mkdtemp(prefix="opslog-entry-")
    t = Tables(spark, "/root/testdata/sf0.001")
    args = []
    for name, df in [("history", t.job_history), ("steps", t.job_steps), ("jobs", t.jobs),
                     ("event-messages", t.event_messages), ("ignore", t.ignore_jobs)]:
        path = os.path.join(root, name)
        df.write.parquet(path)
        args += [f"--{name}", path]
    args += ["--server", "S", "--state-root", os.path.join(root, "state"), "--report-root", os.path.join(root, "rep")]
    first = main(args, spark)
    second = main(args, spark)
    assert (first["state_version"], first["final_version"]) == (1, 2)
    assert first["report_path"] is not None and second["report_path"] is None  # nothing new the second time
    assert second["final_version"] == 4


def test_merge_updates_both_rows_of_a_key_the_state_holds_twice(spark):
    prev = state_of(spark, [(1, "a", "j1", "s", 1, "m", 1, T1, "d1", "TSQL"), (2, "a", "j1", "s", 1, "m", 1, T1, "d2", "TSQL")])
    src = last(spark, [(3, "a", "j1", "s", 1, "new", 1, T2, "d", "TSQL")])
    out = rows(merge_state(prev, src))
    assert sorted((r["InstanceID"], r["StepMessage"], r["LastRunDuration"]) for r in out) == [(3, "new", "d1"), (3, "new", "d2")]


def test_merge_duplicate_is_seen_by_a_reader_of_one_column(spark):
    prev = state_of(spark, [(1, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL")])
    src = last(spark, [(2, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL"), (3, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL")])
    with pytest.raises(Exception, match="several source rows"):
        merge_state(prev, src).select("JobName").collect()


def test_report_keeps_equal_failures_and_escapes_returns(spark):
    st = to_state_rows(last(spark, [(7, "n", "j1", "s", 1, "a\r\nb", 0, T2, "d", "TSQL"), (7, "n", "j2", "s", 2, "a\r\nb", 0, T2, "d", "TSQL")]))
    lines = rows(failure_report(st, "S"))
    assert sorted(l["part"] for l in lines) == [0, 1, 1, 2]
    assert all("a&#x0D;\nb" in l["html"] for l in lines if l["part"] == 1)


def test_declared_schema_is_enforced_on_write(spark):
    from pyspark.sql import functions as F

    from opslog.schemas import IGNORE_JOBS, IGNORE_JOBS_KEY

    root = tempfile.mkdtemp(prefix="opslog-schema-")
    store = SnapshotStore(spark, os.path.join(root, "state"), JOB_FAILURES, retain=2)
    st = state_of(spark, [(1, "a", "j1", "s", 1, "m", 1, T1, "d", "TSQL")])
    store.write(st.withColumn("UpdateFlag", F.lit(None).cast("int")))
    assert [r["UpdateFlag"] for r in rows(store.read())] == [0]
    with pytest.raises(Exception, match="NOT NULL"):
        store.write(st.withColumn("InstanceID", F.lit(None).cast("long")))
    for _ in range(3):
        store.write(st)
    assert len(store.versions()) == 2 and store.read().count() == 1
    ignore = SnapshotStore(spark, os.path.join(root, "ignore"), IGNORE_JOBS, key=IGNORE_JOBS_KEY)
    ignore.write(spark.createDataFrame([("n", "j1"), ("n", "j2")], "JobName string, JobID string"))
    with pytest.raises(Exception, match="occurs twice"):
        ignore.write(spark.createDataFrame([("n", "j1"), ("m", "j1")], "JobName string, JobID string"))


def test_entry_point_requires_its_folders():
    from opslog.plans.run_notification import main

    with pytest.raises(SystemExit):
        main(["--history", "h", "--steps", "s", "--jobs", "j", "--event-messages", "e", "--ignore", "i", "--server", "S"])


def test_shared_folder_is_asked_for_on_a_cluster():
    from types import SimpleNamespace

    from opslog.session import checkpoint_dir

    made = []
    ctx = SimpleNamespace(master="spark://host:7077", applicationId="a", getCheckpointDir=lambda: None, setCheckpointDir=made.append)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(SimpleNamespace(sparkContext=ctx, conf={}))
    ctx.master = "local[2]"
    one = checkpoint_dir(SimpleNamespace(sparkContext=ctx, conf={}))
    assert made == [one] and checkpoint_dir(SimpleNamespace(sparkContext=ctx, conf={})) == one
