"""Copy-on-write state by key bucket: what a commit rewrites, concurrent writers, replayed batches."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from opslog.operators.newest import MARK, folders_above, newest_store, refresh_newest
from opslog.plans.notification import DONE, run_failure_notification_once
from opslog.schemas import JOB_FAILURES
from opslog.sources.buckets import BucketStore, ConcurrentCommit
from opslog.sources.logstore import write_by_period

SCHEMA = "job string, step int, value string"


def store_in(spark, path, buckets=8, retain=20):
    return BucketStore(spark, str(path), spark.createDataFrame([], SCHEMA).schema, ["job", "step"], buckets, retain)


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(df):
    return sorted(map(str, map(tuple, df.collect())))


def test_a_commit_rewrites_only_the_buckets_of_changed_keys(spark, tmp_path):
    store = store_in(spark, tmp_path)
    assert store.read().count() == 0 and store.latest() is None
    rows = [(f"j{i}", i % 3, "a") for i in range(200)] + [(None, None, "null key")]
    v1 = store.commit(table(spark, rows), None)
    changed = [(j, s, "b" if j == "j7" else v) for j, s, v in rows if j != "j8"] + [("new", 1, "c")]
    v2 = store.commit(table(spark, changed), v1)
    assert content(store.read(v1)) == content(table(spark, rows))
    assert content(store.read(v2)) == content(table(spark, changed))
    a, b = store.manifest(v1), store.manifest(v2)
    keys = table(spark, [("j7", 1, ""), ("j8", 2, ""), ("new", 1, "")]).select(store.bucket_of(8).alias("b")).collect()
    assert b["touched"] == sorted({r.b for r in keys})
    assert {k for k in a["buckets"] if a["buckets"][k] != b["buckets"].get(k)} == {str(x) for x in b["touched"]}
    # the last commit's folder holds those buckets and nothing else
    write = b["buckets"][str(b["touched"][0])].split("/")[0]
    assert {os.path.basename(p) for p in glob.glob(f"{tmp_path}/data/{write}/bucket=*")} == {f"bucket={x}" for x in b["touched"]}


def test_no_change_writes_no_bucket_and_all_gone_leaves_none(spark, tmp_path):
    store = store_in(spark, tmp_path)
    rows = [(f"j{i}", 1, "a") for i in range(20)]
    v1 = store.commit(table(spark, rows), None)
    v2 = store.commit(table(spark, rows), v1, {"mark": "x"})
    assert store.manifest(v2)["touched"] == [] and store.notes() == {"mark": "x"}
    v3 = store.commit(table(spark, []), v2)
    assert store.read(v3).count() == 0 and store.manifest(v3)["buckets"] == {} and store.notes(v3) == {"mark": "x"}


def test_of_two_writers_one_fails_cleanly(spark, tmp_path):
    one, two = store_in(spark, tmp_path), store_in(spark, tmp_path)
    base = one.commit(table(spark, [("a", 1, "0"), ("b", 1, "0")]), None)
    one.commit(table(spark, [("a", 1, "one"), ("b", 1, "0")]), base)
    with pytest.raises(ConcurrentCommit):
        two.commit(table(spark, [("a", 1, "two"), ("b", 1, "0")]), base)
    assert two.versions() == [1, 2] and content(two.read()) == ["('a', 1, 'one')", "('b', 1, '0')"]
    assert not [p for p in os.listdir(tmp_path / "manifests") if p.startswith(".") and not p.endswith(".crc")]
    two.commit(table(spark, [("a", 1, "two"), ("b", 1, "0")]), two.latest())  # from the new base it goes through
    assert content(one.read()) == ["('a', 1, 'two')", "('b', 1, '0')"]


def test_a_key_twice_is_refused_and_old_versions_go(spark, tmp_path):
    store = store_in(spark, tmp_path, retain=2)
    with pytest.raises(Exception, match="occurs twice"):
        store.commit(table(spark, [("a", 1, "x"), ("a", 1, "y")]), None)
    version = None
    for k in range(4):
        version = store.commit(table(spark, [("a", 1, str(k))]), version)
    assert store.versions() == [3, 4] and content(store.read(3)) == ["('a', 1, '2')"]


def run_tables(spark, instance, outcome=0):
    return dict(
        history=spark.createDataFrame([(instance, "j1", 1, "failed")], "instance_id long, job_id string, step_id int, message string"),
        steps=spark.createDataFrame([("j1", 1, "a", "TSQL", "", outcome, 20240101, 0, 5)],
                                    "job_id string, step_id int, step_name string, subsystem string, command string, "
                                    "last_run_outcome int, last_run_date int, last_run_time int, last_run_duration int"),
        jobs=spark.createDataFrame([("j1", "Job one", 1)], "job_id string, name string, enabled int"),
        event_messages=spark.createDataFrame([], "operation_id long, event_message_id long, message_time timestamp_ntz, "
                                                 "package_name string, event_name string, message string"),
        ignore=spark.createDataFrame([], "JobName string, JobID string"))


def test_a_replayed_batch_neither_writes_nor_reports_twice(spark, tmp_path, monkeypatch):
    from opslog.plans import notification

    store = BucketStore(spark, str(tmp_path / "state"), JOB_FAILURES, ["JobID", "StepID"], 4)
    reports = str(tmp_path / "reports")

    def run(batch, instance):
        return run_failure_notification_once(spark, store, batch, report_root=reports, server="S", **run_tables(spark, instance))

    first = run(0, 1)
    assert (first["state_version"], first["final_version"]) == (1, 2) and os.listdir(reports) == ["batch-00000000"]
    assert run(0, 1) == {"state_version": None, "final_version": None, "report_path": None}
    assert store.versions() == [1, 2]
    # a run that stops between the report and the acknowledgement: the batch that comes again goes on from there
    def stop(*_args, **_kw):
        raise RuntimeError("stopped")
    with monkeypatch.context() as m:
        m.setattr(notification, "acknowledge", stop)
        with pytest.raises(RuntimeError, match="stopped"):
            run(1, 2)
    assert store.versions() == [1, 2, 3] and store.notes()[DONE] == 0
    again = run(1, 2)
    assert (again["state_version"], again["final_version"]) == (3, 4)
    assert sorted(os.listdir(reports)) == ["batch-00000000", "batch-00000001"]
    assert [r.UpdateFlag for r in store.read().collect()] == [0]
    assert run(2, 2)["report_path"] is None  # nothing new, nothing reported


def test_polling_with_a_bucket_store(spark, tmp_path):
    from opslog.streaming import start_failure_polling

    ticks = str(tmp_path / "ticks")
    spark.createDataFrame([(1,)], "tick int").write.parquet(ticks)
    store = BucketStore(spark, str(tmp_path / "state"), JOB_FAILURES, ["JobID", "StepID"], 4)

    def poll():
        q = start_failure_polling(spark, spark.readStream.schema("tick int").parquet(ticks), lambda: run_tables(spark, 1), store,
                                  str(tmp_path / "reports"), "S", str(tmp_path / "chk"), available_now=True)
        q.awaitTermination(120)

    poll()
    assert store.versions() == [1, 2] and store.notes()[DONE] == 0
    # the stream's own record of the finished batch is lost: it runs the batch again
    for name in os.listdir(tmp_path / "chk" / "commits"):
        os.remove(tmp_path / "chk" / "commits" / name)
    poll()
    assert store.versions() == [1, 2] and os.listdir(tmp_path / "reports") == ["batch-00000000"]


def test_newest_runs_read_only_new_folders(spark, tmp_path):
    path, store = str(tmp_path / "history"), newest_store(spark, str(tmp_path / "state"), 4)
    rows = [(i, f"j{i % 5}", i % 2, f"m{i}", f"2024-01-{1 + i // 10:02d} 08:00:00") for i in range(60)]
    df = spark.createDataFrame(rows, "instance_id long, job_id string, step_id int, message string, ts string").withColumn(
        "ts", F.col("ts").cast("timestamp_ntz"))
    for lo, hi in ((1, 2), (3, 4), (5, 6)):
        write_by_period(df.where(F.dayofmonth("ts").between(lo, hi)), path, "ts", mode="append")
        history = spark.read.parquet(path)
        mark = store.notes().get(MARK) if store.latest() else None
        fresh = folders_above(history, mark)
        assert {f.split("log_day=")[1][:10] for f in fresh.inputFiles()} <= {f"2024-01-{d:02d}" for d in range(1, 7)}
        days = {str(r[0]) for r in fresh.select("log_day").distinct().collect()}
        assert days == {f"2024-01-{d:02d}" for d in (lo, hi)}
        assert mark is None or f"log_day > {mark}" in fresh._jdf.queryExecution().executedPlan().toString().replace("#", " ") \
            or "PartitionFilters" in fresh._jdf.queryExecution().executedPlan().toString()
        refresh_newest(store, history)
        want = {}
        for i, j, s, m, _ in (r for r in rows if int(r[4][8:10]) <= hi):
            want[j, s] = max(want.get((j, s), (-1, "")), (i, m))
        assert {(r.job_id, r.step_id): (r.instance_id, r.message) for r in store.read().collect()} == want
    assert store.notes()[MARK] == "2024-01-06" and refresh_newest(store, spark.read.parquet(path)) is None
