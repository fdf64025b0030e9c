"""The notification run driven by a stream: each micro-batch runs it once."""

import os
import tempfile

from opslog.schemas import JOB_FAILURES
from opslog.sources.snapshots import SnapshotStore
from opslog.streaming import start_failure_polling
from tests.conftest import rows


def test_polling_runs_notification_per_batch(spark):
    root = tempfile.mkdtemp(prefix="opslog-poll-")
    ticks_dir = os.path.join(root, "ticks")
    spark.createDataFrame([(1,)], "tick int").write.parquet(ticks_dir)
    ticks = spark.readStream.schema("tick int").parquet(ticks_dir)
    store = SnapshotStore(spark, os.path.join(root, "state"), JOB_FAILURES)

    def inputs():
        return dict(
            history=spark.createDataFrame([(1, "j1", 1, "failed")], "instance_id long, job_id string, step_id int, message string"),
            steps=spark.createDataFrame([("j1", 1, "a", "TSQL", "", 0, 20240101, 0, 5)],
                                        "job_id string, step_id int, step_name string, subsystem string, command string, "
                                        "last_run_outcome int, last_run_date int, last_run_time int, last_run_duration int"),
            jobs=spark.createDataFrame([("j1", "Job one", 1)], "job_id string, name string, enabled int"),
            event_messages=spark.createDataFrame([], "operation_id long, event_message_id long, message_time timestamp_ntz, "
                                                     "package_name string, event_name string, message string"),
            ignore=spark.createDataFrame([], "JobName string, JobID string"),
        )

    q = start_failure_polling(spark, ticks, inputs, store, os.path.join(root, "reports"), "S",
                              os.path.join(root, "chk"), available_now=True)
    q.awaitTermination(120)
    assert store.versions() == [1, 2]
    assert [(r["JobID"], r["UpdateFlag"]) for r in rows(store.read())] == [("j1", 0)]
    assert os.listdir(os.path.join(root, "reports")) == ["v00000001"]
