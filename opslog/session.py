"""Session helpers: sane defaults for the operators, and the shared lineage-cut folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators assume. AQE re-plans joins from runtime sizes (broadcast
# only below the threshold, split skewed partitions) and coalesces small shuffles.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.caseSensitive": "false",
}

# Private folders of local sessions that name none, by application.
_LOCAL_DIRS: dict[str, str] = {}


def build_session(master: str = "local[8]", shuffle_partitions: int | None = None,
                  app_name: str = "opslog", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    b = b.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Where it is unset, a local session (one machine)
    gets a private folder for its lifetime; any other master is refused,
    because a machine-local folder cannot be read by the other executors.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _LOCAL_DIRS[sc.applicationId] = tempfile.mkdtemp(prefix="opslog-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d if d.endswith("://") else d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), *parts)
