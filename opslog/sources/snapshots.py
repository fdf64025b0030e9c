"""Versioned snapshot store for state carried between runs.

Each version is a parquet folder ``<root>/v00000001``; a version counts as
committed once the job committer has written its ``_SUCCESS`` marker. Writers
always create a new version (never overwrite a path that may be being read),
so a failed run leaves the previous version intact and the next run simply
starts again from it. Listing goes through the Hadoop FileSystem of the path,
so the same code works on local disk, HDFS or an object store.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from opslog.schemas import conform

_VERSION = re.compile(r"^v(\d{8})$")


class SnapshotStore:
    """``retain`` committed versions are kept; older ones, and what failed attempts
    left before them, are removed after a write (None keeps everything)."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str] | None = None,
                 retain: int | None = 20):
        if retain is not None and retain < 2:
            raise ValueError("a run reads the version before the one it writes: retain at least 2")
        self.spark = spark
        self.root = root.rstrip("/")
        self.schema = schema
        self.key = key
        self.retain = retain

    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.root)
        return jvm, path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        jvm, root, fs = self._fs()
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            m = _VERSION.match(st.getPath().getName())
            if m and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(m.group(1)))
        return sorted(out)

    def _all_version_dirs(self) -> list[int]:
        """Every version folder, committed or not (a failed write leaves one)."""
        jvm, root, fs = self._fs()
        if not fs.exists(root):
            return []
        return sorted(int(m.group(1)) for st in fs.listStatus(root)
                      if (m := _VERSION.match(st.getPath().getName())))

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def path(self, version: int) -> str:
        return f"{self.root}/v{version:08d}"

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of ``version`` (default: latest); an empty frame before the first write."""
        version = self.latest() if version is None else version
        if version is None:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self.path(version))

    def write(self, df: DataFrame, version: int | None = None) -> int:
        """Write ``df`` as a new version (latest + 1 by default) and return it."""
        if version is None:
            # Skip folders left by failed attempts: never write into them.
            version = max(self._all_version_dirs() or [0]) + 1
        conform(df, self.schema, self.key).write.mode("errorifexists").parquet(self.path(version))
        if self.retain is not None:
            self._prune()
        return version

    def _prune(self) -> None:
        keep = self.versions()[-self.retain:]
        if len(keep) < self.retain:
            return
        jvm, _, fs = self._fs()
        for v in self._all_version_dirs():
            if v < keep[0]:
                fs.delete(jvm.org.apache.hadoop.fs.Path(self.path(v)), True)
