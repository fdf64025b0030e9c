"""Copy-on-write state tables: data by key bucket, versions named by manifests.

    <root>/data/<write id>/bucket=17/part-....parquet     rows of one bucket, never changed once written
    <root>/manifests/v00000007.json                       which folder holds each bucket of version 7

A commit gives the rows to insert or replace and the keys to delete. Only the
buckets those keys fall into are read, merged and written anew; the new manifest
names them and takes every other bucket over from the version before. The
version exists once its manifest does: that is put in place by a rename that
refuses to replace a file, so of two writers that start from the same version
one gets ``ConcurrentCommit`` and has changed nothing that anyone reads. (On
HDFS and its like the rename is atomic; a store without such a rename needs one
writer at a time.) Data folders that no kept manifest names are removed with old
versions, an hour after they were written at the earliest, so that a write that
is under way keeps its own.

A manifest also carries a small dictionary of notes, for marks that must be
committed together with the rows: how far a log has been read, which batch of a
stream has been folded in.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslog.schemas import conform

_MANIFEST = re.compile(r"^v(\d{8})\.json$")
# Data folders younger than this are kept, whether or not a manifest names them.
YOUNG_MS = 3_600_000


class ConcurrentCommit(RuntimeError):
    """Another writer has committed the version that this one was about to write."""


class BucketStore:
    """State rows with a declared schema and a unique key (NULL is a key value like any other).

    ``buckets`` is fixed when the store is first written; choose it so that a bucket
    is some 100 MB. ``retain`` versions are kept.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: list[str], buckets: int = 64,
                 retain: int = 20):
        if retain < 2:
            raise ValueError("a commit reads the version before the one it writes: retain at least 2")
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.buckets, self.retain = buckets, retain

    # ------------------------------------------------------------ files
    def _path(self, *parts: str):
        return self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def _fs(self):
        return self._path().getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def _put_once(self, name: str, text: str) -> None:
        """Create manifest ``name`` whole, or raise if it is there."""
        jvm, fs = self.spark.sparkContext._jvm, self._fs()
        draft, final = self._path("manifests", f".{uuid.uuid4().hex}"), self._path("manifests", name)
        out = fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        rename = jvm.org.apache.hadoop.fs.Options.Rename
        options = self.spark.sparkContext._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            fs.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        try:
            context.rename(draft, final, options)
        except Exception as e:
            fs.delete(draft, False)
            if "FileAlreadyExists" in str(e):
                raise ConcurrentCommit(f"{name} was committed by another writer") from e
            raise

    def versions(self) -> list[int]:
        fs, folder = self._fs(), self._path("manifests")
        if not fs.exists(folder):
            return []
        names = (st.getPath().getName() for st in fs.listStatus(folder))
        return sorted(int(m.group(1)) for n in names if (m := _MANIFEST.match(n)))

    def latest(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def manifest(self, version: int | None) -> dict:
        """{"buckets": bucket -> folder, "of": number of buckets, "notes": ...} of a version."""
        if version is None:
            return {"of": self.buckets, "buckets": {}, "notes": {}}
        stream = self._fs().open(self._path("manifests", f"v{version:08d}.json"))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def notes(self, version: int | None = None) -> dict:
        return self.manifest(self.latest() if version is None else version)["notes"]

    # ------------------------------------------------------------ rows
    def bucket_of(self, of: int) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(of)).cast("int")

    def _read(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.root}/data/{f}" for f in sorted(folders)))

    def read(self, version: int | None = None) -> DataFrame:
        """Rows of ``version`` (default: latest); an empty frame before the first commit."""
        return self._read([*self.manifest(self.latest() if version is None else version)["buckets"].values()])

    def changes(self, new: DataFrame, base: int | None) -> DataFrame:
        """What turns version ``base`` into ``new``: rows to put, and rows of keys to delete, told by ``_op``.

        One full join of the new rows with the keys and row hashes of the old ones; ``new`` is
        evaluated once.
        """
        hashed = F.struct(F.xxhash64(*self.schema.names), F.xxhash64(F.lit(1), *self.schema.names))
        new = conform(new, self.schema, self.key).withColumn("_new", hashed)
        old = self.read(base).select(*(F.col(k).alias(f"_{k}") for k in self.key), hashed.alias("_old"))
        same = F.lit(True)
        for k in self.key:
            same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
        gone = F.col("_new").isNull()
        keys = {k: F.when(gone, F.col(f"_{k}")).otherwise(F.col(k)) for k in self.key}
        return (new.join(old, same, "full_outer").where(~F.col("_new").eqNullSafe(F.col("_old")))
                .select(*(keys.get(c, F.col(c)).alias(c) for c in self.schema.names),
                        F.when(gone, "delete").otherwise("put").alias("_op")))

    def apply(self, changes: DataFrame, base: int | None, notes: dict | None = None) -> int:
        """Commit ``changes`` (schema's columns and ``_op``: put or delete, a key at most once) on top of ``base``."""
        was = self.manifest(base)
        of = was["of"]
        write = uuid.uuid4().hex
        staged_path = f"{self.root}/data/{write}-changes"
        (changes.select(*self.schema.names, "_op", self.bucket_of(of).alias("bucket"))
         .write.parquet(staged_path))
        staged = self.spark.read.parquet(staged_path)
        touched = sorted(r["bucket"] for r in staged.select("bucket").distinct().collect())  # at most one a bucket
        buckets = dict(was["buckets"])
        if touched:
            old = self._read([buckets[str(b)] for b in touched if str(b) in buckets])
            same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in self.key]
            drop = staged.select(*(F.col(k).alias(f"_{k}") for k in self.key))
            kept = old.join(drop, same, "left_anti")
            rows = kept.unionByName(staged.where("_op = 'put'").select(*self.schema.names))
            rows = conform(rows, self.schema, self.key).withColumn("bucket", self.bucket_of(of))
            rows.repartition(min(len(touched), of), "bucket").write.partitionBy("bucket").parquet(f"{self.root}/data/{write}")
            fs, folder = self._fs(), self._path("data", write)
            there = {st.getPath().getName() for st in fs.listStatus(folder)}
            for b in touched:
                buckets.pop(str(b), None)
                if f"bucket={b}" in there:  # a bucket all of whose rows are gone has no folder
                    buckets[str(b)] = f"{write}/bucket={b}"
        version = (base or 0) + 1
        self._put_once(f"v{version:08d}.json", json.dumps(
            {"of": of, "buckets": buckets, "touched": touched, "notes": {**was["notes"], **(notes or {})}}))
        self._prune()
        return version

    def commit(self, new: DataFrame, base: int | None, notes: dict | None = None) -> int:
        """Commit ``new`` as the whole state that follows ``base``; buckets without a change stay as they are."""
        return self.apply(self.changes(new, base), base, notes)

    def _prune(self) -> None:
        fs, versions = self._fs(), self.versions()
        for v in versions[:-self.retain]:
            fs.delete(self._path("manifests", f"v{v:08d}.json"), False)
        named = {f.split("/")[0] for v in versions[-self.retain:] for f in self.manifest(v)["buckets"].values()}
        now = self.spark.sparkContext._jvm.java.lang.System.currentTimeMillis()
        for st in fs.listStatus(self._path("data")):
            if st.getPath().getName() not in named and now - st.getModificationTime() > YOUNG_MS:
                fs.delete(st.getPath(), True)
