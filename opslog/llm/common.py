"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from opslog.session import checkpoint_dir

# A word: a run of anything but space, tab, line feed, vertical tab, form feed and return.
WORD = r"[^\x20\x09-\x0D]+"
# Bytes of rows that go to a Python worker at once, in sessions that do not set it themselves.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Plain scan of one table; only Spark opens the path, so any store it reads will do."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(id_col: str | Column) -> Column:
    """True where crc32 of the id as text leaves remainder 1 modulo 3 (null ids: false)."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def stored(df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """Write a table into the shared folder and read it back.

    Cuts the lineage: later jobs read the files, so a lost executor costs at
    most one task of the job that runs, and row order and partition numbers
    recorded in the table stay as they were.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run``, after whose every batch and end Arrow's pool gives back what it holds unused.

    Workers are reused by the tasks of all later jobs, and the pool of each keeps what its largest
    batches took for as long as the worker lives.
    """
    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = pa.default_memory_pool()
        for out in run(batches):
            yield out
            del out
            pool.release_unused()
        pool.release_unused()

    return task


def map_texts(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str | StructType) -> DataFrame:
    """``mapInArrow`` over rows with whole texts, in memory that grows neither with the length of the
    texts (but a single one's) nor from job to job: batches of bounded bytes, not of 10,000 rows, and
    nothing kept that is unused. The bound is a setting of the session, left alone where it is set."""
    spark = rows.sparkSession
    if spark.conf.get(BATCH_SETTING, None) is None:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return rows.mapInArrow(released(run), schema)


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Label of every node that has an edge: the smallest node it can reach.

    ``edges`` has long columns (u, v); direction, repeats and self-loops do not
    matter. Returns (node, component). Alternates the large-star and small-star
    steps until the edge set stops changing, in about log(n) rounds. Every
    minimum is a map-side combined aggregate joined back by key, so a hub with
    a third of all edges is an ordinary skewed join, never one group in a task.
    Each round is checkpointed in the shared folder.
    """
    checkpoint_dir(edges.sparkSession)
    e = (edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
         .distinct().checkpoint())
    seen = None
    for _ in range(max_rounds):
        # large star: every larger neighbour is linked to the smallest of the closed neighbourhood
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: the node and its smaller neighbours are linked to the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
