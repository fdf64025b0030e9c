"""Memory of the operators on whole texts: batches of bounded bytes, nothing kept from task to task."""

import pyarrow as pa
from pyspark.sql import functions as F

from opslog.llm import common, mixing, packing, tokens
from tests.llm.fixtures import docs_df


def test_texts_reach_workers_in_batches_of_bounded_bytes(spark):
    packing.cut(docs_df(spark))  # any operator on whole texts bounds them

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["bytes", "rows"])

    texts = spark.range(0, 3000, numPartitions=1).select("id", F.repeat(F.lit("ab cd "), 2000).alias("t"))
    got = texts.mapInArrow(sizes, "bytes long, rows long").collect()
    assert sum(r["rows"] for r in got) == 3000 and sum(r["bytes"] for r in got) > 36_000_000
    assert max(r["bytes"] for r in got) < 6 << 20


def test_the_bound_of_a_session_stays_and_changes_no_row(spark):
    before = spark.conf.get(common.BATCH_SETTING, None)
    found = []
    try:
        for most in ("64m", "10k"):
            spark.conf.set(common.BATCH_SETTING, most)
            found.append(sorted(map(repr, packing.cut(docs_df(spark)).collect())))
            assert spark.conf.get(common.BATCH_SETTING) == most
    finally:
        if before is None:
            spark.conf.unset(common.BATCH_SETTING)
        else:
            spark.conf.set(common.BATCH_SETTING, before)
    assert found[0] == found[1]


class Pool:
    def __init__(self):
        self.released = 0

    def release_unused(self):
        self.released += 1


def test_workers_give_back_what_the_pool_holds_unused(monkeypatch):
    pool = Pool()
    texts = pa.array(["one two three " * 500] * 8)
    enc = tokens.encoder()
    monkeypatch.setattr(pa, "default_memory_pool", lambda: pool)
    slices = list(enc.batches(texts, batch_bytes=20_000))
    assert len(slices) == pool.released == 4
    pool.released = 0
    batch = pa.RecordBatch.from_arrays([texts], ["t"])
    assert list(common.released(lambda batches: (b for b in batches))(iter([batch, batch]))) == [batch, batch]
    assert pool.released == 3


def test_tables_of_the_driver_take_no_workers(spark, capsys):
    table = mixing._small(spark, [(0, 7, [(5, 1, 2)]), (1, 8, [])], ("s", mixing.INT), ("gap", mixing.LONG), mixing.CUTS)
    table.explain()
    assert "LocalTableScan" in capsys.readouterr().out  # not a scan of an RDD that Python workers fill
    assert table.dtypes == [("s", "int"), ("gap", "bigint"), ("cuts", "array<struct<gap:bigint,part:int,at:bigint>>")]
    assert [(r["s"], r["gap"], [tuple(c) for c in r["cuts"]]) for r in table.collect()] == [(0, 7, [(5, 1, 2)]), (1, 8, [])]
