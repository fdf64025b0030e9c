"""The registered queries, their oracle, and the pipeline."""

import re
from collections import Counter

import duckdb

import corpus_pipeline
from opslog.llm import queries

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in queries.QUERIES) == list(range(1, 14))
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


def test_oracle_rows(spark):
    for t in ("pages", "embeddings"):
        duckdb.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        got = queries.QUERIES[name](spark, SF)
        want = duckdb.sql(sql)
        cols = sorted(got.columns)
        assert cols == sorted(want.columns), name
        own = sorted(str(tuple(r[c] for c in cols)) for r in got.collect())
        other = sorted(str(tuple(r)) for r in want.select(*cols).fetchall())
        assert own == other, name


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    counts = [t.count() for t in tables]
    assert all(t.columns == docs.columns for t in tables[:-1])
    assert counts[0] >= counts[1] > counts[2] >= counts[3] > 0
    kept = [r.doc_id for r in tables[3].collect()]
    assert len(kept) == len(set(kept))
    mixed = {r.doc_id for r in tables[4].collect()}
    assert mixed <= set(kept) and {r.doc_id for r in tables[5].collect()} == mixed
    run = corpus_pipeline.run(spark, SF)
    assert sorted(map(str, run.drop("sequence_id", "offset").collect())) == sorted(map(str, tables[5].drop("sequence_id", "offset").collect()))


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_pipeline_on_awkward_rows(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows and clashing names, through all stages."""
    from tests.llm.fixtures import awkward, docs_df

    docs = docs_df(spark, [r for r in awkward() if r[0] != 104] + [(*awkward()[0][:1], "the and of " * 9000, *awkward()[0][2:])])
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], SF).cache())
    assert all(t.columns == docs.columns for t in tables[:-1])
    given = [Counter(map(str, t.collect())) for t in tables[:4]]
    for a, b in zip(given, given[1:]):
        assert set(b) <= set(a) and all(b[k] <= a[k] for k in b)  # filters keep rows as they are
    kept, mixed = given[3], Counter(map(str, tables[4].collect()))
    assert set(mixed) <= set(kept) and all(n <= 3 * kept[k] for k, n in mixed.items())
    assert tables[5].count() >= sum(mixed.values())
