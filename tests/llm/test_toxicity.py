"""Toxicity: held-out labels, unseen misspellings, and a plainly computed score."""

import zlib

import numpy as np
import pytest

from opslog.llm import toxicity
from tests.llm.fixtures import EN, awkward, doc, docs_df, empty

SF = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def fitted(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return docs, labels, toxicity.train(docs, labels)


def test_held_out_labels(spark, fitted):
    docs, labels, model = fitted
    got = toxicity.score(docs, model)
    assert got.count() == docs.count()
    rows = got.join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for r in rows)
    ones, zeros = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    # the small table labels few toxic texts in the other languages
    assert np.mean([r.predicted for r in ones]) >= 0.65
    assert np.mean([r.predicted for r in zeros]) <= 0.02


def test_labels_and_metadata_of_held_out_rows_are_not_used(spark, fitted):
    from pyspark.sql import functions as F

    docs, labels, model = fitted
    turned = labels.withColumn("toxic", F.when(toxicity.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = toxicity.train(docs.withColumns({"lang": F.lit("x"), "source": F.lit("y")}), turned)
    assert again.bias == model.bias and (again.adds == model.adds).all()


def test_unseen_misspellings_share_vectors(fitted):
    _, _, model = fitted
    table = {}
    wrong = ["idiott", "stuupid", "scuum", "worthles", "moronn", "disgustinng"]
    model.learn(table, [wrong, EN.split()])
    assert min(table[w] for w in wrong) > max(5.0, 2 * np.mean([abs(table[w]) for w in EN.split()]))
    clean = EN * 40
    bad = " ".join(clean.split()[:700] + ["you", "stuupid", "idiott"] + clean.split()[700:])
    low, high = model.logits([clean, bad], {})
    assert high > low + 3


def plain_rows(word):
    """Table rows of a word, one n-gram at a time."""
    w = "<" + (word.strip(toxicity.punctuation) or word) + ">"
    mask = (1 << 64) - 1

    def fold(h):
        return (((h ^ (h >> 31)) * 0x9E3779B97F4A7C15 & mask) >> 40) % toxicity.BUCKETS

    out = [fold((sum((ord(c) + 1) * pow(0x100000001B3, k + 1, 1 << 64) for k, c in enumerate(w)) + 7) & mask)]
    for n in toxicity.GRAMS:
        for i in range(len(w) - n + 1):
            h = n
            for c in w[i:i + n]:
                h = (h * 0x100000001B3 + ord(c) + 1) & mask
            out.append(fold(h))
    return out


def test_scores_equal_plain_sums(spark, fitted):
    docs, _, model = fitted
    texts = [r.text or "" for r in docs.orderBy("doc_id").limit(60).collect()] + ["Ünï çødé 😀 |", "...", "a"]
    adds = model.adds.astype(float)
    for text, z in zip(texts, model.logits(texts, {})):
        words = text.lower().split()
        starts = [*range(0, len(words) - toxicity.WINDOW, toxicity.WINDOW), max(0, len(words) - toxicity.WINDOW)]
        plain = max(sum(adds[plain_rows(w)].mean() for w in set(words[a:a + toxicity.WINDOW])) for a in starts) / toxicity.WINDOW
        assert z == pytest.approx(model.bias + plain, abs=1e-4)


def test_awkward_rows(spark):
    docs = docs_df(spark)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60)] + [(100, 1), (101, 0), (None, 1), (3, None), (4, 7)],
                                   "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(awkward()) and all(r.score is not None and 0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    none = toxicity.train(docs, empty(labels))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.5}
    one = toxicity.train(docs, labels.where("toxic = 1"))
    assert {r.predicted for r in toxicity.score(docs, one).collect()} == {1}
    assert toxicity.score(empty(docs), model).count() == 0
    small = docs_df(spark, [doc(1, ""), doc(2, None)])
    assert toxicity.score(small, toxicity.train(small, labels.where("doc_id < 3"))).count() == 2
