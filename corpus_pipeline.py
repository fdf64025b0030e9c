"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``. All but the last
return the columns of ``docs``. A stage works on all rows it is given:

1. language: rows whose language cannot be told go (narrow margin, no letter, blocks in another
   language, hardly any gain from any dictionary);
2. quality: rows that the classifier scores below one half go;
3. near_duplicates: one document of every SimHash group stays;
4. mix: rows appear as often as the mix takes them, gathered by output shard;
5. pack: one row per piece of at most 2048 ids, with its sequence and offset.

The first two learn from the rows they are given; the held-out third of the
documents never trains them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from opslog.llm import langid, mixing, packing, quality, simhash
from opslog.llm.common import read
from opslog.session import checkpoint_dir


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    dictionaries = langid.train(docs)
    return langid.accepted_rows(docs, dictionaries, bounds=langid.fit_bounds(docs, dictionaries))


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_rows(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [("language", language), ("quality", good_quality), ("near_duplicates", near_duplicates),
          ("mix", mix), ("pack", pack)]

# The classifiers, the fingerprints and the tokenizer have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the tables between them go to the shared folder."""
    root = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
    return docs
