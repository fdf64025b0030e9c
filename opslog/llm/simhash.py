"""SimHash near-duplicate groups by meet-in-the-middle ball hashing.

Two fingerprints within 2r bits have a common variant within r bits of both.
So every distinct fingerprint emits all variants within r bits, the variants
are shuffled, and fingerprints that meet at a variant are linked. The members
of one variant are at most 2r bits apart from each other, so linking each to
the smallest member loses no group and needs one edge a member, not all pairs;
every link is verified by its bit distance. A variant's group holds at most as
many distinct fingerprints as a ball of radius r has points (65 for r = 1),
whatever the data: copies share one fingerprint and are folded before.

Defined cases: null or blank texts have fingerprint zero and link like any
other; rows with a null id keep their fingerprint and have a null component;
repeated rows come out as often as they came in; an empty table gives an empty
result; columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import connected_components, map_texts, partitions, stored

BITS = 64
SEED = 42
# Shingles unpacked at once, so that a very long text needs bounded memory.
CHUNK = 1 << 15


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash: a bit is set if more than half the shingle hashes have it."""
    import xxhash

    words = (text or "").encode().lower().split()  # bytes: A-Z only; blanks are 0x20, 0x09-0x0D
    n = len(words) - shingle + 1
    if not words:
        return 0
    if n < 1:
        words, n = [b" ".join(words)], 1
        shingle = 1
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    h64 = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for i in range(0, n, CHUNK):
        k = min(n, i + CHUNK)
        spans = zip(starts[i:k].tolist(), ends[i + shingle - 1:k + shingle - 1].tolist())
        h = np.array([h64(joined[a:b], SEED) for a, b in spans], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text", hashed: bool = False) -> DataFrame:
    """(id, fp) with fp the fingerprint's 64 bits as a signed long; if ``hashed`` also th, a hash of the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fps, pa.int64()), *b.columns[2:]],
                                             ["id", "fp", "th"][:b.num_columns])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), *[F.xxhash64(text).alias("th")] * hashed)
    return map_texts(src, run, "id long, fp long" + ", th long" * hashed)


def ball(radius: int) -> list[int]:
    """Signed 64-bit masks of every pattern of at most ``radius`` bits."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(BITS), r)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def ball_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """Links (u, v) between distinct fingerprints, connecting all within ``max_bits`` (even) bits."""
    if max_bits % 2:
        raise ValueError("ball hashing meets in the middle: max_bits must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(max_bits // 2)])
    # spread first: a few rows in grow by the size of the ball
    met = (fps.repartition(partitions(fps.sparkSession), "fp").select("fp", F.explode(masks).alias("mask"))
           .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
           .withColumn("low", F.min("fp").over(Window.partitionBy("variant"))))
    return (met.where("fp <> low").select(F.col("fp").alias("u"), F.col("low").alias("v")).distinct()
            .where(F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits))


def simhash_groups(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id, kept.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits; ``kept`` marks that document.
    """
    out = _grouped(stored(fingerprints(docs, shingle, id_col, text_col), "simhash"), max_bits)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      "component_id", "kept")


def _grouped(rows: DataFrame, max_bits: int) -> DataFrame:
    """``rows`` (id, fp and others) with component_id and kept."""
    classes = rows.where("id is not null").groupBy("fp").agg(F.min("id").alias("low_id"))
    labels = connected_components(ball_links(classes.select("fp"), max_bits))
    classes = (classes.join(labels, classes.fp == labels.node, "left")
               .select("fp", "low_id", F.coalesce("component", "fp").alias("component")))
    lowest = classes.groupBy("component").agg(F.min("low_id").alias("component_id"))
    of_class = stored(classes.join(lowest, "component").select("fp", "component_id"), "simhash-classes")
    out = rows.join(of_class, "fp", "left")
    cid = F.when(F.col("id").isNotNull(), F.col("component_id"))
    return out.select(*[f"`{c}`" for c in rows.columns], cid.alias("component_id"), (F.col("id") == cid).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 3, max_bits: int = 2,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with one document of every group (the smallest id), one row each.

    Kept rows are told by id and fingerprint, so that of an id with several texts each is kept or
    dropped with its own group. Of several rows of one id and fingerprint the one with the smallest
    text hash stays, and of rows equal in both the first by their columns.
    Rows without an id belong to no group and stay.
    """
    rows = stored(fingerprints(docs, shingle, id_col, text_col, hashed=True), "simhash")
    # not by the plain fingerprint: its rows would stay dealt by it, and copies under many ids in one task
    keys = (_grouped(rows, max_bits).where("kept")
            .groupBy(F.col("id").alias("__id"), F.col("fp").bitwiseXOR(F.col("id")).alias("__fp"))
            .agg(F.min("th").alias("__th"), F.count("*").alias("__n")).drop("__fp"))
    left = docs.join(keys, (F.col(id_col).cast("long") == F.col("__id"))
                     & (F.xxhash64(F.col(text_col).cast("string")) == F.col("__th")), "inner")
    own = [f"`{c}`" for c in docs.columns]
    out = left.where("__n = 1").select(*own).unionByName(docs.where(F.col(id_col).isNull()))
    if keys.where("__n > 1").isEmpty():
        return out
    first = left.where("__n > 1").groupBy("__id", "__th").agg(F.min(F.struct(*own)).alias("__row"))
    return out.unionByName(first.select("__row.*"))
