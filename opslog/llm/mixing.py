"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Targets: sources in code-point order (null last) share the corpus by repeating
weights; no source exceeds ``max_repeat`` times its size and the excess is
shared again by weight. Every source's documents are put in a seeded random
order and cut into blocks of about ``block_words`` words. The mix takes whole
epochs of all blocks and then a partial epoch: the leading documents up to the
target, then passes over the documents left, each taking in seeded order those
no larger than what is missing until the next would cross it. Passes end where
the gap is within tolerance or below the smallest document left; then one
overshooting document is taken if that lands closer. That gives
every source an exact quota of block draws. A binary tree deals the quota
vector out to the output shards: each split draws the left half's share from
the multivariate hypergeometric distribution, so all leaves add up to the
quotas exactly. A source's draws are a seeded permutation of its blocks; each
shard owns an interval of it, so no two shards hold the same draw, and rows
are shuffled within their shard.

Only per-source sums, per-partition sums and the upper tree are on the driver.
Positions in a source come from a range sort and partition offsets, so a
source with a third of all rows is spread over tasks like any other.

Defined cases: a null or blank text has size 0 and its document is taken with
its block at no words; sources without words have target 0; null and repeated
ids stay rows of their own; an empty table gives an empty result. Reruns over
the same rows agree.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from opslog.llm.common import WORD, partitions, stored

WEIGHTS = (5, 2, 1)
MAX_REPEAT = 3
BLOCK_WORDS = 1 << 16
SHARD_BLOCKS = 64
SEED = 20240
# Tables with a row per source or partition are broadcast up to this many rows (about 10 MB), else joined.
BROADCAST_ROWS = 100_000
# What is missing to a target is filled up in passes, until it is below this share of the target.
TOLERANCE = 0.0002
# Sums that the driver reads to narrow down where passes end, over all sources together.
FILL_SUMS = 1 << 18
# Nodes of the splitting tree that the driver expands; the rest is expanded in tasks.
DRIVER_NODES = 1024


def targets(sizes: Sequence[int], weights: Sequence[float], max_repeat: float) -> list[float]:
    """Words to take of each source: shares by weight, capped, the excess shared again."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(sum(sizes))
    while open_:
        per = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if per * weights[i] > max_repeat * sizes[i]]
        if not over:
            for i in open_:
                out[i] = per * weights[i]
            break
        for i in over:
            out[i] = float(max_repeat * sizes[i])
            left -= out[i]
        open_ = [i for i in open_ if i not in set(over)]
    return out


def split(lo: int, hi: int, quota: np.ndarray, seed: int) -> tuple[int, np.ndarray]:
    """Deal the draws of shards [lo, hi) to its halves; returns (middle, left quota)."""
    mid = (lo + hi) // 2
    total = int(quota.sum())
    n = round(total * (mid - lo) / (hi - lo))
    rng = np.random.default_rng([seed, lo, hi])
    return mid, rng.multivariate_hypergeometric(quota, n, method="marginals")


Node = tuple[int, int, np.ndarray, np.ndarray, np.ndarray]  # shards from .. to, sources, their quota, their first rank


def leaves(lo: int, hi: int, of: np.ndarray, quota: np.ndarray, first: np.ndarray, seed: int, nodes: int = 0) -> list[Node]:
    """Expand a node to its shards, or to about ``nodes`` subtrees. Nodes hold the sources they have draws of only,
    so that all of them together hold no more numbers than there are draws, however many sources."""
    done, todo = [], [(lo, hi, of, quota, first)]
    while todo and (not nodes or len(done) + len(todo) < nodes):
        lo, hi, s, q, f = todo.pop(0)
        if hi - lo == 1:
            done.append((lo, hi, s, q, f))
            continue
        mid, left = split(lo, hi, q, seed)
        for a, b, own, start in ((lo, mid, left, f), (mid, hi, q - left, f + left)):
            some = own > 0
            todo.append((a, b, s[some], own[some], start[some]))
    return done + todo


def permuted(ranks: np.ndarray, n: int, seed: int) -> np.ndarray:
    """A seeded permutation of 0..n-1 at the given ranks: four Feistel rounds, walked back into range."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> np.uint64(half), x & mask
        for r in range(4):
            m = (b + np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(r)
            m ^= m >> np.uint64(29)
            m *= np.uint64(0xBF58476D1CE4E5B9)
            m ^= m >> np.uint64(32)
            a, b = b, a ^ (m & mask)
        return (a << np.uint64(half)) | b

    x = once(ranks.astype(np.uint64))
    while (out := x >= n).any():
        x[out] = once(x[out])
    return x.astype(np.int64)


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str, row_hash: Column | None) -> DataFrame:
    """Narrow rows: id, a content hash and a number that tell equal ids apart, source, size."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text, source_col).alias("hash"),
                       F.col(source_col).cast("string").alias("source"),
                       F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
                       (F.lit(0).cast("long") if row_hash is None else row_hash).alias("row"))
    return rows


def _placed(sized: DataFrame, seed: int) -> DataFrame:
    """Rows in source order and seeded random order, with partition and words and rows before them in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, words, at = TaskContext.get().partitionId(), 0, 0
        for b in batches:
            size = b.column(3).to_numpy()
            before = words + np.cumsum(size) - size
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(size), part, np.int32)), pa.array(before.astype(np.int64)),
                 pa.array(np.arange(at, at + len(size), dtype=np.int64))],
                [*b.schema.names, "part", "words", "at"])
            words, at = words + int(size.sum()), at + len(size)

    sized = stored(sized, "mix-sizes")  # range sampling reads its input once more: not the texts
    key = F.xxhash64("doc_id", "hash", F.lit(seed))
    by = [F.asc_nulls_last("source"), F.col("key")]
    return stored(sized.withColumn("key", key).repartitionByRange(partitions(sized.sparkSession), *by)
                  .sortWithinPartitions(*by, "doc_id", "hash", "size", "row").drop("key")
                  .mapInArrow(run, "doc_id long, hash long, source string, size long, row long, part int, words long, at long"),
                  "mix")


INT, LONG = pa.int32(), pa.int64()
CUTS = ("cuts", pa.list_(pa.struct([("gap", LONG), ("part", INT), ("at", LONG)])))


def _local(spark: SparkSession, rows: list[tuple], *fields: tuple[str, pa.DataType]) -> DataFrame:
    """A table from rows of the driver. By way of Arrow: a list of rows would take Python workers on the executors to read it."""
    return spark.createDataFrame(pa.Table.from_arrays(
        [pa.array([r[k] for r in rows], t) for k, (_, t) in enumerate(fields)], schema=pa.schema(fields)))


def _small(spark: SparkSession, rows: list[tuple], *fields: tuple[str, pa.DataType]) -> DataFrame:
    table = _local(spark, rows, *fields)
    return F.broadcast(table) if len(rows) <= BROADCAST_ROWS else table


class Fill:
    """How one source's partial epoch is filled up.

    ``cuts`` has the passes as (gap, part, at): a pass takes all open documents of at most
    ``gap`` words up to that row. ``top`` is an overshooting document (part, at); with it the
    passes after the state it was found in are undone, and the prefix too if ``dropped``.
    """

    def __init__(self, rest: int, prefix: int, over):
        self.cuts: list[tuple[int, int, int]] = []
        self.top, self.dropped, self.top_words = None, False, 0
        # missing words before the prefix, after it and after each pass; the smallest document above each
        self.gaps, self.overs = [int(rest), int(rest - prefix)], [over]

    def took(self, cut: tuple[int, int, int], words: int) -> None:
        self.cuts.append(cut)
        self.gaps.append(self.gaps[-1] - words)

    def close(self) -> None:
        """No open document fits any more: overshoot if that lands closer than staying short."""
        off, _, k = min([(o["size"] - self.gaps[i], -i, i) for i, o in enumerate(self.overs) if o] or [(math.inf, 0, 0)])
        if off < self.gaps[-1]:
            self.top, self.dropped, self.top_words = (self.overs[k]["part"], self.overs[k]["at"]), k == 0, self.overs[k]["size"]
            self.cuts, self.gaps = self.cuts[:max(0, k - 1)], self.gaps[:max(2, k + 1)]

    def words(self) -> int:
        return self.top_words + (0 if self.dropped else self.gaps[1] - self.gaps[-1])


def _cut() -> Column:
    """True for rows that one of the passes in ``cuts`` takes."""
    return ~F.col("prefix") & (F.col("size") > 0) & F.exists("cuts", lambda c: (F.col("size") <= c["gap"]) & (
        (F.col("part") < c["part"]) | ((F.col("part") == c["part"]) & (F.col("at") <= c["at"]))))


def _fill(rows: DataFrame, fills: dict[int, Fill], tolerance: dict[int, float]) -> None:
    """Passes over the documents left, for all sources at once, until no gap is open.

    A pass over a source ends in one partition of the seeded order; sums of ever smaller runs of
    rows find the row there. Every pass takes a document at least, the first of those that fit.
    """
    spark = rows.sparkSession
    open_ = [i for i, f in fills.items() if f.gaps[-1] > tolerance[i]]
    while open_:
        state = _small(spark, [(i, fills[i].gaps[-1], fills[i].cuts) for i in open_], ("s", INT), ("gap", LONG), CUTS)
        left = rows.where("not prefix and size > 0").join(state, "s").where(~_cut())
        fits = F.col("size") <= F.col("gap")
        sums: dict[int, list] = {i: [] for i in open_}
        for r in left.groupBy("s", "part").agg(
                F.sum(F.when(fits, F.col("size"))).alias("words"), (F.max("at") + 1).alias("end"),
                F.min(F.when(~fits, F.struct("size", "part", "at"))).alias("over")).collect():
            sums[r["s"]].append(r)
        narrow: dict[int, tuple[int, int, int, int]] = {}  # source: part, first row, end, words before
        for i in open_:
            f, words = fills[i], 0
            f.overs.append(min((r["over"] for r in sums[i] if r["over"]), default=None))
            own = sorted((r for r in sums[i] if r["words"]), key=lambda r: r["part"])
            for r in own:
                if words + r["words"] > f.gaps[-1]:
                    narrow[i] = (r["part"], 0, r["end"], words)
                    break
                words += r["words"]
            else:
                if own:
                    f.took((f.gaps[-1], own[-1]["part"], own[-1]["end"] - 1), words)
        crossing = {}
        while narrow:
            fan = max(2, min(1024, FILL_SUMS // len(narrow)))
            step = {i: -(-(end - lo) // fan) for i, (_, lo, end, _) in narrow.items()}
            at = _small(spark, [(i, p, lo, end, step[i]) for i, (p, lo, end, _) in narrow.items()],
                        ("s", INT), ("part", INT), ("lo", LONG), ("end", LONG), ("step", LONG))
            runs: dict[int, list] = {i: [] for i in narrow}
            for r in (left.where(fits).join(at, ["s", "part"]).where("at >= lo and at < end")
                      .groupBy("s", F.floor((F.col("at") - F.col("lo")) / F.col("step")).alias("run"))
                      .agg(F.sum("size").alias("words")).collect()):
                runs[r["s"]].append((r["run"], r["words"]))
            for i, (p, lo, end, words) in list(narrow.items()):
                for run, w in sorted(runs[i]):
                    if words + w > fills[i].gaps[-1]:
                        break
                    words += w
                first = lo + run * step[i]
                if step[i] > 1:
                    narrow[i] = (p, first, min(end, first + step[i]), words)
                else:
                    crossing[i] = (p, first - 1, words)
                    del narrow[i]
        for i, (p, row, words) in crossing.items():
            fills[i].took((fills[i].gaps[-1], p, row), words)
        for i in open_:
            # nothing was taken, or all that fits was: what is left is larger than the gap
            if fills[i].gaps[-1] > tolerance[i] and not any(r["words"] for r in sums[i]):
                fills[i].close()
        open_ = [i for i in open_ if fills[i].gaps[-1] > tolerance[i] and any(r["words"] for r in sums[i])]


def plan(docs: DataFrame, weights: Sequence[float] = WEIGHTS, max_repeat: int = MAX_REPEAT,
         block_words: int = BLOCK_WORDS, shard_blocks: int = SHARD_BLOCKS, seed: int = SEED,
         id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         row_hash: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, draws) of a mix. Rows equal in id, text and source are ordered by ``row_hash``, if given.

    The draws of a mix (words taken / ``block_words``) must stay below 10^9, the bound of the
    hypergeometric sampler: 6.5 * 10^13 words at the default.

    rows: doc_id, hash, row (``row_hash``), source, size, source_size, target and the row's key (part, at).
    draws: part, at, copy, shard, one row for each time the mix takes that row.
    """
    spark = docs.sparkSession
    placed = _placed(_sized(docs, id_col, text_col, source_col, row_hash), seed)
    parts = sorted(placed.groupBy("part").agg(F.sum("size"), F.count("*")).collect())
    at = np.array([[0, 0], *[[w, n] for _, w, n in parts]], np.int64).cumsum(axis=0)
    sums = placed.groupBy("source").agg(F.sum("size"), F.count("*")).collect()  # a row per source
    sums.sort(key=lambda r: (r[0] is None, r[0] or ""))
    sizes = [int(r[1]) for r in sums]
    goal = targets(sizes, [weights[i % len(weights)] for i in range(len(sums))], max_repeat)
    full = [min(max_repeat, math.floor(t / s)) if s else 0 for t, s in zip(goal, sizes)]
    rest = [round(t - e * s) for t, e, s in zip(goal, full, sizes)]
    start = np.array([[0, 0], *[[r[1], r[2]] for r in sums]], np.int64).cumsum(axis=0)

    by_part = _small(spark, [(p, int(a), int(b)) for (p, _, _), (a, b) in zip(parts, at)],
                     ("part", INT), ("part_words", LONG), ("part_rows", LONG))
    by_source = _small(
        spark, [(i, r[0], sizes[i], float(goal[i]), full[i], rest[i], int(start[i][0]), int(start[i][1]))
         for i, r in enumerate(sums)],
        ("s", INT), ("src", pa.string()), ("source_size", LONG), ("target", pa.float64()), ("epochs", INT), ("rest", LONG),
        ("s_words", LONG), ("s_rows", LONG))
    rows = (placed.join(by_part, "part").join(by_source, F.col("source").eqNullSafe(F.col("src")))
            .withColumn("p", F.col("part_words") + F.col("words") - F.col("s_words"))
            .withColumn("n", F.col("part_rows") + F.col("at") - F.col("s_rows"))
            .withColumn("block", F.floor((F.col("p") + F.col("n")) / block_words).cast("long"))
            .withColumn("prefix", (F.col("rest") > 0) & (F.col("p") + F.col("size") <= F.col("rest")))
            .drop("src", "part_words", "part_rows", "words", "s_words", "s_rows", "n"))

    # per source: words and blocks of the partial epoch, and the documents that fill it up
    ends = {r["s"]: r for r in rows.groupBy("s").agg(
        (F.max("block") + 1).alias("blocks"), F.max(F.when(F.col("prefix"), F.col("block"))).alias("last"),
        F.coalesce(F.sum(F.when(F.col("prefix"), F.col("size"))), F.lit(0)).alias("words"),
        F.min(F.when((F.col("rest") > 0) & (F.col("size") > F.col("rest")), F.struct("size", "part", "at"))).alias("over")).collect()}
    done = {i: Fill(rest[i], r["words"], r["over"]) for i, r in ends.items()}
    _fill(rows, done, {i: TOLERANCE * goal[i] for i in done})

    blocks = {i: int(r["blocks"]) for i, r in ends.items()}
    spans, tail = [], {}
    for i, f in done.items():
        start_ = 0 if f.dropped or ends[i]["last"] is None else int(ends[i]["last"])
        # what fills up joins the last block of the prefix, or is dealt over as many more as it has words for
        span = 1 + min(f.words() // block_words, blocks[i] - 1 - start_)
        tail[i] = start_ + span if f.cuts or f.top or (not f.dropped and ends[i]["last"] is not None) else 0
        spans.append((i, f.dropped, start_, span, f.cuts, *(f.top or (None, None))))
    quota = np.array([full[i] * blocks.get(i, 0) + tail.get(i, 0) for i in range(len(sums))], np.int64)
    units = _units(spark, quota, [blocks.get(i, 0) for i in range(len(sums))], shard_blocks, seed)

    last = _small(spark, spans, ("s", INT), ("dropped", pa.bool_()), ("start", LONG), ("span", LONG), CUTS,
                  ("top_part", INT), ("top_at", LONG))
    prefix = F.col("prefix") & ~F.col("dropped")
    topped = _cut() | F.coalesce((F.col("part") == F.col("top_part")) & (F.col("at") == F.col("top_at")), F.lit(False))
    own = F.when(prefix | (F.col("block") < F.col("start")), F.col("block")).otherwise(
        F.col("start") + F.pmod(F.xxhash64("part", "at"), F.col("span")))
    copies = (rows.join(last, "s")
              .select("part", "at", "s", F.explode(F.concat(
                  F.when(F.col("epochs") > 0, F.transform(F.sequence(F.lit(0), F.col("epochs") - 1), lambda e: F.struct(
                      e.alias("copy"), F.col("block").alias("block")))).otherwise(F.array()),
                  F.when(prefix | topped, F.array(F.struct(
                      F.col("epochs").alias("copy"), own.alias("block")))).otherwise(F.array())))
                  .alias("d")).select("part", "at", "s", "d.copy", "d.block"))
    draws = copies.join(units, ["s", "copy", "block"]).select("part", "at", "copy", "shard")
    return rows.select("part", "at", "doc_id", "hash", "row", "source", "size", "source_size", "target"), draws


def _units(spark: SparkSession, quota: np.ndarray, blocks: list[int], shard_blocks: int, seed: int) -> DataFrame:
    """(s, copy, block, shard): every block draw and the shard that the splitting tree deals it to."""
    shards = max(1, -(-int(quota.sum()) // shard_blocks))
    some = np.flatnonzero(quota)
    tree = leaves(0, shards, some, quota[some], np.zeros_like(some), seed, DRIVER_NODES)
    many = pa.list_(LONG)
    nodes = _local(spark, tree, ("lo", LONG), ("hi", LONG), ("sources", many), ("quota", many), ("first", many))
    total = spark.sparkContext.broadcast((quota, np.array(blocks, np.int64)))

    def deal(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        all_quota, all_blocks = total.value
        for frame in frames:
            for lo, hi, *node in frame.itertuples(index=False):
                for shard, _, sources, own, start in leaves(lo, hi, *(np.asarray(x, np.int64) for x in node), seed):
                    if not len(sources):  # a mix without words
                        continue
                    unit = np.concatenate([permuted(np.arange(f, f + n), int(all_quota[s]), seed + s)
                                           for s, n, f in zip(sources.tolist(), own.tolist(), start.tolist())])
                    s = np.repeat(sources, own)
                    yield pd.DataFrame({"s": s, "copy": unit // all_blocks[s], "block": unit % all_blocks[s], "shard": shard})

    return nodes.mapInPandas(deal, "s int, copy int, block long, shard long")


def mix_sizes(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words, repeats counted)."""
    rows, draws = plan(docs, **options)
    times = draws.groupBy("part", "at").agg(F.count("*").alias("times"))
    return (rows.join(times, ["part", "at"], "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    (F.col("size") * F.coalesce("times", F.lit(0))).alias("taken")))


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          seed: int = SEED, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` with their columns, each as often as it is taken,
    gathered by output shard and shuffled within it.

    A row is known by its id and a hash of all its columns. Texts move twice: to their draws, and to
    their shards. Rows equal in all columns are one row for this: their draws are added up, and one
    of them, found by a partial aggregate, is sent to all.
    """
    whole = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if not isinstance(f.dataType, MapType)])
    rows, draws = plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, seed=seed, row_hash=whole, **options)
    taken = (draws.join(rows.select("part", "at", "doc_id", "row"), ["part", "at"])
             .select(F.col("doc_id").alias("__id"), F.col("row").alias("__hash"),
                     F.xxhash64("part", "at", "copy", F.lit(seed)).alias("__draw"), F.col("shard").alias("__shard")))
    cols = [F.col(f"`{c}`") for c in docs.columns]
    own = docs.select(*cols, F.col(id_col).cast("long").alias("__own"), whole.alias("__h"))
    same = F.col("__own").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash"))
    several = (rows.groupBy(F.col("doc_id").alias("__i"), F.col("row").alias("__k")).agg(F.count("*").alias("n"))
               .where("n > 1").select("__i", "__k"))
    if several.isEmpty():
        out = own.join(taken, same)
    else:
        held = F.col("__id").eqNullSafe(F.col("__i")) & (F.col("__hash") == F.col("__k"))
        mine = F.col("__own").eqNullSafe(F.col("__i")) & (F.col("__h") == F.col("__k"))
        one = (own.join(several, mine, "left_semi").groupBy("__own", "__h").agg(F.first(F.struct(*cols)).alias("__row"))
               .select("__row.*", "__own", "__h"))
        out = (own.join(taken.join(several, held, "left_anti"), same)
               .unionByName(one.join(taken.join(several, held, "left_semi"), same)))
    return out.repartition("__shard").sortWithinPartitions("__shard", "__draw", "__id", "__hash").select(*cols)
