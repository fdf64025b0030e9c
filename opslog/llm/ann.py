"""Approximate nearest neighbours by inner product over robust-pruned directed graphs.

Vectors are dealt to shards by a hash of their id. Each shard builds one
directed graph: a greedy beam search from the entry points proposes neighbours
of a vector, and relaxed distance pruning keeps a diverse few of them (a
candidate goes if a kept neighbour is closer to it, times ``ALPHA``, than the
vector itself is); kept edges are added in reverse and pruned again where a
vector has too many. A query walks every shard's graph with a beam and the
best of all shards are merged.

Inner products become distances by one more coordinate that lifts all vectors
of a shard to the same length; scores are inner products of the original
vectors in double precision. Equal vectors are one graph node with several ids.

Scale: shards are bounded (``SHARD_ROWS``), so build and search have bounded
memory. A shard's graph is built once and stored in the shared folder. To be
searched it moves once, to the task of its shard; the queries stream past it in
blocks of ``QUERY_BLOCK``.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components, and null ids, take no part; vectors meet only vectors of their own
length; repeated rows count once; fewer candidates than asked give fewer
results; ties go to the smaller id; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import stored
from opslog.llm.vectors import matrix, packed

SHARDS = 12
SHARD_ROWS = 50_000
DEGREE = 32
BEAM = 64
SEARCH_BEAM = 80
ALPHA = 1.2
ENTRIES = 8
QUERY_BLOCK = 4_096
# Partitions a shard: few heavy groups, kept apart from each other instead of merged by their bytes.
SPREAD = 4
# Searches that advance together; bounds the seen table to LANES x nodes bytes.
LANES = 512
SEED = 5


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, squared distances) of the ``width`` best found for each query, nearest first, -1 where none.

    All queries take a step at once: each expands its nearest node not yet
    expanded, until none of its beam is left.
    """
    n, norms = len(x), (x * x).sum(axis=1)
    found, dists = np.full((len(q), width), -1, np.int32), np.full((len(q), width), np.inf, np.float32)
    for at in range(0, len(q), LANES):
        own = q[at:at + LANES]
        b, rows = len(own), np.arange(len(own))
        ids = np.full((b, width), -1, np.int32)
        d = np.full((b, width), np.inf, np.float32)
        done = np.ones((b, width), bool)
        seen = np.zeros((b, n), bool)
        k = min(width, len(entries))
        first = entries[:k]
        ids[:, :k] = first
        d[:, :k] = norms[first] - 2 * own @ x[first].T
        done[:, :k] = False
        seen[:, first] = True
        while len(rows):
            best = np.where(done[rows], np.inf, d[rows]).argmin(axis=1)
            live = ~done[rows, best]
            rows, best = rows[live], best[live]
            if not len(rows):
                break
            done[rows, best] = True
            nb = graph[ids[rows, best]]
            fresh = (nb >= 0) & ~seen[rows[:, None], nb]
            r, c = np.nonzero(fresh)
            new = nb[r, c]
            seen[rows[r], new] = True
            nd = np.full(nb.shape, np.inf, np.float32)
            nd[r, c] = norms[new] - 2 * np.einsum("ij,ij->i", x[new], own[rows[r]])
            all_d = np.concatenate((d[rows], nd), axis=1)
            pick = np.argpartition(all_d, width - 1, axis=1)[:, :width]
            d[rows] = np.take_along_axis(all_d, pick, 1)
            ids[rows] = np.take_along_axis(np.concatenate((ids[rows], np.where(fresh, nb, -1)), axis=1), pick, 1)
            done[rows] = np.take_along_axis(np.concatenate((done[rows], ~fresh), axis=1), pick, 1)
        order = np.argsort(d, axis=1, kind="stable")
        found[at:at + b] = np.take_along_axis(ids, order, 1)
        dists[at:at + b] = np.take_along_axis(d, order, 1)
    found[~np.isfinite(dists)] = -1
    return found, dists


def prune(x: np.ndarray, points: np.ndarray, cand: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """Relaxed pruning of every point's candidates (-1: none) to at most ``degree`` diverse neighbours."""
    out = np.full((len(points), degree), -1, np.int32)
    for at in range(0, len(points), LANES):
        p, c = points[at:at + LANES], cand[at:at + LANES]
        c = np.sort(c, axis=1)
        gone = (c < 0) | (c == p[:, None])
        gone[:, 1:] |= c[:, 1:] == c[:, :-1]
        xc = x[np.where(gone, 0, c)]
        dp = ((xc - x[p][:, None, :]) ** 2).sum(axis=2)
        dp[gone] = np.inf
        rows = np.arange(len(p))
        for k in range(degree):
            best = dp.argmin(axis=1)
            live = np.isfinite(dp[rows, best])
            if not live.any():
                break
            out[at + rows[live], k] = c[rows[live], best[live]]
            between = ((xc - xc[rows, best][:, None, :]) ** 2).sum(axis=2)
            dp[(alpha * alpha * between <= dp) & live[:, None]] = np.inf
            dp[rows, best] = np.inf
    return out


def add_reverse(x: np.ndarray, graph: np.ndarray, points: np.ndarray, alpha: float) -> None:
    """Give every neighbour an edge back; nodes with too many are pruned again."""
    degree = graph.shape[1]
    src, dst = np.repeat(points, degree), graph[points].reshape(-1)
    src, dst = src[dst >= 0], dst[dst >= 0]
    order = np.argsort(dst, kind="stable")
    src, dst = src[order], dst[order]
    nodes, first, count = np.unique(dst, return_index=True, return_counts=True)
    for lo in range(0, len(nodes), LANES):
        own = nodes[lo:lo + LANES]
        wide = min(int(count[lo:lo + LANES].max()), 4 * degree)  # a hub takes this many new edges a round
        more = np.full((len(own), wide), -1, np.int32)
        for k, (f, n) in enumerate(zip(first[lo:lo + LANES], count[lo:lo + LANES])):
            more[k, :min(n, wide)] = src[f:f + min(n, wide)]
        graph[own] = prune(x, own, np.concatenate((graph[own], more), axis=1), degree, alpha)


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) over the rows of ``x``: neighbours by node, -1 where there are fewer."""
    rng = np.random.default_rng(SEED)
    n = len(x)
    centre = int(((x - x.mean(axis=0)) ** 2).sum(axis=1).argmin())
    entries = np.unique(np.r_[centre, rng.integers(0, n, min(n, ENTRIES - 1))]).astype(np.int32)
    graph = rng.integers(0, n, (n, degree)).astype(np.int32)
    graph[graph == np.arange(n)[:, None]] = -1
    for a, rounds in ((1.0, 4), (alpha, 2)):
        order = rng.permutation(n)
        for part in np.array_split(order, min(rounds, n)):
            found, _ = beam_search(x, graph, entries, x[part], beam)
            graph[part] = prune(x, part, np.concatenate((found, graph[part]), axis=1), degree, a)
            add_reverse(x, graph, part, a)
    return graph, entries


def lifted(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors scaled by the longest and lifted to length one, as floats."""
    s = v / longest
    return np.concatenate((s, np.sqrt(np.maximum(0, 1 - (s * s).sum(axis=1, keepdims=True)))), axis=1).astype(np.float32)


INDEX = "dims int, shard int, ids binary, node binary, vectors binary, graph binary, entries binary"


def _build(g: pd.DataFrame) -> pd.DataFrame:
    """One shard's rows to one index row: ids in rising order and the node of each."""
    d, shard = int(g.dims.iat[0]), int(g.shard.iat[0])
    g = g.sort_values("vec_id", ignore_index=True)
    names, node = np.unique(np.array(g.vec.tolist(), dtype=f"V{8 * d}"), return_inverse=True)
    v = np.frombuffer(names.tobytes(), "<f8").reshape(-1, d)
    graph, entries = build_graph(lifted(v, float(_length(v).max())))
    return pd.DataFrame([(d, shard, g.vec_id.to_numpy("<i8").tobytes(), node.astype("<i4").tobytes(), v.tobytes(),
                          graph.astype("<i4").tobytes(), entries.astype("<i4").tobytes())],
                        columns=[c.split()[0] for c in INDEX.split(", ")])


def _length(v: np.ndarray) -> np.ndarray:
    big = np.abs(v).max(axis=1, keepdims=True)
    return (np.linalg.norm(v / big, axis=1, keepdims=True) * big)[:, 0]


class Shard:
    """One shard's vectors and graph, ready to be asked."""

    def __init__(self, dims: int, ids: bytes, node: bytes, vectors: bytes, graph: bytes, entries: bytes):
        self.ids, node = np.frombuffer(ids, "<i8"), np.frombuffer(node, "<i4")
        self.dims, self.v = dims, np.frombuffer(vectors, "<f8").reshape(-1, dims)
        self.graph = np.frombuffer(graph, "<i4").reshape(len(self.v), -1)
        self.entries = np.frombuffer(entries, "<i4")
        self.x = lifted(self.v, float(_length(self.v).max()))
        # ids of each node, rising: only its k + 1 smallest can matter
        self.order = np.argsort(node, kind="stable")
        self.first = np.searchsorted(node[self.order], np.arange(len(self.v) + 1))

    def ask(self, qid: list[int], vectors: list[bytes], k: int, beam: int) -> pa.RecordBatch:
        """(query_id, vec_id, score): the ``k`` best of this shard for each query."""
        q = matrix(vectors, self.dims)
        # a query's own length does not change its order of inner products
        lift = np.concatenate((q / _length(q)[:, None], np.zeros((len(q), 1))), axis=1).astype(np.float32)
        found, _ = beam_search(self.x, self.graph, self.entries, lift, max(beam, k + 1))
        out = []
        for i in range(len(q)):
            hit = found[i][found[i] >= 0]
            score = (self.v[hit] * q[i]).sum(axis=1)
            own = [self.ids[self.order[self.first[h]:min(self.first[h + 1], self.first[h] + k + 1)]] for h in hit]
            near, s = np.concatenate(own), np.repeat(score, [len(o) for o in own])
            other = near != qid[i]
            near, s = near[other], s[other]
            top = np.lexsort((near, -s))[:k]
            out.append((np.full(len(top), qid[i], np.int64), near[top], s[top]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["query_id", "vec_id", "score"])


def build_index(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shards: int = SHARDS,
                shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, DataFrame]:
    """(vectors, index): the distinct valid vectors, and one graph per shard and vector length."""
    own = stored(packed(rows, id_col, vector_col).where("vec is not null and vec_id is not null")
                 .select("vec_id", "vec", (F.length("vec") / 8).cast("int").alias("dims")).distinct(), "ann-vectors")
    n = max(shards, -(-own.count() // shard_rows))
    dealt = own.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int"))
    dealt = dealt.repartition(SPREAD * n, "dims", "shard")
    return own, stored(dealt.groupBy("dims", "shard").applyInPandas(_build, INDEX), "ann-index")


def search(index: DataFrame, queries: DataFrame, k: int = 20, beam: int = SEARCH_BEAM,
           query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for (query_id, vec, dims) rows the ``k`` best other vectors found."""
    parts = [c.split()[0] for c in INDEX.split(", ")[2:]]
    shards = stored(index.select(F.col("dims").alias("d"), F.col("shard").alias("s")), "ann-shards")  # not the graphs
    asked = (queries.join(shards, F.col("dims") == F.col("d"))
             .select("dims", F.col("s").alias("shard"), F.lit(1).alias("turn"), "query_id", "vec",
                     *(F.lit(None).cast("binary").alias(c) for c in parts)))
    graphs = index.select("dims", "shard", F.lit(0).alias("turn"), F.lit(None).cast("long").alias("query_id"),
                          F.lit(None).cast("binary").alias("vec"), *parts)
    wide = SPREAD * max(1, shards.count())
    rows = graphs.unionByName(asked).repartition(wide, "dims", "shard").sortWithinPartitions("dims", "shard", "turn", "query_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, qid, vecs = None, [], []
        for b in batches:
            turn, query, vec = (b.column(k).to_pylist() for k in (2, 3, 4))
            for i in range(b.num_rows):
                if turn[i] and len(qid) < query_block:
                    qid.append(query[i])
                    vecs.append(vec[i])
                    continue
                if qid:
                    yield shard.ask(qid, vecs, k, beam)
                qid, vecs = ([query[i]], [vec[i]]) if turn[i] else ([], [])
                if not turn[i]:  # the next shard's graph, before its queries
                    shard = Shard(b.column(0)[i].as_py(), *(b.column(c)[i].as_py() for c in parts))
        if qid:
            yield shard.ask(qid, vecs, k, beam)

    near = rows.mapInArrow(run, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(rows: DataFrame, every: int = 20, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
            **index_options) -> DataFrame:
    """The ``k`` nearest others of every vector whose id is divisible by ``every``."""
    own, index = build_index(rows, id_col, vector_col, **index_options)
    asked = own.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), "vec", "dims")
    return search(index, asked, k)
