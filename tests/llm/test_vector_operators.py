"""Vector near-duplicates and nearest neighbours against brute force."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opslog.llm import ann, vecdedup
from tests.llm.fixtures import CLASH

SCHEMA = "vec_id long, embedding array<float>, label int, " + ", ".join(f"{c} string" for c in CLASH if c != "vec_id")
REST = [None] * len(CLASH)


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], y, *REST)
                                  for i, v, y in rows], SCHEMA)


def clustered(n, d=16, seed=0):
    """Random vectors, groups of near copies, one large dense group, exact copies."""
    rng = np.random.default_rng(seed)
    rows = []
    base = rng.normal(size=(n, d))
    for i in range(n):
        v = base[i]
        if i % 3 == 1:
            v = base[i - 1] + rng.normal(size=d) * 0.12
        if i % 5 == 0:
            v = base[0] + rng.normal(size=d) * 0.1
        if i % 11 == 0 and i:
            v = rows[i - 1][1]
        rows.append((i, np.float32(v).tolist(), i % 2 if i % 5 else 0))
    return rows


BAD = [(900, None, 0), (901, [], 0), (902, [0.0] * 16, 0), (903, [float("nan")] * 16, 0), (904, [None] + [1.0] * 15, 0),
       (905, [float("inf")] * 16, 0), (906, [1.0] * 16, None), (907, [1.0] * 3, 0), (908, [2.0] * 3, 0)]


def plain_links(rows, threshold=0.98):
    ok = [(i, np.array(v, float), y) for i, v, y in rows
          if i is not None and y is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = defaultdict(set)
    for a, (i, u, y) in enumerate(ok):
        for j, w, z in ok[:a]:
            if y == z and len(u) == len(w) and i != j and u @ w / np.linalg.norm(u) / np.linalg.norm(w) >= threshold:
                links[i].add(j)
                links[j].add(i)
    comp = {}
    for i in sorted({r[0] for r in rows if r[0] is not None}):
        if i not in comp:
            todo = [i]
            while todo:
                x = todo.pop()
                if x not in comp:
                    comp[x] = i
                    todo += links[x]
    return links, comp


@pytest.mark.parametrize("options", [{}, {"block": 20, "leaf": 40, "trees": 3}])
def test_vector_groups_match_all_pairs(spark, options):
    rows = clustered(400) + BAD
    links, comp = plain_links(rows)
    assert sum(map(len, links.values())) > 1000
    got = vecdedup.vector_groups(frame(spark, rows), **options).collect()
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got} == {
        i: (len(links[i]), comp[i], comp[i] == i) for i, _, _ in rows} and len(got) == len(rows)


def test_trees_cut_and_lose_no_pair():
    rng = np.random.default_rng(3)
    x = vecdedup.unit(rng.normal(size=(4000, 32)))
    y = vecdedup.unit(x + rng.normal(size=x.shape) * 0.1 / np.sqrt(32) * 1.9)  # cosine about 0.98
    band = vecdedup.SPILL * np.sqrt(0.04) / np.sqrt(32) / 2
    near = (x * y).sum(axis=1) >= 0.98
    assert near.sum() > 1000
    met = np.zeros(len(x), bool)
    for seed in range(vecdedup.TREES):
        tree = vecdedup.grow(x, band, 100, np.random.default_rng(seed))
        assert len(tree.cut) > 8
        lx, ly = (defaultdict(set) for _ in range(2))
        for table, pts in ((lx, x), (ly, y)):
            for leaf, own in tree.route(pts, band):
                for i in own:
                    table[int(i)].add(leaf)
        met |= np.array([bool(lx[i] & ly[i]) for i in range(len(x))])
    assert met[near].all()


def test_vector_groups_defined_cases(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [-0.0, 2.0], 1), (4, [0.0, 1.0], 1),
            (5, [0.0, 1.0], 2)]
    got = vecdedup.vector_groups(frame(spark, rows)).collect()
    assert sorted(((r.vec_id or 0), r.n_links, r.component_id) for r in got if r.vec_id) == [
        (1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 3), (4, 1, 3), (5, 0, 5)]
    assert [(r.n_links, r.component_id, r.kept) for r in got if r.vec_id is None] == [(0, None, None)]
    assert vecdedup.vector_groups(frame(spark, [])).count() == 0
    assert [(r.vec_id, r.n_links) for r in vecdedup.vector_groups(frame(spark, BAD[:1])).collect()] == [(900, 0)]


# ---------------------------------------------------------------- neighbours
def plain_nearest(rows, every, k):
    ok = {i: np.array(v, float) for i, v, _ in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q in ok:
        if q % every == 0:
            s = sorted(((-float((v * ok[q]).sum()), i) for i, v in ok.items() if i != q and len(v) == len(ok[q])))
            out[q] = [(i, -x) for x, i in s[:k]]
    return out


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.normal(size=24) * rng.uniform(0.5, 2)).astype(np.float32).tolist(), 0) for i in range(3000)]
    want = plain_nearest(rows, 20, 20)
    got = defaultdict(list)
    for r in ann.nearest(frame(spark, rows), 20, 20, shards=3).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    hits = 0
    vectors = {i: np.array(v, float) for i, v, _ in rows}
    for q, best in want.items():
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert [(-s, i) for _, i, s in mine] == sorted((-s, i) for _, i, s in mine)
        assert all(abs(s - float(vectors[i] @ vectors[q])) < 1e-9 for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & {i for i, _ in best})
    assert hits / (20 * len(want)) >= 0.95


def test_neighbours_small_tables_are_exact(spark):
    rows = clustered(90) + BAD + [(910, rows_v, 0) for rows_v in [[0.5] * 16]] + [(911, [0.5] * 16, 0), (912, [0.5] * 16, 0), (912, [0.5] * 16, 0)]
    want = plain_nearest(rows, 4, 20)
    got = defaultdict(list)
    for r in ann.nearest(frame(spark, rows), 4, 20, shards=2).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    assert set(got) == {q for q, b in want.items() if b}
    for q, mine in got.items():
        assert [i for _, i, _ in sorted(mine)] == [i for i, _ in want[q]]
    assert ann.nearest(frame(spark, [])).count() == 0
    assert ann.nearest(frame(spark, [(20, [1.0], 0)])).count() == 0


def test_query_blocks_and_shards_agree(spark):
    rows = clustered(120)
    own, index = ann.build_index(frame(spark, rows), shards=3)
    asked = own.selectExpr("vec_id AS query_id", "vec", "dims")
    a = ann.search(index, asked, 5).collect()
    b = ann.search(index, asked, 5, query_block=10).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b)) and len(a) == 600


def test_two_common_lengths_get_a_forest_each(spark):
    rng = np.random.default_rng(8)
    rows, plain = [], {}
    for d, n, at in ((6, 900, 0), (9, 700, 10_000), (4, 20, 20_000)):
        base = rng.normal(size=(n // 2, d))
        x = np.concatenate((base, base[: n - n // 2] + rng.normal(0, 0.02, (n - n // 2, d))))
        unit = x / np.linalg.norm(x, axis=1, keepdims=True)
        link = unit @ unit.T >= 0.98
        np.fill_diagonal(link, False)
        for i in range(n):
            rows.append((at + i, x[i].tolist(), "a"))
            plain[at + i] = int(link[i].sum())
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = vecdedup.vector_groups(df, trees=6, leaf=64, block=128, sample=4000)
    assert {r.vec_id: r.n_links for r in got.collect()} == plain
    classes = vecdedup.packed(df, "vec_id", "embedding", "label").select(
        "label", "vec", F.col("vec_id").alias("rep"), F.lit(1).cast("long").alias("n"))
    forests = vecdedup.fit_forests(classes, 0.98, 3, 4000, 64, 128)
    assert [d for d, _, _ in forests] == [6, 9]
    codes = {}
    for r in vecdedup._routed(classes, forests, "<f8").collect():
        for c in r.codes:
            codes.setdefault(c, set()).add(len(r.vec))
    assert all(len(v) == 1 for v in codes.values()) and len(codes) > 12


def test_a_graph_moves_once_however_many_blocks(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(size=5).tolist()) for i in range(300)], "vec_id long, embedding array<double>")
    own, index = ann.build_index(df, shards=3)
    asked = own.where("vec_id % 2 = 0").select(F.col("vec_id").alias("query_id"), "vec", "dims")
    plan = ann.search(index, asked, 5, query_block=7)._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan  # no copies of the index
    one, many = (sorted(map(tuple, ann.search(index, asked, 5, query_block=n).collect())) for n in (1000, 7))
    assert one == many and len(one) == 750
