"""The z-fast trie against a plain dictionary of all prefixes."""

import math
import random
import zlib
from collections import defaultdict
from hashlib import sha256

from pyspark.sql import functions as F

from opslog.llm import prefixtrie

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    by = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            by[c].append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v, key=lambda t: t[:2])] for c, v in by.items()}
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def brute(rows):
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    leaves, saved = defaultdict(int), defaultdict(int)
    for c, turns in rebuilt(rows).items():
        turns = tuple(turns)
        ends[turns].append(c)
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
            if d < len(turns):
                kids[turns[:d]].add(turns[d])
    for node, own in members.items():
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(own) - 1) * len(node[-1][1].encode()) if node else 0
            leaves[node[:d]] += not kids[node]
    return [(min(own), len(node), min(members[node[:-1]]) if node else None, len(own), len(kids[node]), leaves[node], saved[node],
             sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest()) for node, own in members.items()]


def same(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = prefixtrie.conversation_trie(df).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(rows)))


def test_table(spark):
    same(spark, [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()])


def test_shared_heads_nulls_chains_and_a_hot_sequence(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "CHUNK", 8)
    monkeypatch.setattr(prefixtrie, "BATCHES", (16, 48))
    rng = random.Random(3)
    rows = {}
    for _ in range(250):
        key = (rng.choice([None, *range(-7, 40)]), rng.choice([None, 0, 1, 2, 3, 5, 6, 7]))
        rows[key] = (*key, rng.choice(["u", "a", None]), rng.choice(["x", "y", None, "", "é"]))
    rows = list(rows.values())
    rows += [(100 + c, t, "u", "abc" if t < 60 or c % 3 else f"z{c}") for c in range(8) for t in range(5 + c * 9)]  # prefixes of each other
    rows += [(c, 0, "u", "solo") for c in range(1000, 1150)]  # a third of the conversations are one
    rows += [(7000 + k, t, "u", f"t{t}") for k, n in ((0, 30), (1, 26)) for t in range(n)]  # over several chunks
    same(spark, rows)


def test_ends_longer_than_a_text_of_ids(spark, monkeypatch):
    monkeypatch.setattr(prefixtrie, "ENDS", 7)
    ends = spark.range(1000).select(F.lit(1).cast("long").alias("h1"), (F.col("id") % 3).alias("h2"), F.col("id").alias("conv"))
    got = {r.h2: r.ends_sha256 for r in prefixtrie.end_digests(ends).collect()}
    assert got == {k: sha256(",".join(str(i) for i in range(1000) if i % 3 == k).encode()).hexdigest() for k in range(3)}


def test_two_fattest(spark):
    pairs = [(a, b) for a in range(0, 40) for b in range(a + 1, 41)]
    got = spark.createDataFrame(pairs, "a long, b long").select("a", "b", prefixtrie.two_fattest(F.col("a"), F.col("b")).alias("f"))
    for r in got.collect():
        assert r.f == max(range(r.a + 1, r.b + 1), key=lambda x: x & -x)


def test_empty_clashing_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert prefixtrie.conversation_trie(none).count() == 0
    clash = [1, 3]  # ids whose base is absent and whose few turns their shared head replaces
    rows = [(c, 0, "u", "x") for c in clash]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("conv", "pos", "h1", "chunk", "names", "total")})
    got = sorted(map(str, (tuple(r) for r in prefixtrie.conversation_trie(df).collect())))
    assert got == sorted(map(str, brute(rows)))
