"""Periodic runs against a plain search over all periods."""

import random
import zlib
from fractions import Fraction
from hashlib import sha256

from hypothesis import given, settings
from hypothesis import strategies as st

from opslog.llm import runs
from tests.llm.fixtures import doc, docs_df, empty

SF = "/root/testdata/sf0.001"


def brute_runs(w, least=24, power=3):
    """Maximal stretches of words equal q apart, for every q, without those of a smaller period."""
    n, out = len(w), []
    for q in range(1, n // power + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            a = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            size = i - a + q
            if size >= max(least, power * q) and not any(
                    all(w[a + t] == w[a + t + r] for t in range(size - r)) for r in range(1, q)):
                out.append((a, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    w = [x for x in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text or "").split(" ") if x]
    n = len(w)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and n:
        a = (h // 10) % n
        p = 1 + (n - a) // (3 + (h // 10) % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = brute_runs(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = None
    for r in found:
        if best is None or Fraction(r[1], r[2]) > Fraction(best[1], best[2]):
            best = r
    lines = "".join(f"{s},{size},{q}\n" for s, size, q in found)
    return (doc_id, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha256(lines.encode()).hexdigest(), sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.integers(1, 12), st.integers(3, 9), st.sampled_from([4, 6, 9, 24]))
def test_runs_equal_plain_search(head, period, times, least):
    words = [b"%d" % k for k in head + (head[-period:] or [0]) * times + head[:7]]
    assert runs.runs_of(words, least) == brute_runs(words, least)


def test_runs_of_few_and_many_words():
    rng = random.Random(4)
    for symbols in (1, 2, 3, 40):
        for _ in range(40):
            w = [b"%d" % rng.randrange(symbols) for _ in range(rng.randrange(130))]
            w += w[len(w) // 2:] * rng.randrange(4)
            assert runs.runs_of(w) == brute_runs(w)


def test_extensions_on_the_tree():
    rng = random.Random(5)
    import numpy as np
    w = np.array([rng.randrange(1, 3) for _ in range(200)])
    tree = runs.Tree(w)
    tree.euler()
    pairs = [(rng.randrange(200), rng.randrange(200)) for _ in range(500)]
    pairs = [(i, j) for i, j in pairs if i != j]
    got = tree.extension(np.array([i for i, _ in pairs]), np.array([j for _, j in pairs]))
    for (i, j), k in zip(pairs, got.tolist()):
        n = 0
        while max(i, j) + n < 200 and w[i + n] == w[j + n]:
            n += 1
        assert n == k
    order = tree.suffixes(False)
    assert order[1:] == sorted(range(200), key=lambda i: w[i:].tolist())


def test_documents_equal_plain_search(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {tuple(r) for r in runs.periodic_runs(docs, planted=True).collect()}
    short = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if len((r.text or "").split()) < 700]
    assert len(short) > 150
    assert {brute_row(*r) for r in short} <= got
    assert any(r[1] for r in got)


def test_awkward_rows(spark):
    line = "a b c d e f g h "
    rows = [doc(1, None), doc(2, ""), doc(3, " \t\r\n\x0b\x0c"), doc(4, line * 9), doc(4, line * 9), doc(None, line * 9),
            doc(None, None), doc(5, "x " * 24), doc(6, "x " * 23), doc(7, ("ab " * 30) + "q " + ("cd ef " * 20)),
            doc(8, "a b " * 30), doc(9, "".join(f"w{i} " for i in range(50_000)) + line * 4_000), doc(10, "x " * 30 + "y " * 30)]
    got = runs.periodic_runs(docs_df(spark, rows))
    out = got.collect()
    assert len(out) == len(rows)
    by = {(r.doc_id): r for r in out}
    assert by[1].n_runs == 0 and by[1].start is None and by[1].collapsed_sha256 == sha256(b"").hexdigest()
    assert (by[4].n_runs, by[4].start, by[4].length, by[4].period, by[4].exponent_milli) == (1, 0, 72, 8, 9000)
    assert by[5].n_runs == 1 and by[6].n_runs == 0
    assert (by[9].n_runs, by[9].start, by[9].length, by[9].period) == (1, 50_000, 32_000, 8)
    assert by[10].start == 0 and by[10].n_runs == 2  # equal exponents: the smaller start
    assert runs.periodic_runs(empty(docs_df(spark))).count() == 0
    kept = {r.doc_id: r.text for r in runs.collapse(docs_df(spark, rows)).collect()}
    assert kept[4] == line.strip() and kept[6] == "x " * 23 and kept[1] is None
    assert runs.collapse(docs_df(spark)).columns == docs_df(spark).columns
