"""Token files and packing: exact round trips against the tokenizer and a plain packer."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from opslog.llm import huffman, packing, queries
from opslog.llm.tokens import default_path, encoder
from tests.llm.fixtures import docs_df, empty

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(default_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


ODD = ["don't I'LL 'S x's 're'S''t", "a<|endoftext|>b <|startoftext|> <|end", "日本語 テスト　full é É ÀÉ ß ẞ İ ﬁ ŉ ǅ", "\x1c\x1d a\x0bb\x0cc \x85 \xa0x",
       "x​y ź é ́", "１２ 12 ½ ² µ ª º 3a4", "", " ", "\n\t\r", "a\x00b \x7f", "ſt Kelvin K Å", "😀 👍🏽 ok", "--__==3.14", "Σας ΟΔΟΣ", "×÷«»¡¿"]


def test_word_table_equals_the_library(tokenizer):
    texts = ODD + [t for (t,) in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet'").fetchall()]
    texts += [f"a{chr(c)}b" for c in (*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]
    texts += ["".join(random.Random(i).choices("aB'é 3.\n\t<|>ßÜñsdtrevmĺ ", k=60)) for i in range(400)]
    enc = encoder()
    for t in texts:
        assert np.frombuffer(enc.ids(t), "<u2").tolist() == ids_of(tokenizer, t), t


# ---------------------------------------------------------------- Huffman
def test_code_lengths_are_optimal_and_limited():
    import heapq

    rng = random.Random(2)
    for n in (1, 2, 3, 17, 300):
        counts = {i * 7: rng.randint(1, 10 ** rng.randint(1, 6)) for i in range(n)}
        ln = huffman.code_lengths(counts, 40)
        heap = sorted(counts.values())
        cost = 0
        while len(heap) > 1:
            a = heapq.heappop(heap) + heapq.heappop(heap)
            cost += a
            heapq.heappush(heap, a)
        assert sum(counts[i] * ln[i] for i in counts) == (cost if n > 1 else counts[0])
        short = huffman.code_lengths(counts, 10)
        assert max(short.values()) <= 10 and sum(2.0 ** -x for x in short.values()) <= 1
    fib = [1, 1]
    while len(fib) < 40:
        fib.append(fib[-1] + fib[-2])
    assert max(huffman.code_lengths(dict(enumerate(fib)), 18).values()) == 18
    with pytest.raises(ValueError):
        huffman.code_lengths({i: 1 for i in range(5)}, 2)


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
def test_block_round_trip(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 49_000) if n else np.zeros(0, np.int64)
    counts = dict(Counter(ids.tolist())) or {3: 1}
    coded, ln, codes = huffman.canonical(huffman.code_lengths(counts))
    packed_of = np.zeros(1 << 16, np.int64)
    packed_of[coded] = codes << 5 | ln
    payload, checkpoints = huffman.encode(ids, packed_of)
    assert len(payload) == (int((packed_of[ids] & 31).sum()) + 7) // 8
    assert (huffman.decode(payload, checkpoints, n, huffman.decode_table(coded, ln)) == ids).all()


def test_token_files_round_trip(spark, tokenizer):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall()
    want, start = {}, 0
    for d, t in rows:
        ids = ids_of(tokenizer, t) + [2]
        want[d] = (start, len(ids), crc(ids))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op8_token_files(spark, SF).collect()}
    assert got == want


def test_token_files_defined_cases(spark, tokenizer):
    docs = docs_df(spark)
    path = huffman.token_files(docs)
    back = huffman.read_files(spark, path).collect()
    want = sorted(((r.doc_id is not None, r.doc_id), ids_of(tokenizer, r.text) + [2]) for r in docs.collect()
                  if r.doc_id is not None)
    got = sorted(((r.doc_id is not None, r.doc_id), np.frombuffer(r.ids, "<u4").tolist()) for r in back if r.doc_id is not None)
    assert got == want and len(back) == docs.count()
    order = sorted(back, key=lambda r: r.start)
    at = 0
    for r in order:
        assert r.start == at
        at += len(r.ids) // 4
    ids = [r.doc_id for r in order]
    assert ids[:3] == [None] * 3 and ids[3:] == sorted(ids[3:])
    none = empty(docs)
    assert huffman.digest(huffman.read_files(spark, huffman.token_files(none))).count() == 0


# ---------------------------------------------------------------- packing
def plain_best_fit(lengths, capacity):
    seqs = []
    for n in sorted(lengths, reverse=True):
        fit = [i for i, s in enumerate(seqs) if capacity - s >= n]
        if fit:
            seqs[min(fit, key=lambda i: capacity - seqs[i])] += n
        else:
            seqs.append(n)
    return sorted(seqs)


def check_layout(rows, capacity):
    seqs = defaultdict(list)
    for r in rows:
        seqs[r.sequence_id].append((r.offset, r.length))
    for parts in seqs.values():
        at = 0
        for off, n in sorted(parts):
            assert off == at
            at += n
        assert at <= capacity
    return sorted(sum(n for _, n in p) for p in seqs.values())


def test_flows_equal_best_fit_decreasing(spark):
    rng = random.Random(9)
    for capacity, top, n in ((8, 8, 60), (20, 5, 200), (100, 100, 150), (100, 3, 300), (2048, 2048, 200)):
        lengths = [rng.randint(1, top) for _ in range(n)]
        df = spark.createDataFrame([(i, 0, x) for i, x in enumerate(lengths)], "doc_id long, piece int, length int")
        got = packing.pack(df, capacity).collect()
        assert len(got) == n and check_layout(got, capacity) == plain_best_fit(lengths, capacity)


def test_packing_query_matches_tokenizer(spark, tokenizer):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    want = {}
    for d, t in rows:
        ids = ids_of(tokenizer, t) + [0]
        for k, s in enumerate(range(0, len(ids), 2048)):
            want[d, k] = (s, len(ids[s:s + 2048]), crc(ids[s:s + 2048]))
    got = queries.op9_best_fit_packing(spark, SF).collect()
    assert {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in got} == want and len(got) == len(want)
    filled = check_layout(got, 2048)
    assert filled == plain_best_fit([v[1] for v in want.values()], 2048)
    assert len(filled) <= 1.05 * -(-sum(filled) // 2048) + 1


def test_packing_defined_cases(spark, tokenizer):
    docs = docs_df(spark)
    packed = packing.pack_documents(docs)
    got = packed.collect()
    check_layout(got, 2048)
    whole = sum(len(ids_of(tokenizer, r.text)) + 1 for r in docs.collect())
    assert sum(r.length for r in got) == whole
    assert sum(r.doc_id is None and r.piece == 0 for r in got) == 3
    assert packing.pack_documents(empty(docs)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 0, 9)], "doc_id long, piece int, length int"), 8)
    unique = docs.where("doc_id < 100")
    seqs = packing.sequences(packing.pack_documents(unique), unique).collect()
    assert sorted(i for r in seqs for i in r.ids) == sorted(i for r in unique.collect() for i in ids_of(tokenizer, r.text) + [0])


def test_one_hot_length_spreads_over_partitions(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(700).alias("length"))
    got = packing.pack(df, 2048).groupBy("sequence_id").agg(F.count("*").alias("n")).groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in got} == {2: 10_000}
