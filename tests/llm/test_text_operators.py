"""Language id, quality, SimHash: against plain versions and held-out labels."""

import re
import zlib
from collections import defaultdict

import duckdb
import pytest
import xxhash

from opslog.llm import langid, quality, simhash
from opslog.llm.common import connected_components
from tests.llm.fixtures import DE, EN, doc, docs_df, empty

SF = "/root/testdata/sf0.01"


def outside(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


# ---------------------------------------------------------------- language
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: r for r in langid.classify(docs, langid.train(docs)).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    right = [got[d].lang_pred == lang for d, t, lang in rows if outside(d) and lang and t]
    assert sum(right) / len(right) > 0.96
    assert all(got[d].held_out == outside(d) and 0 <= got[d].score <= 1 for d, _, _ in rows)


def test_language_learns_nothing_from_held_out_rows_or_source(spark):
    rows = [doc(i, (EN if i % 2 else DE) + str(i), "en" if i % 2 else "de") for i in range(60)]
    a = langid.train(docs_df(spark, rows))
    b = langid.train(docs_df(spark, [(*r[:2], "zz" if outside(r[0]) else r[2], "other", *r[4:]) for r in rows]))
    assert a == b and {x for x, _ in a} == {"en", "de"}


def test_letters():
    assert langid.letters("Ab-3 ÇD_é\n½²") == "ab çd é ½²" and langid.letters("½ ² Ⅷ. 12 _") == "" and langid.letters("日本 1") == "日本"


def test_language_defined_cases(spark):
    docs = docs_df(spark)
    model = langid.train(docs)
    got = langid.classify(docs, model).collect()
    assert len(got) == docs.count()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    for i in (100, 101, 102, 103, 110):
        assert by[i][0].lang_pred == "und" and by[i][0].score == 0 and not by[i][0].accepted
    assert len(by[106]) == 2 and len(by[None]) == 3
    assert all(r.lang_pred == "de" for i in range(60, 100) for r in by[i])
    kept = langid.accepted_rows(docs, model)
    assert kept.schema == docs.schema and kept.count() == sum(r.accepted for r in got)
    none = empty(docs)
    assert langid.train(none) == [] and langid.classify(none, []).count() == 0
    assert {r.lang_pred for r in langid.classify(docs, []).collect()} == {"und"}


def plain_prediction(dictionaries, text):
    """The dictionary under which zstd makes the whole text smallest, None where two tie."""
    import zstandard as z

    total = []
    for _, raw in dictionaries:
        d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
        c = z.ZstdCompressor(level=langid.LEVEL, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False)
        t = langid.letters(text)
        total.append(sum(len(c.compress(t[i:i + 4096].encode())) for i in range(0, len(t), 4096)))
    low = min(total)
    return dictionaries[total.index(low)][0] if total.count(low) == 1 else None


def test_predictions_equal_plain_compressed_sizes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    dictionaries = langid.train(docs)
    got = {r.doc_id: r.lang_pred for r in langid.classify(docs, dictionaries).collect()}
    texts = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect() if r.text and langid.letters(r.text)][:300]
    plain = {d: plain_prediction(dictionaries, t) for d, t in texts}
    assert sum(v is not None for v in plain.values()) > 250
    assert all(got[d] == v for d, v in plain.items() if v is not None)


def test_two_languages_and_no_known_language_are_rejected(spark):
    """Planted: halves in two languages, invented words and random letters; clean texts stay."""
    import random

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    dictionaries = langid.train(docs)
    bounds = langid.fit_bounds(docs, dictionaries)
    model = langid.Model(tuple(dictionaries))
    rng = random.Random(3)
    own = {}
    for r in docs.where("lang IS NOT NULL AND length(text) BETWEEN 1500 AND 9000").select("doc_id", "text", "lang").collect():
        words = r.text.split()  # a word repeated over and over is no language
        if outside(r.doc_id) and model.predict(r.text).lang == r.lang and len(set(words)) > len(words) / 3:
            own.setdefault(r.lang, []).append(langid.letters(r.text))

    def halves():
        a, b = rng.sample(sorted(own), 2)
        return rng.choice(own[a])[:700] + " " + rng.choice(own[b])[:700]

    def invented():
        syllables = [rng.choice("bcdfghjklmnpqrstvwz") + rng.choice("aeiou") + rng.choice(["", "n", "k", "z"]) for _ in range(40)]
        return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 4))) for _ in range(150))

    def letters_only():
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(2, 9))) for _ in range(150))

    for make, least in ((halves, 0.95), (invented, 0.98), (letters_only, 0.98)):
        rejected = [not bounds.accept(model.predict(make())) for _ in range(200)]
        assert sum(rejected) / 200 >= least, make.__name__
    clean = [t for texts in own.values() for t in texts]
    assert sum(bounds.accept(model.predict(t)) for t in clean) / len(clean) >= 0.99
    held = langid.classify(docs, dictionaries, bounds=bounds).where("held_out AND lang_pred <> 'und'").collect()
    assert sum(r.accepted for r in held) / len(held) >= 0.985


def plain_bounds(docs, dictionaries, sample_docs):
    """The bounds of gain and share from lists of all training rows outside the dictionaries."""
    model, hashes, rows = langid.Model(tuple(dictionaries)), defaultdict(set), []
    for r in docs.select("doc_id", "text", "lang").collect():
        if not outside(r.doc_id):
            h = xxhash.xxh64(r.doc_id.to_bytes(8, "little"), seed=42).intdigest() % (1 << 30)
            hashes[r.lang].add(h)
            rows.append((r.lang, h, r.text))
    top = {lang: sorted(hs)[:sample_docs][-1] for lang, hs in hashes.items()}
    found = [model.predict(text) for lang, h, text in rows if h > top[lang]]
    gains = sorted(f.gain for f in found if f.letters >= langid.GAIN_LETTERS)
    shares = sorted((f.share for f in found), reverse=True)
    return (min(langid.MIN_GAIN, gains[int(langid.HELD_BACK * len(gains))]),
            max(langid.MAX_SHARE, shares[int(langid.HELD_BACK * len(shares))]), len(found))


def test_bounds_are_fitted_on_every_training_row_outside_the_dictionaries(spark):
    """Sixty planted rows among 3000, a handful of them in any two samples a language."""
    import random

    rng = random.Random(5)

    def text(words, n):
        return " ".join(rng.choices(words.split(), k=n))

    rows = [doc(i, text((EN, DE)[i % 2], 20 + i % 150), ("en", "de")[i % 2]) for i in range(3000)]
    for i in rng.sample(range(3000), 60):  # half of them in two languages, half in none
        odd = text(EN, 20 + i % 150) + " " + text(DE, 20 + i % 140) if i % 4 < 2 else "".join(
            rng.choices("abcdefghijklmnopqrstuvwxyz   ", k=200 + i % 300))
        rows[i] = doc(i, odd, rows[i][2])
    docs = docs_df(spark, rows)
    for sample_docs in (60, 200):
        dictionaries = langid.train(docs, sample_docs=sample_docs)
        gain, share, n = plain_bounds(docs, dictionaries, sample_docs)
        assert n > 1500 and gain < langid.MIN_GAIN and share > langid.MAX_SHARE
        bounds = langid.fit_bounds(docs, dictionaries, sample_docs=sample_docs)
        assert bounds == (langid.MIN_MARGIN, gain, share)
        rows = langid.classify(docs, dictionaries, bounds=bounds)
        once = langid.classify_fitted(docs, dictionaries, sample_docs=sample_docs)
        assert once.columns == rows.columns and sorted(once.collect()) == sorted(rows.collect())
        assert langid.accepted_rows(docs, dictionaries, bounds=bounds).count() == once.where("accepted").count()


def test_fitted_classification_of_awkward_rows(spark):
    docs = docs_df(spark)
    model = langid.train(docs)
    once, rows = langid.classify_fitted(docs, model), langid.classify(docs, model, bounds=langid.fit_bounds(docs, model))
    assert sorted(map(str, once.collect())) == sorted(map(str, rows.collect())) and once.count() == docs.count()
    assert langid.classify_fitted(empty(docs), []).count() == 0 and langid.fit_bounds(empty(docs), []) == langid.Bounds()
    assert {r.lang_pred for r in langid.classify_fitted(docs, []).collect()} == {"und"}


def test_ranked_value_is_exact(spark):
    import random

    rng = random.Random(1)
    for values in ([0.25], [-0.5] * 7, [rng.choice((-1e-300, 0.0, 1e-9, 0.5)) for _ in range(50)],
                   [rng.gauss(0, 1) ** 5 for _ in range(400)], [1 - 2.0 ** -k for k in range(54)]):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
        for k in {0, len(values) // 3, len(values) - 1}:
            assert langid._ranked(df, "v", k) == sorted(values)[k]


# ---------------------------------------------------------------- quality
def test_quality_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.score(docs, quality.train(docs, labels)).collect()}
    rows = duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet' WHERE quality IS NOT NULL").fetchall()
    right = [got[d].predicted == q for d, q in rows if outside(d) and d in got]
    assert len(got) == docs.count() and sum(right) / len(right) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_factorisation_identity():
    import numpy as np

    rng = np.random.default_rng(1)
    m = quality.Machine(np.zeros((len(quality.STATS), quality.BINS)), 0.3, rng.normal(size=40), rng.normal(size=(40, 3)))
    idx, val = np.array([1, 5, 7, 30]), rng.normal(size=4)
    plain = 0.3 + sum(m.weight[i] * x for i, x in zip(idx, val)) + sum(
        float(m.vectors[idx[a]] @ m.vectors[idx[b]]) * val[a] * val[b] for a in range(4) for b in range(a))
    assert m.logit(idx, val) == pytest.approx(plain)


def test_quality_defined_cases(spark):
    docs = docs_df(spark)
    labels = spark.createDataFrame([(i, i % 2, None, "x") for i in range(100)] + [(None, 1, 0, "x"), (3, None, 0, "x"), (4, 7, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    model = quality.train(docs, labels)
    got = quality.score(docs, model).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    good = quality.good_rows(docs, model)
    assert good.schema == docs.schema and good.count() == sum(r.predicted for r in got)
    for none in (empty(labels), labels.where("doc_id = 4")):
        assert {r.score for r in quality.score(docs, quality.train(docs, none)).collect()} == {0.5}
    assert quality.score(empty(docs), model).count() == 0
    again = quality.train(docs.repartition(5), labels)
    assert (again.weight == model.weight).all()


# ---------------------------------------------------------------- SimHash
def plain_fingerprint(text, k=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(fps, bits=2):
    """{row: smallest linked id} over (id, fingerprint) rows, by comparing all with all."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(fps):
        for j in range(i):
            if bin(a ^ fps[j][1]).count("1") <= bits:
                parent[find(i)] = find(j)
    low = defaultdict(lambda: 1 << 62)
    for i, (d, _) in enumerate(fps):
        low[find(i)] = min(low[find(i)], d)
    return [low[find(i)] for i in range(len(fps))]


def test_simhash_matches_all_pairs(spark):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY 1").fetchall()
    fps = [(d, plain_fingerprint(t)) for d, t in rows]
    want = dict(zip((d for d, _ in rows), plain_groups(fps)))
    got = simhash.simhash_groups(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {d: (f"{f:016x}", want[d]) for d, f in fps}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_ball_links_join_chains_and_top_bits(spark):
    rng = __import__("random").Random(4)
    fps = {0, (1 << 64) - 1, 1 << 63}
    for _ in range(40):  # chains of near neighbours
        x = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            fps.add(x)
            for _ in range(rng.randint(1, 3)):
                x ^= 1 << rng.randrange(64)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.ball_links(spark.createDataFrame([(f,) for f in signed], "fp long"), 2)
    label = {r.node: r.component for r in connected_components(links).collect()}
    ids = {f: i for i, f in enumerate(fps)}
    want = plain_groups([(ids[f], f) for f in fps])
    groups = defaultdict(set)
    for f, s in zip(fps, signed):
        groups[label.get(s, s)].add(f)
    low = {f: min(ids[g] for g in group) for group in groups.values() for f in group}
    assert [low[f] for f in fps] == want
    with pytest.raises(ValueError):
        simhash.ball_links(links.toDF("fp", "x"), 3)


def test_simhash_defined_cases(spark):
    docs = docs_df(spark)
    got = simhash.simhash_groups(docs).collect()
    assert len(got) == docs.count()
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    assert all(by[i].fingerprint == "0" * 16 and by[i].component_id == 100 for i in (100, 101, 102, 110))
    assert by[106].component_id == by[105].component_id
    assert all(r.component_id is None for r in got if r.doc_id is None)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    named = [i for i in ids if i is not None]
    assert sorted(named) == sorted({r.component_id for r in got if r.component_id is not None}) and ids.count(None) == 3
    assert simhash.simhash_groups(empty(docs)).count() == 0 and simhash.keep_one(empty(docs)).count() == 0


def test_keep_one_of_an_id_with_two_texts(spark):
    a, b, c = ("alpha beta gamma delta epsilon", "one two three four five six", "red green blue black white")
    rows = [doc(1, c), doc(5, a), doc(5, b), doc(5, c), doc(7, b), doc(7, b), doc(9, EN, source="y"), doc(9, EN, source="x")]
    for df in (docs_df(spark, rows), docs_df(spark, rows[::-1]).repartition(3)):
        got = sorted((r.doc_id, r.text, r.source) for r in simhash.keep_one(df).collect())
        assert got == sorted([(1, c, "a"), (5, a, "a"), (5, b, "a"), (9, EN, "x")])


def test_components_long_chain_and_star(spark):
    edges = [(i, i + 1) for i in range(0, 200)] + [(1000, 1000 + i) for i in range(300)] + [(5, 5)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert set(got.values()) == {0, 1000} and len(got) == 501
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_quality_scores_equal_the_explicit_pair_sum(spark):
    """Whole texts scored by the sum over all pairs of features, without the identity."""
    import numpy as np

    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels, train_rows=400)
    texts = {r.doc_id: r.text for r in docs.where("length(text) < 3000").limit(40).collect()}
    got = {r.doc_id: r.score for r in quality.score(docs, model).collect()}
    for d, text in texts.items():
        idx, val = model.row(*quality.features(text))
        x = model.vectors[idx] * val[:, None]
        pairs = np.triu(x @ x.T, 1).sum()
        z = model.bias + sum(model.weight[i] * v for i, v in zip(idx, val)) + pairs
        assert got[d] == pytest.approx(1 / (1 + np.exp(-np.clip(z, -30, 30))), abs=1e-9)
