"""Language identification by compression with per-language zstandard dictionaries.

Each language gets a raw-content dictionary from a bounded sample of its
training texts. A whole text, in blocks, is compressed with every dictionary;
the language of the smallest output wins. The relative margin to the second
smallest is the confidence, and texts with a narrow margin are rejected.

The margin of a whole text cannot tell a text in two languages, or in none of
them, so two more margins are judged: the share of a text's small blocks
(``JUDGE_CHARS``) that the runner-up compresses better than the winner, and the
gain of the winner's dictionary over none at all (for texts of ``GAIN_LETTERS`` or
more; less text gains next to nothing in any language). Their bounds are fitted
on all training rows outside the dictionaries, each judged by its whole text: at
most ``HELD_BACK`` of those rows fall on the wrong side of each.

Equal sizes, as of very short texts, are told apart by the bytes that the text
adds to a carrier of the dictionary's language. Text is lower-cased and everything but letters becomes one blank, so markup
and punctuation do not count. Blocks keep a long text from serving as its own
dictionary, and the whole text is always read.

Sample bound, of the dictionaries alone: at most ``SAMPLE_DOCS`` texts a language,
chosen by a hash of the id over all training rows, and ``DICTIONARY_BYTES`` of
their letters.

Defined cases: null texts and texts without a letter get ``und``, score 0 and
are rejected; with no training rows at all every text gets ``und``; what still
ties goes to the language with more training rows, then by name; null ids count as training
rows; repeated rows come out as often as they came in.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opslog.llm.common import held_out, map_texts, stored

UND = "und"
SAMPLE_DOCS = 600
DICTIONARY_BYTES = 96 * 1024
BLOCK_CHARS = 4096
# The lazy matcher of this level finds the short matches that tell short texts apart.
LEVEL = 6
# Texts too short for any output to shrink tie; they are compressed again behind a carrier from
# the dictionary, whose own size is subtracted.
CARRIER_BYTES = 2048
TIE_LEVEL = 12
# Relative size margin below which a text is rejected, and the margin that scores one half.
MIN_MARGIN = 0.002
HALF_MARGIN = 0.01

# Characters of the blocks whose languages must agree; the last one counts if it is half as long.
JUDGE_CHARS = 320
GAIN_LETTERS = 100
# Share of the training rows outside the dictionaries that each fitted bound may reject.
HELD_BACK = 0.002
# Bounds without enough such rows to fit them, and the strictest that a fit may come to.
MIN_GAIN, MAX_SHARE = 0.03, 0.25
FEWEST_ROWS = 500
# Bins of one round of the exact search for a bound.
BINS = 1024
# Hashes of ids fall below this.
SPAN = 1 << 30
FIGURES = "lang_pred string, score double, margin double, gain double, share double, letters long"

_OTHER = re.compile(r"[\W\d_]+")


_PLAIN_LETTER = re.compile("[a-z]")


def letters(text: str) -> str:
    """Lower-case runs of letters, one blank between them; empty if there is no letter."""
    out = _OTHER.sub(" ", text.lower()).strip()
    # what is left may still be numerals without a decimal value, such as fractions
    return out if _PLAIN_LETTER.search(out) or any(map(str.isalpha, out)) else ""


def _drawn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample_docs: int) -> tuple[dict[str, int], Column, Column]:
    """The languages' training row counts, and conditions on ``docs``: training rows of the dictionaries, and all others."""
    training = ~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
    rows = docs.where(training).select(F.col(lang_col).alias("l"), _hash(id_col).alias("h"))
    counts = {r[0]: r[1] for r in rows.groupBy("l").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return counts, F.lit(False), F.lit(False)
    # a hash threshold per language leaves about three samples' hashes, cut to one sample's afterwards
    keep = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, min(SPAN, 3 * SPAN * sample_docs // n))])
    ids = (rows.where(F.col("h") < keep[F.col("l")]).groupBy("l").agg(F.sort_array(F.collect_set("h")).alias("hs"))
           .select("l", F.col("hs")[F.least(F.lit(sample_docs), F.size("hs")) - 1].alias("top")))
    top = F.create_map(*[F.lit(x) for r in ids.collect() for x in (r["l"], r["top"])])
    chosen = F.coalesce(_hash(id_col) <= top[F.col(lang_col)], F.lit(False))
    return counts, training & chosen, training & ~chosen


def _hash(id_col: str) -> Column:
    return F.pmod(F.xxhash64(F.col(id_col)), F.lit(SPAN))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_docs: int = SAMPLE_DOCS, dictionary_bytes: int = DICTIONARY_BYTES) -> list[tuple[str, bytes]]:
    """(language, dictionary) for every language of the training rows, the most frequent first."""
    counts, chosen, _ = _drawn(docs, id_col, text_col, lang_col, sample_docs)
    if not counts:
        return []
    # many short pieces rather than a few whole texts: one mislabelled text must not fill a dictionary
    each = {lang: max(1, dictionary_bytes * 5 // 4 // min(n, sample_docs)) for lang, n in counts.items()}
    most = F.create_map(*[F.lit(x) for lang, n in each.items() for x in (lang, 4 * n)])
    texts = (docs.where(chosen).select(F.col(lang_col).alias("l"), _hash(id_col).alias("h"), F.col(text_col).alias("t")).groupBy("l", "h")
             .agg(F.max(F.substr(F.col("t"), F.lit(1), most[F.col("l")])).alias("t")).collect())
    out = []
    for lang in sorted(counts, key=lambda x: (-counts[x], x)):
        own = [letters(r["t"])[:each[lang]] for r in sorted((r for r in texts if r["l"] == lang), key=lambda r: r["h"])]
        raw = " ".join(x for x in dict.fromkeys(own) if x).encode()
        out.append((lang, raw[-dictionary_bytes:]))
    return out


class Bounds(NamedTuple):
    """What an accepted text must have: margin, gain (if it is long enough) and share of blocks for another language."""

    margin: float = MIN_MARGIN
    gain: float = MIN_GAIN
    share: float = MAX_SHARE

    def accept(self, found: "Found") -> bool:
        return (found.lang != UND and found.margin >= self.margin and found.share <= self.share
                and (found.letters < GAIN_LETTERS or found.gain >= self.gain))

    def accepted(self) -> Column:
        """The same on rows of figures."""
        return ((F.col("lang_pred") != UND) & (F.col("margin") >= self.margin) & (F.col("share") <= self.share)
                & ((F.col("letters") < GAIN_LETTERS) | (F.col("gain") >= self.gain)))


class Found(NamedTuple):
    """A prediction and what it is judged by."""

    lang: str
    score: float
    margin: float
    gain: float = 0.0
    share: float = 0.0
    letters: int = 0


def _ranked(values: DataFrame, column: str, rank: int) -> float:
    """The value at ``rank`` (from 0, ascending) of all rows, exactly: rounds of counts in ever narrower bins."""
    low, high = values.agg(F.min(column), F.max(column)).first()
    while low < high:
        place = (F.col(column) - low) / (high - low) * BINS
        bins = (values.where(F.col(column).between(low, high)).groupBy(F.floor(place).alias("bin"))
                .agg(F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high")).collect())
        for b in sorted(bins):
            if rank < b["n"]:
                low, high = b["low"], b["high"]
                break
            rank -= b["n"]
    return low


def _bounds(figures: DataFrame) -> Bounds:
    """Bounds of gain and share from all rows of a stored table, counted and searched, never gathered."""
    long, poor, mixed = F.col("letters") >= GAIN_LETTERS, F.col("gain") < MIN_GAIN, F.col("share") > MAX_SHARE
    n, n_long, n_poor, n_mixed = figures.agg(F.count("*"), F.count_if(long), F.count_if(long & poor), F.count_if(mixed)).first()
    if n_long < FEWEST_ROWS:
        return Bounds()
    # the bounds only give way where more rows than may be held back lie beyond them
    may_gain, may_share = int(HELD_BACK * n_long), int(HELD_BACK * n)
    gain = _ranked(figures.where(long & poor), "gain", may_gain) if n_poor > may_gain else MIN_GAIN
    share = _ranked(figures.where(mixed), "share", n_mixed - 1 - may_share) if n_mixed > may_share else MAX_SHARE
    return Bounds(MIN_MARGIN, gain, share)


def fit_bounds(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> Bounds:
    """Bounds from all training rows outside the dictionaries (those of ``train`` with the same ``sample_docs``)."""
    _, _, others = _drawn(docs, id_col, text_col, lang_col, sample_docs)
    rows = _figures(docs.where(others).select(F.col(text_col).alias("t")), dictionaries)
    return _bounds(stored(rows.select("gain", "share", "letters"), "language-bounds"))


class Model:
    """One compressor per language, and one with a carrier for ties."""

    def __init__(self, dictionaries: tuple[tuple[str, bytes], ...]):
        import zstandard as z

        self.langs = [lang for lang, _ in dictionaries]

        def compressor(raw: bytes, level: int):
            d = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=level)
            return z.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False,
                                    write_dict_id=False).compress

        self.compress = [compressor(raw, LEVEL) for _, raw in dictionaries]
        self.plain = z.ZstdCompressor(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False).compress
        self.ties = []
        for _, raw in dictionaries:
            k = min(CARRIER_BYTES, len(raw) // 8)
            c, carrier = compressor(raw[k:], TIE_LEVEL), raw[:k] + b" "
            self.ties.append((c, carrier, len(c(carrier))))

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of the whole text under each language."""
        blocks = [text[i:i + BLOCK_CHARS].encode() for i in range(0, len(text), BLOCK_CHARS)]
        return [sum(len(c(b)) for b in blocks) for c in self.compress]

    def predict(self, text: str | None) -> Found:
        text = letters(text or "")
        if not text or not self.langs:
            return Found(UND, 0.0, 0.0)
        sizes = self.sizes(text)
        gain = 1 - min(sizes) / sum(len(self.plain(text[i:i + BLOCK_CHARS].encode())) for i in range(0, len(text), BLOCK_CHARS))
        if len(self.langs) == 1:
            return Found(self.langs[0], 1.0, 1.0, gain, 0.0, len(text))
        first, second = sorted(sizes)[:2]
        if first == second:
            raw, total = text.encode(), first
            sizes = [s - first + len(c(carrier + raw)) - n for s, (c, carrier, n) in zip(sizes, self.ties)]
            first, second = sorted(sizes)[:2]
            margin = min(1.0, (second - first) / total)
        else:
            margin = (second - first) / second
        best = sizes.index(first)
        other = min((k for k in range(len(sizes)) if k != best), key=lambda k: (sizes[k], k))
        return Found(self.langs[best], margin / (margin + HALF_MARGIN), margin, gain, self.share(text, best, other), len(text))

    def share(self, text: str, best: int, other: int) -> float:
        """Share of the text's small blocks that language ``other`` compresses better than ``best``."""
        if len(text) < 3 * JUDGE_CHARS // 2:
            return 0.0
        blocks = [text[i:i + JUDGE_CHARS].encode() for i in range(0, len(text) - JUDGE_CHARS // 2, JUDGE_CHARS)]
        a, b = self.compress[best], self.compress[other]
        return sum(len(b(x)) < len(a(x)) for x in blocks) / len(blocks)


@lru_cache(maxsize=2)
def _model(dictionaries: tuple[tuple[str, bytes], ...]) -> Model:
    return Model(dictionaries)


def _figures(rows: DataFrame, dictionaries: list[tuple[str, bytes]]) -> DataFrame:
    """``rows`` with the figures of their last column, the text, in its place; one narrow pass."""
    shared = rows.sparkSession.sparkContext.broadcast(tuple(dictionaries))
    schema = T.StructType([*rows.schema.fields[:-1], *T.StructType.fromDDL(FIGURES).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for b in batches:
            got = [model.predict(t.as_py()) for t in b.column(b.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array([f.lang for f in got], pa.string()),
                 *(pa.array([f[k] for f in got], pa.float64()) for k in (1, 2, 3, 4)),
                 pa.array([f.letters for f in got], pa.int64())], schema.names)

    return map_texts(rows, run, schema)


def _verdicts(figures: DataFrame, bounds: Bounds) -> DataFrame:
    return figures.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score", "margin", "gain", "share",
                          bounds.accepted().alias("accepted"))


def classify(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text",
             bounds: Bounds = Bounds()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, gain, share, accepted), one row per row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return _verdicts(_figures(rows, dictionaries), bounds)


def classify_fitted(docs: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``classify`` with the bounds of ``fit_bounds``; every text is compressed once, its figures are stored."""
    _, _, others = _drawn(docs, id_col, text_col, lang_col, sample_docs)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), others.alias("fits"), F.col(text_col).cast("string").alias("t"))
    figures = stored(_figures(rows, dictionaries), "language-figures")
    return _verdicts(figures, _bounds(figures.where("fits")))


def accepted_rows(docs: DataFrame, dictionaries: list[tuple[str, bytes]], text_col: str = "text",
                  bounds: Bounds = Bounds()) -> DataFrame:
    """The rows of ``docs`` that are not rejected, unchanged, in one narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(dictionaries))
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared.value)
        for b in batches:
            yield b.filter(pa.array([bounds.accept(model.predict(t.as_py())) for t in b.column(at)], pa.bool_()))

    return map_texts(docs, run, docs.schema)
