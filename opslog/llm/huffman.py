"""Token-id files: canonical length-limited Huffman codes in independent blocks.

Ids are counted over all documents; package-merge gives optimal code lengths
of at most ``MAX_LENGTH`` bits, and the canonical codes follow from the lengths
alone. The files hold, per block of whole documents, the document ids and
their id counts, the packed bits, and the bit offset of every
``CHECKPOINT``-th id. A block is decoded by one table look-up an id; because
the checkpoints give that many starting points, all of a block's segments are
decoded in step, as vectors. A header table holds the code lengths.

The files are Parquet tables of binary blocks in the shared folder (``codes``
and ``blocks`` under one path), so any store that Spark writes to will do.
Blocks are in rising document order: ``part`` is the file's rank, ``block`` the
rank within it, ``before`` the number of ids before the block in its file.

Defined cases: a null text is empty and still ends with the end id; null ids
sort first; repeated ids stay rows of their own; an empty table makes empty
files; a single distinct id gets a code of one bit.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.llm.common import partitions, stored
from opslog.llm.tokens import encoder
from opslog.session import checkpoint_dir

END = 2
MAX_LENGTH = 18
BLOCK_IDS = 1 << 17
# Text whose words are numbered together: more finds more words equal, and takes some 100 MB more a task.
TEXT_BYTES = 12 << 20
CHECKPOINT = 32
BLOCKS = ("part int, block int, before long, n_ids long, doc_ids array<long>, doc_lengths array<long>, "
          "checkpoints binary, payload binary")


def code_lengths(counts: dict[int, int], limit: int = MAX_LENGTH) -> dict[int, int]:
    """Optimal prefix-code lengths of at most ``limit`` bits (package-merge)."""
    ids = np.array(sorted(counts, key=lambda i: (counts[i], i)), np.int64)
    w = np.array([counts[i] for i in ids.tolist()], np.int64)
    n = len(ids)
    if n < 2:
        return {int(i): 1 for i in ids}
    if n > 1 << limit:
        raise ValueError(f"{n} ids need codes longer than {limit} bits")
    rows, packages = [], np.zeros(0, np.int64)
    for _ in range(limit):
        both = np.concatenate((w, packages))
        order = np.argsort(both, kind="stable")
        rows.append(order < n)  # which of the row's items are ids; those come in rising order of count
        merged = both[order]
        packages = merged[0:len(merged) // 2 * 2].reshape(-1, 2).sum(axis=1)
    lengths, take = np.zeros(n, np.int64), 2 * n - 2
    for row in reversed(rows):
        own = int(row[:take].sum())
        lengths[:own] += 1
        take = 2 * (take - own)
    return dict(zip(ids.tolist(), lengths.tolist()))


def canonical(lengths: dict[int, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ids, lengths, codes) in code order: by length, then id."""
    order = sorted(lengths, key=lambda i: (lengths[i], i))
    ln = np.array([lengths[i] for i in order], np.int64)
    codes, code = np.zeros(len(order), np.int64), 0
    for k in range(1, len(order)):
        code = (code + 1) << int(ln[k] - ln[k - 1])
        codes[k] = code
    return np.array(order, np.int64), ln, codes


def encode(ids: np.ndarray, packed_of: np.ndarray, step: int = CHECKPOINT) -> tuple[bytes, bytes]:
    """(packed bits, bits of each run of ``step`` ids as 16-bit numbers).

    ``packed_of`` holds every id's code, shifted left by 5, and its length.
    """
    got = packed_of[ids]
    ln = got & 31
    ends = np.cumsum(ln)
    at = ends - ln
    total = int(ends[-1]) if len(ids) else 0
    word = at >> 5
    wide = (got >> 5).view(np.uint64) << (64 - ln - (at & 31)).view(np.uint64)
    # codes that begin in the same 32-bit word never overlap, so their sum is their union; what
    # reaches over the word's end goes to the next one
    first = np.flatnonzero(np.diff(word, prepend=-1))
    sums = np.add.reduceat(wide, first) if len(ids) else np.zeros(0, np.uint64)
    words = np.zeros((total + 31) // 32 + 2, np.uint64)
    words[word[first]] += sums >> np.uint64(32)
    words[word[first] + 1] += sums & np.uint64(0xFFFFFFFF)
    runs = np.diff(np.append(at[::step], total)).astype("<u2")
    return words.astype(">u4").tobytes()[:(total + 7) // 8], runs.tobytes()


def decode_table(ids: np.ndarray, ln: np.ndarray) -> tuple[np.ndarray, int]:
    """(id shifted left by 5, and length) of whatever code the next ``bits`` bits begin with."""
    bits = int(ln.max()) if len(ln) else 1
    table = np.ones(1 << bits, np.int64)
    span = 1 << (bits - ln)
    table[:span.sum()] = np.repeat(ids << 5 | ln, span)  # canonical codes fill the table in order
    return table.astype(np.int32), bits


def decode(payload: bytes, checkpoints: bytes, n: int, table: tuple[np.ndarray, int], step: int = CHECKPOINT) -> np.ndarray:
    """The ids of a block; its segments between checkpoints advance together."""
    code, bits = table
    raw = np.frombuffer(payload + bytes(8), np.uint8).astype(np.uint64)
    wide = ((raw[:-4] << np.uint64(32)) | (raw[1:-3] << np.uint64(24)) | (raw[2:-2] << np.uint64(16))
            | (raw[3:-1] << np.uint64(8)) | raw[4:]).view(np.int64)
    runs = np.frombuffer(checkpoints, "<u2").astype(np.int64)
    at, mask = np.cumsum(runs) - runs, (1 << bits) - 1
    out = np.zeros((step, len(at)), np.int32)
    last = n - (len(at) - 1) * step  # ids in the last segment
    for k in range(step):
        live = len(at) if k < last else len(at) - 1
        if live <= 0:
            break
        pos = at[:live]
        got = code[(wide[pos >> 3] >> (40 - bits - (pos & 7))) & mask]
        out[k, :live] = got >> 5
        pos += got & 31
    return out.T.reshape(-1)[:n]


def token_ids(docs: DataFrame, end: int = END, tokenizer: str | None = None,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, counts): ids of the whole text and the end id, as little-endian 16-bit numbers.

    ``counts`` is null but in the last row of each batch, where it has how often each id occurs in the
    batch: a column to be read alone, so that counting does not read the ids again.
    """
    tail = np.array([end], "<u2").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            at = 0
            for ids, offsets in enc.batches(b.column(1), TEXT_BYTES):
                n = len(offsets) - 1
                total = np.bincount(ids, minlength=end + 1)
                total[end] += n
                used = np.flatnonzero(total)
                counts = used.astype("<u2").tobytes() + total[used].astype("<i8").tobytes()
                cuts = offsets.tolist()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(at, n), pa.array([ids[x:y].tobytes() + tail for x, y in zip(cuts, cuts[1:])], pa.binary()),
                     pa.array([None] * (n - 1) + [counts], pa.binary())], ["doc_id", "ids", "counts"])
                at += n

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return src.mapInArrow(run, "doc_id long, ids binary, counts binary")


def count_ids(ids: DataFrame) -> dict[int, int]:
    """How often each id occurs in the whole table: at most one number per vocabulary entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for b in batches:
            for raw in b.column(0).to_pylist():
                n = len(raw) // 10
                total[np.frombuffer(raw, "<u2", n)] += np.frombuffer(raw, "<i8", n, 2 * n)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    sums = (ids.select("counts").where("counts IS NOT NULL").mapInArrow(run, "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("n")))
    return {r["id"]: r["n"] for r in sums.collect()}


def write_files(ids: DataFrame, path: str) -> None:
    """Write the rows of ``token_ids`` in ascending document order as Huffman-coded blocks under ``path``."""
    spark = ids.sparkSession
    coded, ln, codes = canonical(code_lengths(count_ids(ids)))
    packed_of = np.zeros(1 << 16, np.int64)
    packed_of[coded] = codes << 5 | ln
    spark.createDataFrame(list(zip(coded.tolist(), ln.tolist())), "id long, length long").coalesce(1).write.parquet(f"{path}/codes")
    shared = spark.sparkContext.broadcast(packed_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs: list = []
        texts: list[bytes] = []
        held = 0

        def out() -> pa.RecordBatch:
            x = np.frombuffer(b"".join(texts), "<u2")
            payload, checkpoints = encode(x, shared.value)
            row = (part, block, before, len(x), docs, [len(t) // 2 for t in texts], checkpoints, payload)
            types = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()),
                     pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, types)],
                                              [c.split()[0] for c in BLOCKS.split(", ")])

        for b in batches:
            for doc, x in zip(b.column(0), b.column(1)):
                docs.append(doc.as_py())
                texts.append(x.as_py())
                held += len(texts[-1]) // 2
                if held >= BLOCK_IDS:
                    yield out()
                    block, before = block + 1, before + held
                    docs, texts, held = [], [], 0
        if docs:
            yield out()

    # the hash of the ids lets a document id that many rows hold spread over files
    tie = F.xxhash64("ids")
    (ids.select("doc_id", "ids").repartitionByRange(partitions(spark), "doc_id", tie).sortWithinPartitions("doc_id", tie)
     .mapInArrow(run, BLOCKS).write.parquet(f"{path}/blocks"))


def read_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document: ids as little-endian 32-bit numbers."""
    rows = spark.read.parquet(f"{path}/codes").collect()  # one per id in use
    coded, ln, _ = canonical({r["id"]: r["length"] for r in rows})
    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    files = sorted((r["part"], r["n"]) for r in blocks.groupBy("part").agg(F.sum("n_ids").alias("n")).collect())
    first, total = {}, 0
    for part, n in files:
        first[part], total = total, total + n
    shared = spark.sparkContext.broadcast((coded, ln, first))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coded, ln, first = shared.value
        table = decode_table(coded, ln)
        for b in batches:
            for i in range(b.num_rows):  # one block in Python at a time
                r = b.slice(i, 1).to_pylist()[0]
                x = decode(r["payload"], r["checkpoints"], r["n_ids"], table).astype("<u4")
                ends = np.cumsum(r["doc_lengths"], dtype=np.int64)
                starts = ends - np.array(r["doc_lengths"], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(r["doc_ids"], pa.int64()), pa.array(starts + first[r["part"]] + r["before"]),
                     pa.array([x[a:z].tobytes() for a, z in zip(starts.tolist(), ends.tolist())], pa.binary())],
                    ["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, ids binary")


def digest(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of decoded files."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [x.as_py() for x in b.column(2)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(x) // 4 for x in raw], pa.int64()),
                 pa.array([zlib.crc32(x) for x in raw], pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, path: str | None = None, end: int = END, tokenizer: str | None = None,
                id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode every document into files under ``path`` (a new one in the shared folder if not given)."""
    path = path or f"{checkpoint_dir(docs.sparkSession)}/llm/token-files-{uuid.uuid4().hex}"
    write_files(stored(token_ids(docs, end, tokenizer, id_col, text_col), "ids", "zstd"), path)
    return path
