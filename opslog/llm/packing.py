"""Best-fit packing of token pieces into sequences of bounded length.

Best-fit decreasing over length counts. Pieces are range-sorted by falling
length and get their global rank from per-partition counts. Lengths are
integers up to the capacity, so pieces and gaps fall into at most ``capacity``
size classes, and only the number of pieces and gaps in a class matters. One
loop on the driver over these counts places a whole class of pieces a step: the
gap classes from the smallest that fits upward (the successor) are filled with
as many of the pieces as they hold, the k-th piece of the class takes the k-th
place, the gaps move to the class of what remains, and the next class follows.
Pieces that fit no gap open new sequences. This is exactly best-fit decreasing.
The result is a list of flows (ranks from .. to go to sequences from .. at
offset ..), whose number depends on the capacity and not on the data; every
piece then finds its flow by successor search on its rank, in all tasks at
once. Gaps are never rows of a table: distributed sweeps would need a round of
jobs for each of up to ``capacity`` classes, one after the other, for numbers
that fit in one list. Nothing of the documents but the class counts reaches the
driver.

Defined cases: a null text is empty; a document always has at least the end
token and so one piece; null and repeated ids are packed as documents of
their own; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict, deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opslog.llm.common import map_texts, partitions, stored
from opslog.llm.tokens import encoder

CAPACITY = 2048
END = 0
# Rows of output gathered before they are sent on.
BATCH = 8192

PIECE = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()),
         ("ids_crc32", pa.int64())]


def cut(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end token,
    in pieces of ``capacity`` ids, the last of which may be shorter."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        rows: list[list] = [[] for _ in PIECE]

        def out() -> pa.RecordBatch:
            b = pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(rows, PIECE)], [n for n, _ in PIECE])
            for c in rows:
                c.clear()
            return b

        for batch in batches:
            names = iter(batch.column(0).to_pylist())
            for found, offsets in enc.batches(batch.column(1)):
                cuts = offsets.tolist()
                for a, z, doc in zip(cuts, cuts[1:], names):
                    ids = np.append(found[a:z], end).astype("<u4")
                    for k, s in enumerate(range(0, len(ids), capacity)):
                        part = ids[s:s + capacity]
                        for c, v in zip(rows, (doc, k, s, len(part), zlib.crc32(part.tobytes()))):
                            c.append(v)
                    if len(rows[0]) >= BATCH:
                        yield out()
        yield out()

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("t"))
    return map_texts(src, run, "doc_id long, piece int, start long, length int, ids_crc32 long")


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Flows (first rank, length, first sequence, pieces a sequence, offset), by rank.

    ``counts`` has the number of pieces of each length; ranks run over the
    pieces by falling length. The pieces of a flow go to its sequences in
    turn, ``pieces a sequence`` to each.
    """
    gaps: dict[int, deque[tuple[int, int]]] = defaultdict(deque)  # what remains -> (first sequence, how many)
    flows, rank, sequences = [], 0, 0

    def place(first: int, left: int, length: int, per: int, seqs: int, todo: int) -> tuple[int, int]:
        """Fill up to ``seqs`` gaps of size ``left``; returns (pieces placed, gaps touched)."""
        n = min(todo, per * seqs)
        flows.append((rank, length, first, per, capacity - left))
        full, rest = divmod(n, per)
        if full and left - per * length:
            gaps[left - per * length].append((first, full))
        if rest:
            gaps[left - rest * length].append((first + full, 1))
        return n, full + (rest > 0)

    for length in sorted(counts, reverse=True):
        todo = counts[length]
        for left in sorted(g for g in gaps if g >= length):
            # a gap partly filled here has moved to a smaller class and waits for the next lengths
            runs, gaps[left] = gaps[left], deque()
            while runs and todo:
                first, seqs = runs.popleft()
                n, used = place(first, left, length, left // length, seqs, todo)
                rank, todo = rank + n, todo - n
                if used < seqs:
                    runs.appendleft((first + used, seqs - used))
            gaps[left].extend(runs)
            if not gaps[left]:
                del gaps[left]
            if not todo:
                break
        if todo:
            per = capacity // length
            need = -(-todo // per)
            n, _ = place(sequences, capacity, length, per, need, todo)
            rank, sequences = rank + n, sequences + need
    return flows


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces with columns doc_id, piece and length
    (1 to ``capacity``); other columns are carried along."""
    spark = pieces.sparkSession
    tie = F.xxhash64("doc_id", "piece")
    schema = [f for f in pieces.schema.fields]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(n, part, np.int32)), pa.array(np.arange(at, at + n, dtype=np.int64))],
                [*b.schema.names, "__part", "__at"])
            at += n

    # the tie breaker lets a length held by many rows spread over partitions
    ranked = stored(
        pieces.withColumn("__tie", tie).repartitionByRange(partitions(spark), F.desc("length"), "__tie")
        .sortWithinPartitions(F.desc("length"), "__tie", "doc_id", "piece").drop("__tie")
        .mapInArrow(number, f"{ddl}, __part int, __at long"), "pieces")
    # two small tables: a row per partition, and a row per length up to the capacity
    sizes = {r["__part"]: r["n"] for r in ranked.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= k <= capacity for k in counts):
        raise ValueError(f"piece lengths must be 1 to {capacity}")
    before = np.zeros(max(sizes, default=0) + 2, np.int64)
    for p, n in sizes.items():
        before[p + 1] = n
    before = before.cumsum()
    flows = spark.sparkContext.broadcast(np.array(best_fit(counts, capacity), np.int64).reshape(-1, 5))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = flows.value
        for b in batches:
            part, at = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("__part", "__at"))
            rank = before[part] + at
            f = table[np.searchsorted(table[:, 0], rank, "right") - 1] if len(rank) else table[:0]
            k = rank - f[:, 0]
            seq, off = f[:, 2] + k // f[:, 3], f[:, 4] + k % f[:, 3] * f[:, 1]
            keep = [i for i, n in enumerate(b.schema.names) if n not in ("__part", "__at")]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), pa.array(seq), pa.array(off)],
                                             [*(b.schema.names[i] for i in keep), "sequence_id", "offset"])

    return ranked.mapInArrow(locate, f"{ddl}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, end: int = END, tokenizer: str | None = None,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut every document and pack the pieces: one row per piece."""
    return pack(stored(cut(docs, capacity, end, tokenizer, id_col, text_col), "cut"), capacity)


def sequences(packed: DataFrame, docs: DataFrame, tokenizer: str | None = None, end: int = END,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, ids of unique documents joined by id."""
    @F.pandas_udf("array<int>")
    def ids_of(text: pd.Series, start: pd.Series, length: pd.Series) -> pd.Series:
        enc = encoder(tokenizer)
        return pd.Series([np.append(np.frombuffer(enc.ids(t), "<u2"), end)[s:s + n].astype(np.int32)
                          for t, s, n in zip(text, start, length)], index=text.index)

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("__t"))
    rows = packed.join(texts, "doc_id").withColumn("ids", ids_of("__t", "start", "length"))
    return rows.groupBy("sequence_id").agg(F.flatten(F.transform(
        F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"])).alias("ids"))
