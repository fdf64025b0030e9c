"""Prefix trie of conversations as a z-fast trie, built in batches by Spark joins.

A conversation is a sequence of turns (role, text). Every prefix of it has a
128-bit name, the exclusive or of hashes of (place, turn) over its turns. Only
compacted nodes are stored: where a conversation ends or two of them part. A
node's edge covers the depths (p, e] from below its parent to its own; it is
filed under its handle, the name at the depth in (p, e] that the highest power
of two divides (the two-fattest).

``locate`` finds the deepest compacted node whose whole sequence begins a
conversation: from (a, b] = (0, length], probe the handle of the two-fattest
depth; a hit whose node also agrees moves a down to it, a hit that does not is
the edge where the conversation leaves, below its top, and a miss moves b above
the depth. That is
one look-up (a join on handles) a step and about log2(length) steps.

``insert`` adds a batch of located conversations at once. Only what lies below
their places is new; together with the edges they leave, split where needed,
the new depths are grouped by name: a name with two continuations or an end is
a node. Its parent is the node before it on its path.

``prefix_trie`` then sums numbers up the compacted tree by pointer doubling, so
that a chain of any height takes logarithmic rounds, and expands every edge to
one row per depth. Nothing is grouped by conversation or node but in partial
aggregates, in bounded chunks of places, and in windows of one task's own
rows of a key: hot conversations and copies do not gather anywhere. Tables
between the steps are written to the shared folder.

Defined cases: null roles and texts are empty; turns go by (turn, null first),
those of one turn by a hash of role and text; rows without a conversation id
belong to no conversation; repeated rows are turns of their own; an empty table
has no nodes, not even a root.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opslog.llm.common import partitions, stored

# Names of a conversation's prefixes are kept in rows of at most this many places.
CHUNK = 1024
# Ids joined to one text before they move to the task that hashes them.
ENDS = 4096
# Shares of the distinct conversations, in 64ths, that the batches add.
BATCHES = (4, 16, 44)
NO_ENDS = sha256(b"").hexdigest()


def running(df: DataFrame, key: str, order: list[str], **sums: Column) -> DataFrame:
    """Adds running aggregates over the rows of a key in ``order``, this row included.

    Rows are sorted by (key, order) into ranges of their own number; a key that
    reaches over ranges (at most two a range) gets what its earlier ranges hold from
    a small table. ``sums`` are sum, count or bit_xor aggregates.
    """
    t = stored(df.repartitionByRange(partitions(df.sparkSession), key, *order)
               .withColumn("__part", F.spark_partition_id()), "ranges")
    kinds = {n: "bit_xor" if "bit_xor" in str(c) else "sum" for n, c in sums.items()}
    own = Window.partitionBy(key, "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    totals = t.groupBy(key, "__part").agg(*(c.alias(n) for n, c in sums.items()))
    several = totals.groupBy(key).agg(F.count("*").alias("__k")).where("__k > 1").select(key)
    earlier = Window.partitionBy(key).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (totals.join(several, key, "left_semi")
             .select(key, "__part", *(getattr(F, kinds[n])(n).over(earlier).alias(f"__{n}") for n in sums)))
    out = t.select("*", *(c.over(own).alias(n) for n, c in sums.items())).join(carry, [key, "__part"], "left")
    for n in sums:
        before = F.coalesce(f"__{n}", F.lit(0))
        out = out.withColumn(n, F.col(n).bitwiseXOR(before) if kinds[n] == "bit_xor" else F.col(n) + before).drop(f"__{n}")
    return out.drop("__part")


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, turn_key, size): turns numbered from 1 in order; the texts themselves do not move."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    own = conversations.select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.md5(F.concat_ws(":", F.octet_length(role).cast("string"), role, text)).alias("turn_key"),
        F.octet_length(text).cast("long").alias("size")).where("conv IS NOT NULL")
    return running(own, "conv", ["turn", "turn_key", "size"], pos=F.count(F.lit(1))).select("conv", "pos", "turn_key", "size")


def rebuilt(turns: DataFrame, family: int = 5, shared: int = 9) -> tuple[DataFrame, DataFrame]:
    """(conversation ids, turns) with each conversation's head replaced: the first h turns of the family's
    first conversation, then its own turns after its first h, h = crc32 of the id modulo ``shared``."""
    turns = stored(turns, "turns")
    length = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % shared
    ids = length.select("conv", (F.col("conv") - F.col("conv") % family).alias("base"), h.alias("h"))
    heads = turns.where(F.col("pos") < shared).withColumnRenamed("conv", "base")
    head = (ids.join(heads, "base").where("pos <= h").select("conv", "pos", "turn_key", "size"))
    missing = (ids.join(length.withColumnRenamed("conv", "base"), "base", "left")
               .select("conv", (F.col("h") - F.least("h", F.coalesce("n", F.lit(0)))).alias("gap")))
    rest = (turns.where(F.col("pos") > h).join(missing, "conv")
            .select("conv", (F.col("pos") - F.col("gap")).alias("pos"), "turn_key", "size"))
    return ids.select("conv"), head.unionByName(rest)


def chunks_of(turns: DataFrame) -> DataFrame:
    """(conv, chunk, names): for CHUNK places at a time, each place's prefix name, size and running size."""
    key = ["pos", "turn_key"]
    named = running(turns.select("conv", "pos", "size", *(F.xxhash64(F.lit(k), *key).alias(f"z{k}") for k in (1, 2))),
                    "conv", ["pos"], h1=F.bit_xor("z1"), h2=F.bit_xor("z2"), total=F.sum("size"))
    place = F.struct("pos", "h1", "h2", "size", "total")
    return (named.groupBy("conv", ((F.col("pos") - 1) / CHUNK).cast("long").alias("chunk"))
            .agg(F.array_sort(F.collect_list(place)).alias("names")))


def chunk_of(depth: str) -> Column:
    return F.floor((F.col(depth) - 1) / CHUNK).cast("long")


def at_place(df: DataFrame, chunks: DataFrame, conv: str, depth: str, **fields: str) -> DataFrame:
    """``df`` with fields of its conversation's prefix at ``depth`` (null where it has no such place)."""
    side = chunks.select(F.col("conv").alias("__c"), F.col("chunk").alias("__k"), F.col("names").alias("__names"))
    got = df.join(side, (F.col(conv) == F.col("__c")) & (chunk_of(depth) == F.col("__k")), "left")
    place = F.get("__names", ((F.col(depth) - 1) % CHUNK).cast("int"))
    return got.select(*df.columns, *(place[f].alias(n) for n, f in fields.items()))


def two_fattest(a: Column, b: Column) -> Column:
    """The number in (a, b] that the highest power of two divides."""
    low = (F.length(F.bin(a.bitwiseXOR(b))) - 1).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", b, low), low)


def locate(convs: DataFrame, trie: DataFrame, chunks: DataFrame) -> DataFrame:
    """(conv, length, a, a1, a2): depth and name of the deepest node whose sequence begins the conversation."""
    zero = F.lit(0).cast("long")
    state = convs.select("conv", "length", zero.alias("a"), zero.alias("a1"), zero.alias("a2"), F.col("length").alias("b"))
    handles = trie.select("f1", "f2", F.col("e").alias("z_e"), F.col("h1").alias("z1"), F.col("h2").alias("z2"), "p", "q1", "q2")
    keep = ["conv", "length", "a", "a1", "a2"]
    done = [state.where("a >= b").select(keep)]
    state = state.where("a < b")
    while not state.isEmpty():
        probe = at_place(state.withColumn("f", two_fattest(F.col("a"), F.col("b"))), chunks, "conv", "f", f1="h1", f2="h2")
        hit = at_place(probe.join(handles, ["f1", "f2"], "left"), chunks, "conv", "z_e", x1="h1", x2="h2")
        on = F.coalesce((F.col("x1") == F.col("z1")) & (F.col("x2") == F.col("z2")), F.lit(False))
        miss = F.col("z_e").isNull()
        state = stored(hit.select("conv", "length", *(
            F.when(miss, F.col(c)).when(on, F.col(z)).otherwise(F.col(q)).alias(c)
            for c, z, q in (("a", "z_e", "p"), ("a1", "z1", "q1"), ("a2", "z2", "q2"))),
            F.when(miss, F.col("f") - 1).when(on, F.col("b")).otherwise(F.lit(0)).alias("b")), "located")
        done.append(state.where("a >= b").select(keep))
        state = state.where("a < b")
    return reduce(DataFrame.unionByName, done)


def path_rows(spans: DataFrame, chunks: DataFrame) -> DataFrame:
    """Rows (conv, lo, hi, ...) with one row per depth in (lo, hi]: its name and the next depth's.

    Chunks are joined whole and opened in place, so a long span costs no more than its places.
    """
    first, last = F.floor(F.col("lo") / CHUNK).cast("long"), F.floor((F.col("hi") - 1) / CHUNK).cast("long")
    wide = spans.where("lo < hi").withColumn("chunk", F.explode(F.sequence(first, last)))
    depth = F.col("at.pos")
    return (wide.join(chunks, ["conv", "chunk"]).drop("chunk").withColumn("at", F.explode("names")).drop("names")
            .where((depth > F.col("lo")) & (depth <= F.col("hi")))
            .select(*spans.columns, depth.alias("d"), "at.h1", "at.h2", "at.size", "at.total"))


def insert(trie: DataFrame, located: DataFrame, chunks: DataFrame) -> DataFrame:
    """The trie with a batch of located conversations added."""
    fresh = at_place(located.where("a < length").withColumn("d", F.col("a") + 1), chunks, "conv", "d", c1="h1", c2="h2")
    fresh = stored(fresh, "fresh")
    left = trie.join(fresh.select("c1", "c2").distinct(), ["c1", "c2"], "left_semi")  # edges that are left in the middle or shared
    spans = (fresh.select("conv", F.col("a").alias("lo"), F.col("length").alias("hi"), "a1", "a2", F.lit(0).alias("old"))
             .unionByName(left.select(F.col("rep").alias("conv"), F.col("p").alias("lo"), F.col("e").alias("hi"),
                                      F.col("q1").alias("a1"), F.col("q2").alias("a2"), F.lit(1).alias("old"))))
    # one path a span: a conversation that stands for an edge may not be of this batch as well, but may stand for several
    rows = path_rows(spans.withColumn("path", F.struct("conv", "lo")), chunks).select("path", "hi", "a1", "a2", "d", "h1", "h2")
    after = rows.select("path", (F.col("d") - 1).alias("d"), F.struct("h1", "h2").alias("next"))
    rows = stored(rows.join(after, ["path", "d"], "left"), "paths")
    parts = (F.min("next") != F.max("next")) | F.max(F.col("d") == F.col("hi"))
    names = rows.groupBy("h1", "h2").agg(parts.alias("node")).where("node").select("h1", "h2")
    before = Window.partitionBy("path").orderBy("d")
    steps = (rows.join(names, ["h1", "h2"], "left_semi")
             .withColumn("up", F.coalesce(F.lag(F.struct(F.col("d").alias("p"), F.col("h1").alias("q1"), F.col("h2").alias("q2")))
                                          .over(before),
                                          F.struct(F.col("path.lo").alias("p"), F.col("a1").alias("q1"), F.col("a2").alias("q2")))))
    nodes = (steps.groupBy("h1", "h2").agg(F.min(F.struct("path.conv", F.col("d").alias("e"), "up")).alias("one"))
             .select("h1", "h2", "one.e", "one.up.p", "one.up.q1", "one.up.q2", F.col("one.conv").alias("rep")))
    nodes = nodes.withColumn("f", two_fattest(F.col("p"), F.col("e"))).withColumn("first", F.col("p") + 1)
    nodes = at_place(at_place(nodes, chunks, "rep", "f", f1="h1", f2="h2"), chunks, "rep", "first", c1="h1", c2="h2").drop("first")
    return stored(trie.join(left.select("h1", "h2"), ["h1", "h2"], "left_anti").select(nodes.columns).unionByName(nodes), "trie")


TRIE = "h1 long, h2 long, e long, p long, q1 long, q2 long, rep long, f long, f1 long, f2 long, c1 long, c2 long"


def build(sequences: DataFrame, chunks: DataFrame, batches: tuple[int, ...] = BATCHES) -> DataFrame:
    """Compacted nodes but the root, of distinct conversations (conv, length)."""
    trie = sequences.sparkSession.createDataFrame([], TRIE)
    slot, first = F.pmod(F.xxhash64("conv"), F.lit(sum(batches))), 0
    for size in batches:
        batch = sequences.where((slot >= first) & (slot < first + size))
        trie = insert(trie, locate(batch, trie, chunks), chunks)
        first += size
    return trie


def end_digests(ends: DataFrame) -> DataFrame:
    """(h1, h2, ends_sha256): digest of the ids that end at a node, ascending and comma-joined.

    Ids are sorted in ranges, so that a node with a third of them is dealt to several tasks, and joined
    there to texts of ``ENDS`` ids; one task reads a node's few texts in order, one at a time.
    """
    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        node = None

        def row() -> tuple:
            return (*node, held[0], ",".join(map(str, held)))

        for b in batches:
            rows = []
            for h1, h2, c in zip(*(b.column(k).to_pylist() for k in range(3))):
                if (h1, h2) != node or len(held) == ENDS:
                    if held:
                        rows.append(row())
                    node, held = (h1, h2), []
                held.append(c)
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], list("abcd"))
        if held:
            yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row(), kinds)], list("abcd"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for b in batches:
            rows = []
            for h1, h2, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3)):
                if (h1, h2) == node:
                    digest.update(b",")
                else:
                    if node:
                        rows.append((*node, digest.hexdigest()))
                    node, digest = (h1, h2), sha256()
                digest.update(text.as_py().encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((*kinds[:2], pa.string()))],
                                             list("abc"))
        if node:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (*node, digest.hexdigest())], list("abc"))

    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    texts = (ends.select("h1", "h2", "conv").repartitionByRange(partitions(ends.sparkSession), "h1", "h2", "conv")
             .sortWithinPartitions("h1", "h2", "conv").mapInArrow(joined, "h1 long, h2 long, first long, ids string"))
    return (texts.repartition("h1", "h2").sortWithinPartitions("h1", "h2", "first")
            .mapInArrow(hashed, "h1 long, h2 long, ends_sha256 string"))


def summed(nodes: DataFrame) -> DataFrame:
    """Sums n_convs, n_leaves, total and edge, and the least conv_id, of every node over its subtree.

    Pointer doubling: in round k a node takes over what the nodes 2^k below it have gathered,
    and points at the ancestor of its ancestor.
    """
    sums = ["n_convs", "n_leaves", "total", "edge"]
    v = stored(nodes.select("h1", "h2", F.col("q1").alias("u1"), F.col("q2").alias("u2"), *sums, "conv_id"), "sums")
    while not (below := v.where("u1 IS NOT NULL")).isEmpty():
        given = below.groupBy(F.col("u1").alias("h1"), F.col("u2").alias("h2")).agg(
            *(F.sum(c).alias(f"add_{c}") for c in sums), F.min("conv_id").alias("low"))
        up = v.select(F.col("h1").alias("u1"), F.col("h2").alias("u2"), F.col("u1").alias("w1"), F.col("u2").alias("w2"))
        # nodes that already point above the root do not join, so that no null key gathers rows
        nxt = (below.join(up, ["u1", "u2"]).drop("u1", "u2").withColumnsRenamed({"w1": "u1", "w2": "u2"})
               .unionByName(v.where("u1 IS NULL")))
        v = stored(nxt.join(given, ["h1", "h2"], "left").select(
            "h1", "h2", "u1", "u2", *((F.col(c) + F.coalesce(f"add_{c}", F.lit(0))).alias(c) for c in sums),
            F.least("conv_id", "low").alias("conv_id")), "sums")
    return v.drop("u1", "u2")


def prefix_trie(ids: DataFrame, turns: DataFrame) -> DataFrame:
    """One row per distinct prefix of the conversations ``ids`` (conv) with ``turns`` (conv, pos, turn_key, size)."""
    zero = F.lit(0).cast("long")
    chunks = stored(chunks_of(turns), "chunks")
    last = (chunks.groupBy("conv").agg(F.max_by(F.element_at("names", -1), "chunk").alias("end"))
            .select("conv", F.col("end.pos").alias("length"), "end.h1", "end.h2", "end.total"))
    ends = stored(ids.join(last, "conv", "left").na.fill(0, ["length", "h1", "h2", "total"]), "ends")
    here = stored(ends.groupBy("h1", "h2", "length", "total").agg(F.min("conv").alias("conv"), F.count("*").alias("n")), "sequences")
    trie = build(here.where("length > 0").select("conv", "length"), chunks)

    sized = at_place(trie, chunks, "rep", "e", to="total")
    sized = at_place(sized.withColumn("first", F.col("p") + 1), chunks, "rep", "first", t="total", s="size")
    sized = sized.withColumn("above", F.col("t") - F.col("s")).withColumn("edge", F.col("to") - F.col("above"))
    cols = ["h1", "h2", "e", "p", "q1", "q2", "rep", "above", "edge"]
    null = F.lit(None).cast("long")
    root = (ids.limit(1).select(zero.alias("h1"), zero.alias("h2"), zero.alias("e"), F.lit(-1).cast("long").alias("p"),
                                null.alias("q1"), null.alias("q2"), null.alias("rep"), zero.alias("above"), zero.alias("edge")))
    nodes = sized.select(cols).unionByName(root)
    kids = trie.groupBy(F.col("q1").alias("h1"), F.col("q2").alias("h2")).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(kids, ["h1", "h2"], "left").na.fill(0, ["n_children"])
                   .join(here.select("h1", "h2", "total", "n", F.col("conv").alias("conv_id")), ["h1", "h2"], "left")
                   .withColumn("n_convs", F.coalesce("n", zero)).withColumn("total", F.coalesce("total", zero) * F.col("n_convs"))
                   .withColumn("n_leaves", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")), "nodes")
    got = stored(summed(nodes), "summed")
    whole = nodes.select(*cols, "n_children").join(got.withColumnRenamed("edge", "edges"), ["h1", "h2"])
    whole = whole.join(end_digests(ends), ["h1", "h2"], "left")
    top = got.select(F.col("h1").alias("q1"), F.col("h2").alias("q2"), F.col("conv_id").alias("up_id"))

    last_place = F.col("d") == F.col("e")
    above = F.col("cum") - F.col("size")  # bytes of the texts above this depth
    deep = path_rows(whole.where("e > 0").withColumnsRenamed({"rep": "conv", "p": "lo", "e": "hi", "total": "of_members"})
                     .drop("h1", "h2").join(top, ["q1", "q2"]), chunks)
    deep = (deep.withColumnsRenamed({"hi": "e", "total": "cum"})
            .select("conv_id", F.col("d").alias("depth"),
                    F.when(F.col("d") > F.col("lo") + 1, F.col("conv_id")).otherwise(F.col("up_id")).alias("parent_conv_id"),
                    "n_convs", F.when(last_place, F.col("n_children")).otherwise(F.lit(1)).alias("n_children"), "n_leaves",
                    (F.col("of_members") - F.col("n_convs") * above - F.col("edges") + above - F.col("above")).alias("saved_tokens"),
                    F.when(last_place, F.col("ends_sha256")).alias("ends_sha256")))
    flat = (whole.where("e = 0")
            .select("conv_id", F.col("e").alias("depth"), null.alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                    (F.col("total") - F.col("edges")).alias("saved_tokens"), "ends_sha256"))
    return deep.unionByName(flat).na.fill(NO_ENDS, ["ends_sha256"])


def conversation_trie(conversations: DataFrame, **columns: str) -> DataFrame:
    """The prefix trie of the rebuilt conversations: one row per node."""
    return prefix_trie(*rebuilt(turns_of(conversations, **columns)))
