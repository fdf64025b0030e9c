"""URL filters as a temporal list join.

A list holds dated entries: from a time on, a pattern is blocked, allowed, or
no longer listed. Each pattern's entries become disjoint validity intervals
[entry, next entry of the same pattern), and an as-of join evaluates every
capture against the intervals that were open when it was fetched. The most
specific pattern decides: a whole URL over a path prefix over a host over a
domain, longer over shorter.

Patterns by kind, all without scheme, user, port and fragment, hosts in lower
case without a final dot:
``url`` host/path?query; ``prefix`` host/path/segments/ ; ``host`` one host;
``domain`` a host and all hosts below it.

DataFrame functions only. A capture is exploded to the few patterns that could
list it (bounded by the labels and segments of its URL), joined by pattern
equality and time, and folded back per capture. A pattern with a third of all
captures sits on the side of the inner join that adaptive execution splits.

Defined cases: null or host-less URLs and null times match nothing and are
kept; entries with a null pattern, kind, action or time are ignored; of several
entries of a pattern at one time block wins over allow over lift; unknown
actions are ignored; repeated captures come out as they came in; empty tables
give no matches or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opslog.llm.common import stored

AUTHORITY = r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"
AFTER = r"^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and final dot; empty if there is none."""
    authority = F.regexp_extract(url, AUTHORITY, 1)
    bare = F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", "")
    return F.regexp_replace(F.lower(bare), r"\.$", "")


def path_of(url: Column) -> Column:
    """Path and query, starting with a slash."""
    after = F.regexp_extract(url, AFTER, 1)
    return F.when(after.startswith("/"), after).otherwise(F.concat(F.lit("/"), after))


def intervals(entries: DataFrame) -> DataFrame:
    """(kind, pattern, blocked, valid_from, valid_to): when each pattern is listed; the last one is open."""
    order = F.when(F.col("action") == "block", 2).when(F.col("action") == "allow", 1).when(F.col("action") == "lift", 0)
    clean = (entries.select("kind", "pattern", F.col("effective").alias("valid_from"), order.alias("o")).na.drop()
             .groupBy("kind", "pattern", "valid_from").agg(F.max("o").alias("o")))
    nxt = F.lead("valid_from").over(Window.partitionBy("kind", "pattern").orderBy("valid_from"))
    return (clean.withColumn("valid_to", nxt).where("o > 0")
            .select("kind", "pattern", (F.col("o") == 2).alias("blocked"), "valid_from", "valid_to"))


def candidates(host: Column, path: Column, folders: int, labels_kept: int) -> Column:
    """Array of (rank, kind, pattern) that could list a URL; higher ranks are more specific.

    Prefixes go down to ``folders`` folders and domains up to ``labels_kept`` labels, the most that
    any listed pattern has: a deeper one cannot be listed, and a very long URL stays linear.
    """
    def item(rank: Column, kind: str, pattern: Column) -> Column:
        return F.struct(rank.cast("int").alias("rank"), F.lit(kind).alias("kind"), pattern.alias("pattern"))

    none = F.array().cast("array<struct<rank:int,kind:string,pattern:string>>")
    labels = F.split(host, r"\.")
    lowest = F.greatest(F.lit(1), F.size(labels) - labels_kept + 1)
    domains = none if labels_kept < 1 else F.transform(F.sequence(lowest, F.size(labels)), lambda i: item(
        F.size(labels) - i, "domain", F.array_join(F.slice(labels, i, F.size(labels)), ".")))
    folder = F.split(F.regexp_extract(path, r"^/([^?]*)", 1), "/")
    depth = F.least(F.size(folder) - 1, F.lit(folders))  # the last part is a file, not a folder
    prefixes = F.when(depth > 0, F.transform(F.sequence(F.lit(1), F.greatest(depth, F.lit(1))), lambda i: item(
        F.lit(2_000_000) + i, "prefix", F.concat(host, F.lit("/"), F.array_join(F.slice(folder, 1, i), "/"), F.lit("/")))))
    return F.concat(F.array(item(F.lit(1 << 30), "url", F.concat(host, path)), item(F.lit(1_000_000), "host", host)),
                    domains, F.coalesce(prefixes, none))


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url",
             time_col: str = "fetched_at") -> DataFrame:
    """One row per capture: its id, url and time, blocked, and the kind, pattern and start of the entry that decided."""
    own = captures.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(time_col).alias("at"))
    # stored, so that the join reads plain shuffles on both sides and a hot pattern can be split
    listed = stored(intervals(entries), "url-intervals")
    most = listed.agg(F.max(F.when(F.col("kind") == "prefix", F.size(F.split("pattern", "/")) - 2)),
                      F.max(F.when(F.col("kind") == "domain", F.size(F.split("pattern", r"\."))))).first()
    asked = (own.distinct().withColumn("host", host_of(F.col("url"))).where("host <> '' and at is not null")
             .select("id", "url", "at", F.explode(candidates(F.col("host"), path_of(F.col("url")), most[0] or 0, most[1] or 0)).alias("c"))
             .select("id", "url", "at", "c.rank", F.col("c.kind").alias("k"), F.col("c.pattern").alias("p")))
    met = asked.join(listed, (F.col("k") == F.col("kind")) & (F.col("p") == F.col("pattern")) & (F.col("at") >= F.col("valid_from"))
                     & (F.col("valid_to").isNull() | (F.col("at") < F.col("valid_to"))))
    won = met.groupBy("id", "url", "at").agg(F.max(F.struct("rank", "blocked", "kind", "pattern", "valid_from")).alias("w"))
    won = won.select(F.col("id").alias("id2"), F.col("url").alias("url2"), F.col("at").alias("at2"), "w")
    out = own.join(won, F.col("id").eqNullSafe(F.col("id2")) & F.col("url").eqNullSafe(F.col("url2"))
                   & F.col("at").eqNullSafe(F.col("at2")), "left")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), F.col("at").alias(time_col),
                      F.coalesce("w.blocked", F.lit(False)).alias("blocked"), F.col("w.kind").alias("matched_kind"),
                      F.col("w.pattern").alias("matched_pattern"), F.col("w.valid_from").alias("listed_since"))
