"""One registered query per operator, over the whole of its table.

Each query gets its rows through its operator; columns beyond the documented
ones are the operator's own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslog.llm import ann, htmltext, huffman, langid, mixing, packing, prefixtrie, quality, runs, simhash, toxicity
from opslog.llm import urlfilter, vecdedup
from opslog.llm.common import read


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.classify_fitted(docs, langid.train(docs))


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vecdedup.vector_groups(read(spark, sf_dir, "embeddings"), threshold=0.98)


# The tables have no list and no fetch times. Both are derived from the pages: a capture's time
# from its id (minutes of a year), and dated entries for a part of the hosts, parents, folders and
# URLs that occur, chosen and dated by the first digits of a pattern's md5.
YEAR_START = "2024-01-01 00:00:00"


def url_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    minute = F.pmod(F.col("page_id") * 7919, F.lit(366 * 1440)).cast("int")
    return read(spark, sf_dir, "pages").select("page_id", "url", (
        F.to_timestamp_ntz(F.lit(YEAR_START)) + F.make_dt_interval(mins=minute)).alias("fetched_at"))


def url_entries(captures: DataFrame) -> DataFrame:
    urls = captures.select("url", urlfilter.host_of(F.col("url")).alias("host"), urlfilter.path_of(F.col("url")).alias("path"))
    urls = urls.where("host <> ''")
    folder = F.concat("host", F.lit("/"), F.regexp_extract("path", "^/([^/?]*)/", 1), F.lit("/"))
    patterns = (urls.select(F.lit("host").alias("kind"), F.col("host").alias("pattern"))
                .unionByName(urls.select(F.lit("domain").alias("kind"), F.regexp_replace("host", r"^[^.]*\.", "").alias("pattern")))
                .unionByName(urls.select(F.lit("prefix").alias("kind"), folder.alias("pattern")))
                .unionByName(urls.select(F.lit("url").alias("kind"), F.concat("host", "path").alias("pattern"))).distinct())
    x = F.conv(F.substring(F.md5(F.concat("kind", F.lit(":"), "pattern")), 1, 7), 16, 10).cast("long")
    p = patterns.withColumn("x", x)
    first = p.where("x % 4 = 0").withColumn("action", F.when(F.col("x") % 3 == 0, "allow").otherwise("block")).withColumn("shift", F.lit(0))
    second = p.where("x % 8 = 0").withColumn("action", F.when(F.col("x") % 5 == 0, "block").otherwise("lift")).withColumn("shift", F.lit(45))
    day = (F.pmod(F.floor(F.col("x") / 16), F.lit(300)) + F.col("shift")).cast("int")
    return first.unionByName(second).select("kind", "pattern", "action", (
        F.to_timestamp_ntz(F.lit(YEAR_START)) + F.make_dt_interval(days=day)).alias("effective"))


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = url_captures(spark, sf_dir)
    return urlfilter.evaluate(captures, url_entries(captures))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mixing.mix_sizes(read(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read(spark, sf_dir, "embeddings"), every=20, k=20)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = huffman.token_files(read(spark, sf_dir, "documents"))
    return huffman.digest(huffman.read_files(spark, path))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = packing.pack_documents(read(spark, sf_dir, "documents"))
    return out.withColumn("length", F.col("length").cast("long"))


def op10_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages")
    return htmltext.extract(pages, htmltext.train(pages))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixtrie.conversation_trie(read(spark, sf_dir, "conversations"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.periodic_runs(read(spark, sf_dir, "documents"), planted=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_url_filters": op3_url_filters,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_mix_sources": op5_mix_sources,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_nearest_neighbours": op7_nearest_neighbours,
    "op8_token_files": op8_token_files,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_html_main_text": op10_html_main_text,
    "op11_toxicity": op11_toxicity,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_periodic_runs": op13_periodic_runs,
}

# Host, path and entries of a URL as in urlfilter and url_entries, written for the oracle's engine.
_URL_ORACLE = r"""
WITH cap AS (
  SELECT page_id, url, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST((page_id * 7919) % (366 * 1440) AS INTEGER)) AS fetched_at,
         regexp_replace(lower(regexp_replace(regexp_replace(
           regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1), '^.*@', ''), ':[0-9]*$', '')), '\.$', '') AS host,
         regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*([^#]*)', 1) AS aft
  FROM pages),
u AS (SELECT *, CASE WHEN starts_with(aft, '/') THEN aft ELSE '/' || aft END AS path FROM cap),
pat AS (
  SELECT DISTINCT * FROM (
    SELECT 'host' AS kind, host AS pattern FROM u WHERE host <> ''
    UNION ALL SELECT 'domain', regexp_replace(host, '^[^.]*\.', '') FROM u WHERE host <> ''
    UNION ALL SELECT 'prefix', host || '/' || regexp_extract(path, '^/([^/?]*)/', 1) || '/' FROM u WHERE host <> ''
    UNION ALL SELECT 'url', host || path FROM u WHERE host <> '')),
px AS (SELECT kind, pattern, CAST('0x' || substr(md5(kind || ':' || pattern), 1, 7) AS BIGINT) AS x FROM pat),
ent AS (
  SELECT kind, pattern, CASE WHEN x % 3 = 0 THEN 'allow' ELSE 'block' END AS action, (x // 16) % 300 AS d FROM px WHERE x % 4 = 0
  UNION ALL
  SELECT kind, pattern, CASE WHEN x % 5 = 0 THEN 'block' ELSE 'lift' END, (x // 16) % 300 + 45 FROM px WHERE x % 8 = 0),
dated AS (SELECT kind, pattern, action, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(d AS INTEGER)) AS f FROM ent),
iv AS (SELECT *, lead(f) OVER (PARTITION BY kind, pattern ORDER BY f) AS t FROM dated),
-- each list entry is tested against each capture by what its pattern means
hit AS (
  SELECT u.page_id, iv.*,
         CASE iv.kind WHEN 'url' THEN 4 WHEN 'prefix' THEN 3 WHEN 'host' THEN 2 ELSE 1 END AS level
  FROM u JOIN iv ON iv.action <> 'lift' AND u.fetched_at >= iv.f AND (iv.t IS NULL OR u.fetched_at < iv.t) AND u.host <> ''
   AND CASE iv.kind WHEN 'url' THEN u.host || u.path = iv.pattern
                    WHEN 'prefix' THEN starts_with(u.host || regexp_extract(u.path, '^([^?]*)', 1), iv.pattern)
                    WHEN 'host' THEN u.host = iv.pattern
                    ELSE u.host = iv.pattern OR ends_with(u.host, '.' || iv.pattern) END),
won AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY level DESC, length(pattern) DESC) = 1)
SELECT u.page_id, u.url, u.fetched_at, coalesce(won.action = 'block', false) AS blocked, won.kind AS matched_kind,
       won.pattern AS matched_pattern, won.f AS listed_since
FROM u LEFT JOIN won USING (page_id)
"""

_VECTOR_ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS w FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (
  SELECT vec_id AS s, vec_id AS n FROM embeddings
  UNION SELECT reach.s, link.w FROM reach JOIN link ON reach.n = link.u),
comp AS (SELECT s, min(n) AS c FROM reach GROUP BY s),
deg AS (SELECT u, count(*) AS k FROM link GROUP BY u)
SELECT e.vec_id, coalesce(deg.k, 0) AS n_links, comp.c AS component_id, e.vec_id = comp.c AS kept
FROM embeddings e JOIN comp ON comp.s = e.vec_id LEFT JOIN deg ON deg.u = e.vec_id
"""

ORACLE_SQL: dict[str, str] = {
    "op2_embedding_near_dedup": _VECTOR_ORACLE,
    "op3_url_filters": _URL_ORACLE,
}
