"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import (
    byte_bpe, centroids, html_extraction, line_dedup, packing, prefix_trie, quality_rules,
    secrets, sharding, simhash, suffix_tree, toxicity, weighted_fingerprints,
)
from meterlake.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op8_packing")
def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


@register("op9_sharding")
def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(read_table(spark, sf_dir, "documents"), 8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


# The limits are those of quality_rules.FENCES.
QUALITY_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i:i + 4] AS win FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w)),
r AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + k) AS n FROM r, range(0, 5) AS x(k) GROUP BY rid),
c1 AS (SELECT rid, lang, t, regexp_replace(t, '[a-z]+', '', 'g') AS t1 FROM d),
c2 AS (SELECT *, regexp_replace(t1, '[ \t-\r]+', '', 'g') AS t2 FROM c1),
c3 AS (SELECT *, regexp_replace(t2, '[A-Z]+', '', 'g') AS t3 FROM c2),
c4 AS (SELECT *, regexp_replace(t3, '[.,;:!?''"()-]+', '', 'g') AS t4 FROM c3),
c5 AS (SELECT *, regexp_replace(t4, '[0-9]+', '', 'g') AS t5 FROM c4),
c6 AS (SELECT *, regexp_replace(t5, '[#*$%&|<>]+', '', 'g') AS t6 FROM c5),
c7 AS (SELECT *, regexp_replace(t6, '[\x00-\x7F]+', '', 'g') AS t7 FROM c6),
cc AS (SELECT rid, lang, length(t) AS len, unnest(range(0, 8)) AS k,
       unnest([length(t) - length(t1), length(t1) - length(t2), length(t2) - length(t3), length(t3) - length(t4),
               length(t4) - length(t5), length(t5) - length(t6), length(t6) - length(t7), length(t7)]) AS n FROM c7),
rc AS (SELECT lang, k, sum(n) / greatest(sum(sum(n)) OVER (PARTITION BY lang), 1) AS q FROM cc GROUP BY lang, k),
lw AS (SELECT rid, lang, unnest(list_filter(string_split_regex(lower(t), '[\x00-`{-\x7F]+'), lambda x: x <> '')) AS word FROM d),
lc AS (SELECT lang, word, count(*) AS n FROM lw GROUP BY lang, word),
lt AS (SELECT lang, sum(n) AS total FROM lc GROUP BY lang),
top AS (SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS k FROM lc),
rw AS (SELECT top.lang, word, k, n / total AS q FROM top JOIN lt ON top.lang IS NOT DISTINCT FROM lt.lang WHERE k <= 24
       UNION ALL SELECT top.lang, NULL, 25, greatest(1 - sum(CASE WHEN k <= 24 THEN n END) / any_value(total), 0)
       FROM top JOIN lt ON top.lang IS NOT DISTINCT FROM lt.lang GROUP BY top.lang),
dw AS (SELECT rid, any_value(lw.lang) AS lang, coalesce(k, 25) AS k, count(*) AS n FROM lw
       LEFT JOIN rw ON lw.lang IS NOT DISTINCT FROM rw.lang AND lw.word = rw.word GROUP BY rid, coalesce(k, 25)),
dn AS (SELECT rid, sum(n) AS words FROM dw GROUP BY rid),
jc AS (SELECT rid, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js
       FROM (SELECT rid, n / greatest(len, 1) AS p, q FROM cc JOIN rc ON cc.lang IS NOT DISTINCT FROM rc.lang AND cc.k = rc.k)
       GROUP BY rid),
jw AS (SELECT rid, sqrt(greatest(sum(CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
                                     + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2, 0)) AS js
       FROM (SELECT dn.rid, coalesce(dw.n, 0) / dn.words AS p, rw.q FROM dn JOIN d USING (rid)
             JOIN rw ON d.lang IS NOT DISTINCT FROM rw.lang LEFT JOIN dw ON dw.rid = dn.rid AND dw.k = rw.k)
       GROUP BY rid),
b AS (SELECT d.rid, d.doc_id, length(t) AS len, CAST(len(ws) AS BIGINT) AS n_words,
      CAST(length(regexp_replace(t, '[ \t-\r]+', '', 'g')) AS BIGINT) AS word_chars,
      CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
      CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
      CASE WHEN coalesce(total, 0) >= 1000 AND length(t) >= 200 THEN jc.js END AS cd,
      CASE WHEN coalesce(total, 0) >= 1000 AND coalesce(dn.words, 0) >= 60 THEN jw.js END AS wd
      FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN jc USING (rid)
      LEFT JOIN jw USING (rid) LEFT JOIN dn USING (rid) LEFT JOIN lt ON d.lang IS NOT DISTINCT FROM lt.lang),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, length(bin(greatest(n_words, 1))) - 1 AS band FROM b
      JOIN (SELECT rid, lang FROM d) USING (rid)),
db AS (SELECT lang, band, 'c' AS kind, CAST(floor(cd * 4096) AS INTEGER) AS bin, count(*) AS n FROM f WHERE cd IS NOT NULL GROUP BY ALL
       UNION ALL SELECT lang, band, 'w', CAST(floor(wd * 4096) AS INTEGER), count(*) FROM f WHERE wd IS NOT NULL GROUP BY ALL),
da AS (SELECT * FROM db UNION ALL SELECT lang, -1, kind, bin, sum(n) FROM db GROUP BY lang, kind, bin),
dr AS (SELECT *, sum(n) OVER (PARTITION BY lang, band, kind) AS total, sum(n) OVER (PARTITION BY lang, band, kind ORDER BY bin) AS upto FROM da),
dq AS (SELECT lang, band, kind, CAST(min(CASE WHEN upto * 4 >= total THEN bin END) AS DOUBLE) / 4096 AS q1,
              CAST(min(CASE WHEN upto * 4 >= total * 3 THEN bin END) AS DOUBLE) / 4096 AS q3 FROM dr WHERE total >= 20 GROUP BY lang, band, kind),
dl AS (SELECT lang, band, max(CASE WHEN kind = 'c' THEN lim END) AS cl, max(CASE WHEN kind = 'w' THEN lim END) AS wl
       FROM (SELECT *, q3 + CAST(1 AS DOUBLE) / 4096 + 3 * greatest(q3 - q1, CAST(0.01 AS DOUBLE)) AS lim FROM dq) GROUP BY lang, band)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT coalesce(cd > least(coalesce(own.cl, every.cl, CAST(0.3 AS DOUBLE)), CAST(0.3 AS DOUBLE)), false)
       AND NOT coalesce(wd > least(coalesce(own.wl, every.wl, CAST(0.5 AS DOUBLE)), CAST(0.5 AS DOUBLE)), false) AS kept,
       round(cd, 6) AS char_distance, round(wd, 6) AS word_distance
FROM f LEFT JOIN dl own ON own.lang IS NOT DISTINCT FROM f.lang AND own.band = f.band
LEFT JOIN dl every ON every.lang IS NOT DISTINCT FROM f.lang AND every.band = -1"""


@register("op10_quality_rules", QUALITY_SQL)
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(read_table(spark, sf_dir, "documents"), carried=["doc_id"]).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"))


@register("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.train(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", (~toxicity.in_training(F.col("doc_id"))).alias("held_out"), "score", "predicted")


@register("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.encode(read_table(spark, sf_dir, "documents"),
                           public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, keep_ids=False)


@register("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(read_table(spark, sf_dir, "pages"))


@register("op6_document_fingerprints")
def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_fingerprints.fingerprint_documents(read_table(spark, sf_dir, "documents"))


@register("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    blocks = suffix_tree.encode(docs)
    return suffix_tree.score(docs, suffix_tree.train(docs, blocks=blocks), blocks=blocks).select(
        "doc_id", (~suffix_tree.in_training(F.col("doc_id"))).alias("held_out"), "n_tokens", "n_known",
        "train_tokens", "base_score", "score")


@register("op1_line_dedup")
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_classes(read_table(spark, sf_dir, "documents"))


# crc is a table of the 256 steps of CRC-32 (polynomial 0xEDB88320).
TRIE_SQL = r"""
WITH crc AS (SELECT list(c ORDER BY b) AS steps FROM (
       SELECT b, list_reduce([b, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c
       FROM (SELECT CAST(range AS BIGINT) AS b FROM range(256)))),
o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) - 1 AS pos,
      [coalesce(role, ''), coalesce(text, '')] AS said FROM conversations WHERE conv_id IS NOT NULL),
cs AS (SELECT c, c - c % 20 AS lender,
       xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(c AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))),
                       lambda x, y: xor(x >> 8, steps[(xor(x, y) & 255) + 1])), 4294967295) % 4 AS h
       FROM (SELECT DISTINCT c FROM o), crc),
lent AS (SELECT cs.c, pos, said FROM cs JOIN o ON o.c = cs.lender AND pos < h),
k AS (SELECT c, count(*) AS n FROM lent GROUP BY c),
turns AS (SELECT c, pos, said FROM lent
          UNION ALL SELECT o.c, pos - h + coalesce(n, 0), said FROM o JOIN cs USING (c) LEFT JOIN k USING (c) WHERE pos >= h),
whole AS (SELECT c, coalesce(any_value(s), []) AS s FROM cs LEFT JOIN (SELECT c, list(said ORDER BY pos) AS s FROM turns GROUP BY c) USING (c) GROUP BY c),
nodes AS (SELECT s[1:d] AS p, d, s[1:greatest(d - 1, 0)] AS q, min(c) AS conv_id, count(*) AS n_convs,
          len(list_filter(string_split_regex(coalesce(any_value(s[d][2]), ''), '[ \t-\r]+'), lambda w: w <> '')) AS words
          FROM whole, range(0, len(s) + 1) AS x(d) GROUP BY ALL),
kids AS (SELECT q AS p, count(*) AS n FROM nodes WHERE d > 0 GROUP BY q),
trees AS (SELECT p[1:e] AS p, sum((n_convs - 1) * words) AS saved, count(*) FILTER (WHERE kids.n IS NULL) AS leaves
          FROM nodes LEFT JOIN kids USING (p), range(0, d + 1) AS x(e) GROUP BY 1),
ends AS (SELECT s AS p, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest FROM whole GROUP BY s)
SELECT a.conv_id, CAST(a.d AS BIGINT) AS depth, b.conv_id AS parent_conv_id, a.n_convs, CAST(coalesce(kids.n, 0) AS BIGINT) AS n_children,
       CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, coalesce(digest, sha256('')) AS ends_sha256
FROM nodes a JOIN trees USING (p) LEFT JOIN nodes b ON a.d > 0 AND b.p = a.q LEFT JOIN kids ON kids.p = a.p LEFT JOIN ends ON ends.p = a.p"""


@register("op11_conversation_trie", TRIE_SQL)
def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"))


def _clusters_sql(k: int = 8, rounds: int = 10, size: int = 64, seed: int = 3) -> str:
    """Plain k-means on integers, a few steps for each round."""
    steps = [f"""
WITH e AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
       FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {size}),
x AS MATERIALIZED (SELECT rid, unnest(range(0, {size})) AS i, unnest(v) AS x FROM e),
c0 AS MATERIALIZED (SELECT k, unnest(range(0, {size})) AS i, unnest(v) AS y FROM (
       SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS k, v FROM e WHERE vec_id IS NOT NULL) WHERE k < {k})"""]
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (SELECT rid, k, d FROM (SELECT rid, k, CAST(sum((x - y) * (x - y)) AS BIGINT) AS d FROM x JOIN c{r} USING (i) GROUP BY rid, k)
       QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, k) = 1)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (SELECT k, i, CASE WHEN n IS NULL THEN y ELSE CAST((s - (s % n + n) % n) // n AS BIGINT) END AS y FROM c{r}
       LEFT JOIN (SELECT k, i, sum(x) AS s, count(*) AS n FROM a{r} JOIN x USING (rid) GROUP BY k, i) USING (k, i))""")
    return ",".join(steps) + f"""
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{rounds} JOIN e USING (rid) JOIN (SELECT k, sha256(string_agg(CAST(y AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY k) USING (k)"""


@register("op12_centroid_clustering", _clusters_sql())
def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.clustered(read_table(spark, sf_dir, "embeddings"))


@register("op13_secret_scan")
def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(read_table(spark, sf_dir, "documents")))
