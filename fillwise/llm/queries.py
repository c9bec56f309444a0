"""The registered queries of the corpus operators: thin calls with production parameters
over whole tables, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fillwise.llm import ann, bpe, embed_dedup, html_extract, langid, minhash, mixing, quality, queries_structure, quotes, suffix
from fillwise.llm.common import table


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest neighbours found of every 100th embedding."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of every document that repeat an earlier document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                              F.sha2("kept", 256).alias("kept_sha256"))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and decoded bytes of every document, as digests."""
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~langid.held_out("doc_id", 4, 2)))
    return langid.identified(docs.select("doc_id", "text"), model).select(
        "doc_id", langid.held_out("doc_id", 4, 2).alias("held_out"), "lang_pred", "score")


def op5_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate links and component of every embedding."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op6_quotation_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message without quotations, with what it answers; ordered for reading."""
    return quotes.link(table(spark, sf_dir, "conversations")).orderBy("conv_id", "thread", "turn")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", quality.held_out("doc_id", 5, 0).alias("held_out"), "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extract.extracted(pages, html_extract.fit(pages))


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.n_words(F.col("text")).alias("size"))
    m = F.col("_mix")
    return mixing.mix(docs, size=F.col("size")).select(
        "doc_id", m["size"].alias("size"), m["source_size"].alias("source_size"),
        m["target"].alias("target"), m["taken"].alias("taken"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = f"""
WITH docs AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0)::BIGINT AS size,
         coalesce(doc_id::VARCHAR, '') AS k
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS words FROM docs GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source IS NULL, source) AS idx FROM s0),
s2 AS (SELECT *, ([{', '.join(map(str, mixing.WEIGHTS))}])[(idx - 1) % {len(mixing.WEIGHTS)} + 1]::DOUBLE AS weight,
              ({mixing.CAP} * words)::DOUBLE AS capped FROM s1),
s3 AS (SELECT *, ({mixing.SHARE}::DOUBLE * (sum(words) OVER ())::DOUBLE
         - coalesce(sum(capped) OVER (ORDER BY words / weight, idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY words / weight, idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
       FROM s2),
s4 AS (SELECT *, least(capped, weight * coalesce(max(CASE WHEN level * weight <= capped THEN level END) OVER (), 0)) AS target FROM s3),
s5 AS (SELECT *, floor(sum(target) OVER () / {mixing.BLOCK})::BIGINT AS blocks,
              greatest(1, least({mixing.SHARDS_MOST}, ceil(words / {mixing.SHARD_WORDS}.0)))::BIGINT AS shards FROM s4),
-- seats of the sources: every quotient up to a bound competes
s6 AS (SELECT idx, target / (2 * j - 1) AS q, j, blocks FROM (
         SELECT idx, target, blocks, unnest(generate_series(1, (2 * target / {mixing.BLOCK})::BIGINT + 2)) AS j FROM s5)),
s7 AS (SELECT idx, count(*) AS seats FROM (
         SELECT idx, blocks, row_number() OVER (ORDER BY q DESC, idx, j) AS r FROM s6) WHERE r <= blocks GROUP BY idx),
d1 AS (SELECT d.*, s.idx, s.shards, s.words, s.target,
              ('0x' || substr(md5(k || '#{mixing.SEED}/shard'), 1, 8))::BIGINT % 2147483648 % s.shards AS shard
       FROM docs d JOIN s5 s ON d.source IS NOT DISTINCT FROM s.source),
h1 AS (SELECT idx, shard, sum(size)::BIGINT AS shard_words FROM d1 GROUP BY ALL),
h2 AS (SELECT h1.*, coalesce(seats, 0) AS seats, ceil(shard_words / {mixing.BLOCK}.0)::BIGINT AS n FROM h1 LEFT JOIN s7 USING (idx)),
h3 AS (SELECT idx, shard, seats, shard_words / (2 * j - 1)::DOUBLE AS q, j FROM (
         SELECT idx, shard, seats, shard_words,
                unnest(generate_series(1, (3 * shard_words / {mixing.BLOCK})::BIGINT + 3)) AS j FROM h2)),
h4 AS (SELECT idx, shard, count(*) AS quota FROM (
         SELECT idx, shard, seats, row_number() OVER (PARTITION BY idx ORDER BY q DESC, shard, j) AS r FROM h3)
       WHERE r <= seats GROUP BY ALL),
h5 AS (SELECT h2.idx, h2.shard, n, least(coalesce(quota, 0), {mixing.CAP} * n) AS quota,
              CASE WHEN n > 0 THEN ('0x' || substr(md5(h2.idx || '/' || h2.shard || '#{mixing.SEED}/from'), 1, 8))::BIGINT
                                   % 2147483648 % n ELSE 0 END AS lo
       FROM h2 LEFT JOIN h4 USING (idx, shard)),
h6 AS (SELECT *, CASE WHEN n > 0 THEN quota // n ELSE 0 END AS passes FROM h5),
h7 AS (SELECT *, quota - passes * n AS extra FROM h6),
d2 AS (SELECT *, sum(size) OVER (PARTITION BY idx, shard ORDER BY md5(k || '#{mixing.SEED}/order'), doc_id, size
                                 ROWS UNBOUNDED PRECEDING) AS e FROM d1)
SELECT doc_id, size, words AS source_size, target,
       (passes * size
        + greatest(0, least(e, least(lo + extra, n) * {mixing.BLOCK}) - greatest(e - size, lo * {mixing.BLOCK}))
        + greatest(0, least(e, (lo + extra - n) * {mixing.BLOCK}) - (e - size)))::BIGINT AS taken
FROM d2 JOIN h7 USING (idx, shard)
"""


OP2_SQL = f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, {2 * suffix.LENGTH}) AS s
      FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - {suffix.LENGTH - 1})) AS i FROM d WHERE doc_id IS NOT NULL)),
f AS (SELECT s, min(doc_id) AS first FROM w GROUP BY s),
hit AS (SELECT DISTINCT doc_id, i FROM w JOIN f USING (s) WHERE first < doc_id),
mark AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {suffix.LENGTH} THEN 0 ELSE 1 END AS opens FROM hit),
run AS (SELECT doc_id, min(i) AS a, max(i) + {suffix.LENGTH} AS b
        FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id ORDER BY i) AS r FROM mark) GROUP BY doc_id, r),
piece AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS kept_from FROM run),
cut AS (SELECT p.doc_id, sum(b - a) AS n_removed, count(*) AS n_spans,
               string_agg(substr(h, 2 * kept_from + 1, 2 * (a - kept_from)), '' ORDER BY a) AS front, max(b) AS last
        FROM piece p JOIN d USING (doc_id) GROUP BY p.doc_id)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN last IS NULL THEN h ELSE front || substr(h, 2 * last + 1) END)) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)
"""

OP5_SQL = f"""
WITH RECURSIVE e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b
         ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= {embed_dedup.COSINE}),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings m JOIN root r ON m.vec_id = r.a LEFT JOIN n ON m.vec_id = n.a
"""

OP10_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '{mixing.WORD}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + {minhash.SHINGLE - 1}], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - {minhash.SHINGLE - 2}, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
link AS (SELECT p.a, p.b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
                               GROUP BY ALL) p JOIN n x ON p.a = x.doc_id JOIN n y ON p.b = y.doc_id
         WHERE 100 * c >= {minhash.PERCENT} * (x.n + y.n - c)),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
root AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM d JOIN root ON d.doc_id = root.a LEFT JOIN n ON d.doc_id = n.doc_id
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": op1_ann,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_langid": op4_langid,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_quotation_links": op6_quotation_links,
    "op7_quality": op7_quality,
    "op8_main_text": op8_main_text,
    "op9_mix_sources": op9_mix_sources,
    "op10_minhash": op10_minhash,
    **queries_structure.QUERIES,
}

ORACLES: dict[str, str] = {
    "op2_suffix_dedup": OP2_SQL,
    "op5_embedding_dedup": OP5_SQL,
    "op9_mix_sources": OP9_SQL,
    "op10_minhash": OP10_SQL,
    **queries_structure.ORACLES,
}
