"""The registered queries opN_<name> and ``pipeline``, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from secrets import token_hex

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from ..sources.io import stage_path
from . import (exact_dedup, hard_negatives, langid, merkle, mixing, near_dedup, packing, pii, secrets, sharding, topk, toxicity,
               warc)
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE[fn.__name__] = sql
        return fn
    return add


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@query("""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
""")
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return out.withColumnRenamed("id", "doc_id")


@query()
def op2_pfair_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = stage_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.read_archives(spark, path)
    full = F.col("record_type") == "response"
    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes")).alias("payload_bytes"),
        F.when(full, warc.base32_sha1(F.col("payload"))).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", F.regexp_extract("refers_to", r"(-?\d+)>$", 1).try_cast("long").alias("refers_to"))


@query("""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM s)
WHERE rank <= 20
""")
def op4_ball_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)


@query()
def op5_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=80)


def pii_key(spark: SparkSession) -> str:
    """The session's key; a random one, which the session keeps, where none is set."""
    key = spark.conf.get("spark.tillroll.pii.key", None)
    if not key:
        key = token_hex(32)
        spark.conf.set("spark.tillroll.pii.key", key)
    return key


@query()
def op6_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymise(docs, key=pii_key(spark))
    return out.select("doc_id", "text", *[F.col(f"pii.{kind}").alias(f"n_{kind}") for kind, _ in pii.KINDS])


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query()
def op8_label_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"), shards=40).withColumnRenamed("id", "doc_id")


@query()
def op9_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query()
def op10_randomness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query()
def op11_naive_bayes_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs))


@query("""
WITH RECURSIVE crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295::UBIGINT, list_transform(
           string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
         lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)::UBIGINT[]),
           lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END))) AS crc
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL)),
d AS (
  SELECT doc_id, coalesce('=' || source, '') AS key,
         concat_ws('', coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                   coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         text, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS tampered
  FROM documents LEFT JOIN crc USING (doc_id)),
l AS (
  SELECT doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(tampered) || ':' || tampered, '-')) AS found FROM d),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY key) AS n FROM l),
t AS (
  SELECT 0 AS level, key, pos, n, leaf AS h FROM leaves
  UNION ALL
  SELECT level + 1, key, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM t WHERE n > 1
  GROUP BY level, key, pos // 3, n),
subs AS (SELECT key, h, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (
  SELECT 0 AS level, pos, n, h FROM subs
  UNION ALL
  SELECT level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1
  GROUP BY level, pos // 3, n),
runs AS (SELECT level, key, pos // 3 AS up, list(h ORDER BY pos) AS hs FROM t WHERE n > 1 GROUP BY ALL),
crown AS (SELECT level, pos // 3 AS up, list(h ORDER BY pos) AS hs FROM u WHERE n > 1 GROUP BY ALL),
f AS (
  SELECT 0 AS level, doc_id, key, leaf, pos, found AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT f.level + 1, doc_id, f.key, leaf, pos // 3,
         sha256(array_to_string(hs[:pos % 3], '') || h || array_to_string(hs[pos % 3 + 2:], '')),
         proof || array_to_string(hs[:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], '')
  FROM f JOIN runs r ON r.level = f.level AND r.key = f.key AND r.up = f.pos // 3),
top AS (SELECT f.doc_id, f.leaf, f.h, f.proof, s.h AS subroot, s.pos
        FROM f JOIN t ON t.n = 1 AND t.key = f.key AND t.level = f.level JOIN subs s ON s.key = f.key),
g AS (
  SELECT 0 AS level, doc_id, leaf, subroot, pos, h, proof FROM top
  UNION ALL
  SELECT g.level + 1, doc_id, leaf, subroot, pos // 3,
         sha256(array_to_string(hs[:pos % 3], '') || h || array_to_string(hs[pos % 3 + 2:], '')),
         proof || array_to_string(hs[:pos % 3], '') || array_to_string(hs[pos % 3 + 2:], '')
  FROM g JOIN crown c ON c.level = g.level AND c.up = g.pos // 3)
SELECT doc_id, leaf, subroot, u.h AS root, sha256(proof) AS proof_sha256, g.h AS folded_root, g.h = u.h AS verified
FROM g JOIN u ON u.n = 1 AND u.level = g.level
""")
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    cut = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    rows = merkle.verify(table(spark, sf_dir, "documents"), F.when(cut, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text))
    return rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query("""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, list_dot_product(a.e, r.e)::BIGINT AS score
      FROM v a JOIN v r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, p.vec_id AS positive_id, (row_number() OVER w)::INTEGER AS rank, n.vec_id AS negative_id,
       p.score AS positive_score, n.score AS negative_score
FROM p JOIN (SELECT * FROM s WHERE NOT same) n USING (anchor_id)
WHERE 80 * p.score <= 100 * n.score AND n.score <= p.score
WINDOW w AS (PARTITION BY anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)
QUALIFY rank <= 5
""")
def op13_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, scale=256, label=label)


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLE["pipeline"] = corpus_pipeline.ORACLE_SQL
