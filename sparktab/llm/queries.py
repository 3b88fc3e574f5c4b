"""The registered queries of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sparktab.llm.decontaminate import find_items
from sparktab.llm.fingerprints import edited_fingerprints
from sparktab.llm.license_scan import scan_licenses
from sparktab.llm.manifest import verify_manifest
from sparktab.llm.packing import pack
from sparktab.llm.pii import digest, find_pii
from sparktab.llm.quality import score_quality
from sparktab.llm.resample import resample
from sparktab.llm.sharding import shard_rows
from sparktab.llm.simhash import simhash_groups
from sparktab.llm.token_counts import token_counts
from sparktab.llm.toxicity import score_toxicity
from sparktab.llm.vector_dedup import vector_links


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_rows(table(spark, sf_dir, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_links(table(spark, sf_dir, "embeddings"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_quality_co_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest(find_pii(table(spark, sf_dir, "documents")))


def op11_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_manifest(table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan, op2_simhash_near_dedup, op3_sharding, op4_best_fit_packing, op5_token_counts, op6_embedding_near_dedup, op7_benchmark_decontamination, op8_toxicity, op9_quality_co_training, op10_pii, op11_document_fingerprints, op12_merkle_manifest, op13_importance_resampling,
    )
}
# Trained models, token ids, XXH64 and CRC-32 over texts have no SQL form; these queries are tested against brute force.
ORACLES: dict[str, str] = {
    "op6_embedding_near_dedup": """
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reached AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
least AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM embeddings v JOIN least c ON c.a = v.vec_id LEFT JOIN degree d ON d.a = v.vec_id""",
    # the CRC-32 of the decimal key is folded bit by bit over a list of steps
    "op12_merkle_manifest": """
WITH RECURSIVE chars AS (
  SELECT row_number() OVER () AS r, doc_id, source, lang, n_chars, text, dense_rank() OVER (ORDER BY source NULLS FIRST) AS g,
    list_reduce([4294967295::BIGINT] || flatten(list_transform(range(1, 1 + length(doc_id::VARCHAR)), lambda i: [ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS state
  FROM documents),
leaves AS (
  SELECT r, doc_id, g, xor(state, 4294967295) % 5 = 0 AS chosen,
    concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
    coalesce(strlen(text) || ':' || text, '-') AS body, coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS lowered
  FROM chars),
hashed AS (SELECT r, doc_id, g, sha256(head || body) AS leaf, sha256(head || CASE WHEN chosen THEN lowered ELSE body END) AS shown FROM leaves),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx, count(*) OVER (PARTITION BY g) AS n FROM hashed),
node AS (
  SELECT g, 0 AS lvl, idx, n, leaf AS d FROM placed
  UNION ALL
  SELECT g, lvl + 1, idx // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY idx)) FROM node WHERE n > 1 GROUP BY g, lvl, idx // 16),
subroots AS (SELECT g, d AS subroot, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM node WHERE n = 1),
upper AS (
  SELECT 0 AS lvl, idx, n, subroot AS d FROM subroots
  UNION ALL
  SELECT lvl + 1, idx // 16, (any_value(n) + 15) // 16, sha256(string_agg(d, '' ORDER BY idx)) FROM upper WHERE n > 1 GROUP BY lvl, idx // 16),
own AS (
  SELECT p.r, x.lvl, x.idx, x.d, x.idx - p.idx // (16 ** x.lvl)::BIGINT AS side FROM placed p JOIN node x ON x.g = p.g AND x.n > 1 AND x.idx // 16 = p.idx // (16 ** (x.lvl + 1))::BIGINT
  UNION ALL
  SELECT p.r, 100 + x.lvl, x.idx, x.d, x.idx - s.idx // (16 ** x.lvl)::BIGINT FROM placed p JOIN subroots s ON s.g = p.g JOIN upper x ON x.n > 1 AND x.idx // 16 = s.idx // (16 ** (x.lvl + 1))::BIGINT),
steps AS (
  SELECT r, row_number() OVER (PARTITION BY r ORDER BY lvl) AS step, coalesce(string_agg(d, '' ORDER BY idx) FILTER (side < 0), '') AS before, coalesce(string_agg(d, '' ORDER BY idx) FILTER (side > 0), '') AS after
  FROM own GROUP BY r, lvl),
climb AS (
  SELECT r, 0 AS step, shown AS acc FROM hashed
  UNION ALL
  SELECT c.r, c.step + 1, sha256(s.before || c.acc || s.after) FROM climb c JOIN steps s ON s.r = c.r AND s.step = c.step + 1),
ends AS (SELECT r, arg_max(acc, step) AS folded_root FROM climb GROUP BY r),
proofs AS (SELECT r, string_agg(before || after, '' ORDER BY step) AS proof FROM steps GROUP BY r)
SELECT p.doc_id, p.leaf, s.subroot, u.d AS root, sha256(coalesce(f.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = u.d AS verified
FROM placed p JOIN subroots s USING (g) JOIN ends e USING (r) LEFT JOIN proofs f USING (r) JOIN upper u ON u.n = 1""",
}
