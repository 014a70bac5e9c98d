"""The registered queries ``opN_<name>``: each applies its operator, with
production parameters, to its whole table. ``SQL`` has the DuckDB equivalent
where SQL can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridelens.llm import (
    byte_bpe,
    centroid_clusters,
    digest,
    kmeans_tree,
    license_scan,
    minhash_dedup,
    mixing,
    page_text,
    quality,
    token_counts,
    token_files,
    url_filter,
    whitening,
)
from ridelens.llm.shared import fresh_path, read


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(byte_bpe.encode_and_decode(read(spark, sf_dir, "documents")))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = mixing.labelled_domains(read(spark, sf_dir, "labels"))
    return mixing.mix(read(spark, sf_dir, "documents"), labelled).drop("order")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf_dir, "documents"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op6_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digest.fingerprint_documents(read(spark, sf_dir, "documents"))


def op7_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return page_text.main_text(read(spark, sf_dir, "pages"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "token-files")
    token_files.write_token_files(read(spark, sf_dir, "documents"), path)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op9_kmeans_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kmeans_tree.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroid_clusters.cluster(read(spark, sf_dir, "embeddings")).drop("met")


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages")).drop("url")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_minhash_dedup": op1_minhash_dedup,
    "op2_byte_bpe": op2_byte_bpe,
    "op3_mixing": op3_mixing,
    "op4_token_counts": op4_token_counts,
    "op5_license_scan": op5_license_scan,
    "op6_digest": op6_digest,
    "op7_page_text": op7_page_text,
    "op8_token_files": op8_token_files,
    "op9_kmeans_tree": op9_kmeans_tree,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_url_filter": op12_url_filter,
    "op13_whitening": op13_whitening,
}



def _clusters_sql(k: int, rounds: int, dims: int, scale: int, seed: str) -> str:
    """k-means by brute force: a CTE for each assignment and each new centroid."""
    steps = [f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dims}
), points AS MATERIALIZED (
  SELECT row_id, unnest(range(1, {dims + 1})) AS j, unnest(v) AS x FROM kept
), first AS (
  SELECT v, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), v) - 1 AS c FROM kept
  QUALIFY c < {k}
), centroids_0 AS MATERIALIZED (SELECT c, unnest(range(1, {dims + 1})) AS j, unnest(v) AS x FROM first)"""]
    for r in range(rounds + 1):
        steps.append(f"""own_{r} AS MATERIALIZED (
  SELECT row_id, c, distance FROM (
    SELECT row_id, c, sum((p.x - m.x) * (p.x - m.x))::BIGINT AS distance FROM points p JOIN centroids_{r} m USING (j) GROUP BY row_id, c)
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY distance, c) = 1
)""")
        if r < rounds:
            steps.append(f"""centroids_{r + 1} AS MATERIALIZED (
  SELECT m.c, m.j, coalesce(s.x, m.x) AS x FROM centroids_{r} m LEFT JOIN (
    SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x
    FROM own_{r} JOIN points USING (row_id) GROUP BY c, j) s ON s.c = m.c AND s.j = m.j
)""")
    steps.append(f"""digests AS (
  SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY j)) AS centroid_sha256 FROM centroids_{rounds} GROUP BY c
)
SELECT vec_id, c::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY c)::BIGINT AS cluster_inertia,
  sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
FROM own_{rounds} JOIN kept USING (row_id) JOIN digests USING (c)""")
    return ",\n".join(steps)


def _urls_sql(rules: list[tuple[str, str, str]]) -> str:
    """Every rule tried on every URL."""
    rows = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH rules(verdict, rule_host, rule_path) AS (VALUES {rows}),
cut AS (
  SELECT row_number() OVER () AS row_id, page_id,
    translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), tried AS (
  SELECT cut.*, r.verdict, r.rule_host || r.rule_path AS rule FROM cut
  LEFT JOIN rules r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM tried
QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL: dict[str, str] = {
    "op1_minhash_dedup": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 75 * (p.n + q.n - shared.n)
), reach AS (
  SELECT DISTINCT doc_id, doc_id AS other FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
), lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, l.component_id, d.doc_id = l.component_id AS kept
FROM documents d JOIN lowest l ON l.doc_id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id
""",
    "op11_centroid_clusters": _clusters_sql(
        centroid_clusters.K, centroid_clusters.ROUNDS, centroid_clusters.DIMS, centroid_clusters.SCALE, centroid_clusters.SEED
    ),
    "op12_url_filter": _urls_sql(url_filter.RULES),
}
