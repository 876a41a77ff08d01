"""The queries of the training-data operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import bpe, embedding, exact_dedup, html_extract, language, minhash, packing, quality, substring, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page: page_id, url, text, n_chars. Null html gives the empty text."""
    return html_extract.extract(_read(spark, sf_dir, "pages"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every text: doc_id, held_out, lang_pred, score. Texts without a letter are ``und`` with score 0."""
    return language.identify(_read(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens. A null text is its end token alone."""
    return packing.pack(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for every row: doc_id, keep_id, group_size, kept, text_sha256. Null counts as empty."""
    return exact_dedup.exact_dedup(spark, _read(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The WARC record of every page, written and read back. A null html is the empty payload."""
    return warc.archive_pages(spark, _read(spark, sf_dir, "pages")).drop("url", "payload")


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document by two-word shingles: doc_id, n_shingles, component_id, kept."""
    return minhash.near_dedup(spark, _read(spark, sf_dir, "documents"), k=2)


def op7_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without runs of 50 words that a smaller doc_id has."""
    return substring.substring_dedup(spark, _read(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every text: doc_id, held_out, score, predicted. Null and empty texts are scored like others."""
    return quality.classify(spark, _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, and the digest of their decoding. A null text has none."""
    return bpe.encode(_read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op10_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector: vec_id, n_links, component_id, kept. Invalid vectors link with nothing."""
    return embedding.near_dedup(spark, _read(spark, sf_dir, "embeddings"))


def queries() -> dict:
    import corpus_pipeline

    return {
        "op1_html_extract": op1_html_extract,
        "op2_language": op2_language,
        "op3_packing": op3_packing,
        "op4_exact_dedup": op4_exact_dedup,
        "op5_warc": op5_warc,
        "op6_minhash": op6_minhash,
        "op7_substring": op7_substring,
        "op8_quality": op8_quality,
        "op9_bpe": op9_bpe,
        "op10_embedding": op10_embedding,
        "pipeline": corpus_pipeline.run,
    }


OP4_SQL = """
WITH k AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM k WINDOW g AS (PARTITION BY text_sha256)
"""

OP5_SQL = """
WITH k AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM k)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_count(embedding) = len(embedding) AND list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[])) > 0),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x AS vec_id, min(y) AS component_id FROM r GROUP BY x),
d AS (SELECT x AS vec_id, count(*) AS n FROM l GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c USING (vec_id) LEFT JOIN d USING (vec_id)
"""


def oracle_sql() -> dict:
    import corpus_pipeline

    sql = {"op4_exact_dedup": OP4_SQL, "op5_warc": OP5_SQL, "op10_embedding": OP10_SQL}
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
