"""Queries of the corpus operators and their SQL, by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, chroma, langid, mixing, pii, quality, repeats, simhash, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def site_columns() -> tuple[Column, Column]:
    """Host and path of a document: its source, and the part of the source in its language."""
    return F.col("source"), F.col("lang")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), F.col("component").alias("component_id"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = quality.score(docs, _table(spark, sf_dir, "labels"), *site_columns(), columns=["doc_id"])
    return found.select("doc_id", *(F.round(f"quality_{x}", 6).alias(x) for x in ("evidence", "shift", "score")), (F.col("quality_score") >= 0).alias("keep"))


def op3_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.deduplicated(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chroma.excerpts_found(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = langid.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))
    return found.withColumnRenamed("id", "page_id").withColumn("confidence", F.round("confidence", 6))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(_table(spark, sf_dir, "documents"), pii.session_key(spark)).select("doc_id", "text", "n_pseudonyms")


def op7_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(_table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents")))
    n = (F.octet_length("ids") / 4).cast("long")
    return found.select(F.col("id").alias("doc_id"), n.alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op9_ivf_pq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(_table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


QUERIES = {f.__name__: f for f in (op1_simhash_near_dedup, op2_quality, op3_repeats, op4_chroma, op5_language_id, op6_pii, op7_warc_bundles, op8_bpe, op9_ivf_pq, op10_mixing)}

ORACLES: dict[str, str] = {
    "op7_warc_bundles": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS leader FROM pages)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((CAST('0x' || substr(h, CAST(i // 4 * 5 + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31) + 1 AS INT), 1)), '') AS payload_digest,
  CASE WHEN page_id = leader THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> leader THEN leader END AS refers_to
FROM p"""
}
