"""The queries over these operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetry.llm import bpe, exact_topk, html_extract, line_dedup, near_dup, packing, pii, quality, secret_scan, simhash
from facetry.llm.common import table, written


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), keep_ids=False)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.draw(docs, table(spark, sf_dir, "labels"), keep_text=False).select("doc_id", "log_ratio", "log_weight", "gumbel_key", "keep")


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.detect(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digest(written(simhash.with_edited(table(spark, sf_dir, "documents")), "prints"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents")).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_hexlike", "n_base64")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.components(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


QUERIES = {f.__name__: f for f in (op1_bpe, op2_packing, op3_quality, op4_pii, op5_simhash, op6_secrets, op7_line_dedup, op8_near_dup, op9_topk, op10_html)}
SQL: dict[str, str] = {"op7_line_dedup": line_dedup.SQL, "op9_topk": exact_topk.SQL}
