"""The registered queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tideglass.llm.bpe_codec import token_digests
from tideglass.llm.exact_dedup import exact_dedup
from tideglass.llm.fingerprints import fingerprint_documents
from tideglass.llm.license_scan import license_sql, license_table
from tideglass.llm.packing import pack_documents
from tideglass.llm.piece_codec import piece_digests
from tideglass.llm.pii import span_digests
from tideglass.llm.resampling import resample, resample_sql
from tideglass.llm.simhash import simhash_dedup
from tideglass.llm.suffix_dedup import repeat_digests
from tideglass.llm.token_output import token_table
from tideglass.llm.toxicity import score_documents
from tideglass.llm.vector_codes import code_sql, code_table


def tokenizer_path(name: str) -> str:
    """Where the public vocabulary file lies; each worker has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup(_documents(spark, sf_dir))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_table(_documents(spark, sf_dir))


def op4_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_documents(spark, sf_dir))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digests(_documents(spark, sf_dir))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digests(_documents(spark, sf_dir))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_documents(spark, sf_dir), tokenizer_path("word_bpe_49k.json"))


def op10_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_table(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_documents(spark, sf_dir), tokenizer_path("piece_bpe_32k.model"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return code_table(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash_dedup, op2_bpe_codec, op3_license_scan, op4_document_fingerprints, op5_suffix_dedup, op6_toxicity, op7_pii, op8_exact_dedup, op9_packing, op10_token_output, op11_importance_resampling, op12_piece_codec, op13_vector_codes)}


def oracle_sql() -> dict[str, str]:
    return {
        "op3_license_scan": license_sql(),
        "op8_exact_dedup": """
            WITH t AS (
                SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
            ), g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM t JOIN g USING (norm)
        """,
        "op11_importance_resampling": resample_sql(),
        "op13_vector_codes": code_sql(),
    }
