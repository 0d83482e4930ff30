"""Registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stratiform.llm.chat import rotate
from stratiform.llm.collocations import collocations
from stratiform.llm.common import table
from stratiform.llm.decontam import contaminated
from stratiform.llm.embdup import near_duplicate_vectors
from stratiform.llm.filteraudit import filter_interactions
from stratiform.llm.licenses import scan_licenses
from stratiform.llm.minhash import near_duplicates
from stratiform.llm.packing import pack_documents
from stratiform.llm.passages import repeated_passages
from stratiform.llm.quality import score_quality
from stratiform.llm.tokencount import token_counts
from stratiform.llm.toxicity import score_toxicity
from stratiform.llm.warc import capture_histories, write_archives
from stratiform.session import new_scratch_dir


def op1_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op2_contaminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The places are starts of base phrases, the smallest and the largest."""
    return scan_licenses(table(spark, sf_dir, "documents")).selectExpr(
        "doc_id", "n_words", "n_base", "first_word", "last_start AS last_word", "base_labels", "labels", "score")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op5_near_duplicate_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), cosine=0.98)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return score_quality(table(spark, sf_dir, "documents"), trusted)


def op7_capture_histories(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_scratch_dir(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), path)
    return capture_histories(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op10_rotate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per conversation, participant and part; the spans as text, for comparison."""
    return rotate(table(spark, sf_dir, "conversations")).selectExpr(
        "conv_id", "speaker", "part", "n_turns", "rendered",
        "array_join(transform(mask, m -> concat(m.start, '-', m.end)), ',') AS mask_spans",
        "aggregate(mask, 0L, (a, m) -> a + m.end - m.start) AS mask_chars")


def op11_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"), window=50).selectExpr(
        "doc_id", "n_words", "aggregate(removed, 0L, (n, s) -> n + s.end - s.start) AS n_removed", "sha2(kept, 256) AS kept_sha256")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, top=2_000)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op1_pack": op1_pack, "op2_contaminated": op2_contaminated, "op3_licenses": op3_licenses, "op4_token_counts": op4_token_counts,
           "op5_near_duplicate_vectors": op5_near_duplicate_vectors, "op6_quality": op6_quality,
           "op7_capture_histories": op7_capture_histories, "op8_toxicity": op8_toxicity,
           "op9_near_duplicates": op9_near_duplicates, "op10_rotate": op10_rotate,
           "op11_repeated_passages": op11_repeated_passages, "op12_collocations": op12_collocations,
           "op13_filter_audit": op13_filter_audit}
