"""A training corpus from raw documents, in five stages.

quality -> toxicity -> near-duplicates -> decontamination -> packing.  Every stage takes
the documents its predecessor kept, is written as Parquet and read again; all but the
last return whole rows of the documents table, the last returns the packed pieces with their ids.

Decisions are made by row.  A row whose id is its own is named by it; rows without an id, and rows that share
one, are named by a hash of their columns (above 2^62, so that a document with an id of its own stands for a group of copies).  So
they are judged like all others, and of rows that are equal in every column one stays.  A table without rows gives a table without
rows at every stage, texts without words are rejected by the quality stage, and other columns are handed on.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.llm.common import attached, staged, table
from stratiform.llm.decontam import contaminated
from stratiform.llm.minhash import near_duplicates
from stratiform.llm.packing import pack_documents
from stratiform.llm.quality import score_quality
from stratiform.llm.toxicity import score_toxicity
from stratiform.operators.joins import sized_join
from stratiform.session import new_scratch_dir, scratch_scope

_OWN = "__own_id"


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a ``doc_id`` that names the row, the given one in ``__own_id``; rows equal in every column become one."""
    shared = staged(docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                    .select("doc_id", F.lit(True).alias("__shared")), "shared-ids")
    marked = attached(docs, shared, ["doc_id"]).withColumn("__shared", F.coalesce("__shared", F.col("doc_id").isNull()))
    place = F.pmod(F.xxhash64(*[F.coalesce(F.xxhash64(F.lit(i), c), F.lit(i)) for i, c in enumerate(docs.columns)]), F.lit(1 << 62)) + F.lit(1 << 62)
    named = marked.select(*[F.col(c) for c in docs.columns if c != "doc_id"], F.col("doc_id").alias(_OWN), "__shared",
                          F.when(F.col("__shared"), place).otherwise(F.col("doc_id")).alias("doc_id"))
    single = named.where(~F.col("__shared")).drop("__shared")
    return single.unionByName(named.where("__shared").drop("__shared").dropDuplicates(["doc_id"]))


def _without(rows: DataFrame, rejected: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that are not rejected, as they came; their texts move only if the id list is too large to broadcast."""
    kept = sized_join(rows, rejected.select("doc_id").distinct(), "doc_id", "left_anti")
    return kept.select(*[F.col(_OWN if c == "doc_id" else c).alias(c) for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, trusted = by_row(docs), table(spark, sf_dir, "labels").where("quality = 1")
    return _without(rows, staged(score_quality(rows, trusted).where(~F.col("kept")).select("doc_id"), "poor"), docs.columns)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = by_row(docs)
    scored = score_toxicity(rows, table(spark, sf_dir, "labels"))
    return _without(rows, staged(scored.where("predicted = 1").select("doc_id"), "toxic"), docs.columns)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = by_row(docs)
    found = near_duplicates(rows, shingle=5, percent=80)
    return _without(rows, staged(found.where(~F.col("kept")).select("doc_id"), "copies"), docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = by_row(docs)
    return _without(rows, staged(contaminated(rows, table(spark, sf_dir, "benchmark")).select("doc_id"), "leaks"), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN, with_ids=True)


STAGES = [("quality", quality), ("toxicity", toxicity), ("near-duplicates", near_duplicate),
          ("decontamination", decontamination), ("packing", packing)]

#: SQL can express neither the language model, the trained classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows.  What a stage staged is removed once its result is written, its input once the next one is."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_scratch_dir(spark, f"stage-{name}")
        with scratch_scope(spark, remove=[before]):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs, before = spark.read.parquet(path), path
    return docs
