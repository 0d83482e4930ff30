"""The corpus pipeline: rows without an id or under a shared one, equal rows, every stage, scratch folders."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratiform.llm.common import table
from stratiform.session import new_scratch_dir

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def world(spark):
    """The small tables, with rows added to documents: copies without an id, shared ids, equal rows."""
    path = new_scratch_dir(spark, "world")
    for name in ("labels", "benchmark"):
        table(spark, SF, name).write.parquet(f"{path}/{name}.parquet")
    docs = table(spark, SF, "documents")
    labels = table(spark, SF, "labels")
    toxic = docs.join(labels.where("toxic = 1").select("doc_id"), "doc_id", "left_semi").orderBy("doc_id").limit(3).select(docs.columns)
    good = docs.join(labels.where("quality = 1 AND toxic = 0").select("doc_id"), "doc_id", "left_semi").orderBy("doc_id").limit(6).select(docs.columns)
    item = table(spark, SF, "benchmark").orderBy("item_id").first()["text"]
    leak = good.limit(1).withColumn("text", F.concat("text", F.lit("\n" + item))).withColumn("doc_id", F.lit(None).cast("bigint"))
    nameless = toxic.unionByName(good).withColumn("doc_id", F.lit(None).cast("bigint"))
    junk = good.limit(1).withColumn("text", F.repeat(F.lit("zq#xv "), 60)).withColumn("doc_id", F.lit(None).cast("bigint"))
    shared = toxic.withColumn("doc_id", F.lit(900_001)).unionByName(good.limit(2).withColumn("doc_id", F.lit(900_001)))
    docs.unionByName(nameless).unionByName(shared).unionByName(leak).unionByName(junk).unionByName(good.limit(2)).write.parquet(f"{path}/documents.parquet")
    return path


def test_rows_are_named_once(spark, world):
    docs = table(spark, world, "documents")
    named = corpus_pipeline.by_row(docs)
    assert named.count() == named.select("doc_id").distinct().count() == docs.distinct().count()
    assert named.where(F.col("doc_id") < 1 << 62).where("doc_id <> __own_id").count() == 0


def test_every_stage(spark, world):
    """Each stage returns whole rows of its input; what it rejects is what its operator says of the rows' texts."""
    docs = table(spark, world, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = new_scratch_dir(spark, "one-stage")
        stage(spark, docs, world).write.parquet(path)
        kept = spark.read.parquet(path)
        assert kept.columns == docs.columns and kept.exceptAll(docs.distinct()).count() == 0
        seen[name] = (docs, kept)
        docs = kept
    before, after = seen["quality"]
    assert after.where("text LIKE 'zq#xv %'").count() == 0 < before.where("text LIKE 'zq#xv %'").count()
    before, after = seen["toxicity"]
    scored = corpus_pipeline.score_toxicity(corpus_pipeline.by_row(before), table(spark, world, "labels")).where("predicted = 1").count()
    assert after.count() == before.distinct().count() - scored and scored > 0
    before, after = seen["near-duplicates"]
    assert after.select("text").distinct().count() == after.count()  # copies without an id are gone as well
    before, after = seen["decontamination"]
    item = table(spark, world, "benchmark").orderBy("item_id").first()["text"]
    assert after.where(F.col("text").contains(item)).count() == 0
    packed = corpus_pipeline.packing(spark, docs, world)
    assert packed.where("octet_length(ids) <> 4 * length OR crc32(ids) <> ids_crc32").count() == 0 < packed.count()
    whole = packed.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("t")).where("doc_id IS NOT NULL")
    assert whole.where("n <> t").count() == 0 and whole.count() == docs.where("doc_id IS NOT NULL").count()


def test_run_leaves_only_its_result(spark, world):
    root = new_scratch_dir(spark, "x").rsplit("/", 1)[0].replace("file:", "")
    before = set(os.listdir(root))
    out = corpus_pipeline.run(spark, world)
    assert out.count() > 0
    new = set(os.listdir(root)) - before
    assert [n for n in new if not n.startswith("stage-packing")] == []


def test_empty_documents_and_extra_columns(spark, world):
    path = new_scratch_dir(spark, "empty-world")
    for name in ("labels", "benchmark"):
        table(spark, world, name).write.parquet(f"{path}/{name}.parquet")
    empty = table(spark, world, "documents").limit(0).withColumn("node", F.lit(1)).withColumn("n", F.lit("x"))
    empty.write.parquet(f"{path}/documents.parquet")
    assert corpus_pipeline.run(spark, path).count() == 0
