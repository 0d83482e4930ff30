"""Readers for landed documents and stored layer tables.

The HTTP pulls of the original job are re-aimed at files that a landing step
has already written: one JSON document per line (splittable) or one document
per file (``multi_line=True``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructType

from stratiform import schemas


def read_feed(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Feed documents.  A malformed document aborts the read (FAILFAST), like a failed pull.

    JSON lines (the default) are split across tasks by size, so one huge landed
    file is no hot spot.  ``multi_line`` files are read whole by one task each:
    use it only for pull-sized documents (a pull covers at most a 7-day window).
    """
    return (spark.read.schema(schemas.FEED)
            .option("mode", "FAILFAST")
            .option("multiLine", multi_line)
            .json(path))


def _paths(schema: StructType, prefix: str = "$") -> list[tuple[str, str]]:
    """(path, wanted kind) of every field: object, number, flag or text."""
    out = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        if isinstance(f.dataType, StructType):
            out += [(path, "object"), *_paths(f.dataType, path)]
        else:
            out.append((path, {DoubleType: "number", LongType: "number", BooleanType: "flag"}.get(type(f.dataType), "text")))
    return out


# the types a JSON value may have to count as the wanted kind; an absent or null value fits any
_KINDS = {"object": "OBJECT.*", "number": "BIGINT|DECIMAL.*|DOUBLE", "flag": "BOOLEAN", "text": "STRING|BIGINT|DECIMAL.*|DOUBLE|BOOLEAN"}


def _typed(doc: Column, schema: StructType, prefix: str = "$") -> list[Column]:
    out = []
    for f in schema.fields:
        path = f"{prefix}.{f.name}"
        if isinstance(f.dataType, StructType):
            out.append(F.struct(*_typed(doc, f.dataType, path)).alias(f.name))
        else:
            out.append(F.try_variant_get(doc, path, f.dataType.simpleString()).alias(f.name))
    return out


def read_lookup_documents(spark: SparkSession, path: str, multi_line: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lookup documents split into (parsed, quarantine).

    A document that is not one whole JSON object, that names a key twice, holds a value of another type or
    has no id is not fatal: it goes to the quarantine frame with its raw text, its file and the reason, the rest
    goes on.  Both frames are lazy; nothing is collected.  One document per line, or per file with ``multi_line``.

    Parsing stops after the first value, whatever follows it.  So a document is parsed inside an array and inside an
    object: only a single value with nothing behind it can be followed by the end of both.
    """
    raw = spark.read.text(path, wholetext=multi_line).select("value", F.col("_metadata.file_path").alias("file_path"))
    in_object = F.try_parse_json(F.concat(F.lit('{"d":'), "value", F.lit("}")))
    in_array = F.try_parse_json(F.concat(F.lit("["), "value", F.lit("]")))
    whole = F.when(in_array.isNotNull(), F.try_variant_get(in_object, "$.d", "variant"))
    # through explode the parsed value is computed once a document, not once a use
    docs = raw.select("value", "file_path", F.explode(F.array(whole)).alias("doc"))
    kind = F.schema_of_variant("doc")
    misfits = [F.when(~F.schema_of_variant(F.try_variant_get("doc", at, "variant")).rlike(f"^({_KINDS[wanted]}|VOID)$"), at)
               for at, wanted in _paths(schemas.LOOKUP)]
    reason = (F.when(kind.isNull(), "not one JSON value").when(~kind.startswith("OBJECT"), "no object")
              .otherwise(F.coalesce(*[F.concat(F.lit("type of "), m) for m in misfits],
                                    F.when(F.try_variant_get("doc", "$.id", "string").isNull(), "no id"))))
    judged = docs.select("value", "file_path", "doc", F.explode(F.array(reason)).alias("reason"))
    parsed = judged.where("reason IS NULL").select(*_typed(F.col("doc"), schemas.LOOKUP))
    quarantine = judged.where("reason IS NOT NULL").select(F.col("value").alias("_corrupt_record"), "file_path", "reason")
    return parsed, quarantine


def quarantined_ids(quarantine: DataFrame) -> DataFrame:
    """Best-effort id of each quarantined document, for a later retry."""
    return quarantine.select(
        F.nullif(F.regexp_extract("_corrupt_record", r'"id"\s*:\s*"(\d+)"', 1), F.lit(""))
        .cast("bigint").alias("id"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test through the Hadoop file system of the path (works for any scheme).

    Without JVM access (Spark Connect) a zero-row file listing answers instead.
    """
    try:
        jvm = spark.sparkContext._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    except Exception:  # no SparkContext here
        try:
            spark.read.format("binaryFile").load(path).limit(0).collect()
            return True
        except Exception as e:
            if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
                return False
            raise
    return fs.exists(hpath)


def stored_schema(spark: SparkSession, path: str) -> StructType | None:
    """Schema of the table at ``path``; None when it does not exist or holds no data files yet."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path).schema
    except Exception as e:  # an empty table (created from an empty batch) has nothing to infer from
        if "UNABLE_TO_INFER_SCHEMA" in str(e) or "Unable to infer schema" in str(e):
            return None
        raise


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def table_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A missing table counts as an empty one with the declared schema."""
    if path_exists(spark, path):
        return read_table(spark, path, schema)
    return spark.createDataFrame([], schema)


def literal_ids(spark: SparkSession, ids, name: str = "id") -> DataFrame:
    """A small literal relation of ids (an operator-supplied list)."""
    return spark.createDataFrame([(int(i),) for i in ids], f"{name} bigint")
