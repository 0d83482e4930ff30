"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratiform.operators.joins import fits_broadcast, skew_safe_join
from stratiform.session import new_scratch_dir

LONG_MIN = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back.

    Cuts the lineage with a table that survives the loss of any executor.
    """
    path = new_scratch_dir(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(id_col: str = "doc_id", folds: int = 3):
    """crc32 of the id as text, modulo ``folds``; NULL id gives NULL."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % F.lit(folds)


def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; a worker that has returned them all gives its unused Arrow memory back before it waits."""
    yield from batches
    pa.default_memory_pool().release_unused()


def spread_join(left: DataFrame, right: DataFrame, keys: list[str], rows_col: str, how: str = "inner",
                most_hot: int = 100_000, least_hot: int = 1_000, counts: DataFrame | None = None, where: Column | None = None) -> DataFrame:
    """``left`` join ``right`` on ``keys``, where ``right`` has one row per key and says in ``rows_col`` how many rows
    of ``left`` carry it.

    A key with more rows than a ``most_hot``-th of all (and than ``least_hot``) is dealt over as many tasks as it
    exceeds that number; its one right row is repeated so often.  The salt is a hash of the left row, so a task
    that is run again deals its rows alike.  There are fewer than ``most_hot`` such keys whatever the input, which bounds the
    list that is broadcast, and at most that many repeated rows.  ``how`` is inner or left.  ``counts`` holds keys and
    rows when ``right`` itself does not, ``where`` is a further condition on the sides ``l`` and ``r``.
    """
    counts = right if counts is None else counts
    total = counts.agg(F.coalesce(F.sum(rows_col), F.lit(0))).first()[0]
    bar = max(least_hot, total // most_hot)
    hot = F.broadcast(counts.where(F.col(rows_col) > bar)
                      .select(*keys, F.ceil(F.col(rows_col) / F.lit(bar)).cast("int").alias("__parts")))
    salt = F.coalesce(F.pmod(F.xxhash64(*[left[c] for c in left.columns]), F.col("__parts")), F.lit(0)).cast("int")
    dealt = left.join(hot, keys, "left").select(*[left[c] for c in left.columns], salt.alias("__salt"))
    copies = F.explode(F.coalesce(F.sequence(F.lit(0), F.col("__parts") - 1), F.array(F.lit(0))))
    known = right.join(hot, keys, "left").select(*[right[c] for c in right.columns], copies.alias("__salt"))
    if where is None:
        return dealt.join(known, [*keys, "__salt"], how).drop("__salt")
    same = reduce(lambda a, b: a & b, [F.col(f"l.{k}") == F.col(f"r.{k}") for k in (*keys, "__salt")])
    return (dealt.alias("l").join(known.alias("r"), same & where, how)
            .select(*[F.col(f"l.{c}") for c in left.columns], *[F.col(f"r.{c}") for c in right.columns if c not in keys]))


def attached(rows: DataFrame, known: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """``rows`` join ``known`` (one row per key); the rows stay in place while ``known`` is small, beyond it a hot key is salted."""
    own = [f"__k_{k}" for k in keys]
    named = known.select(*[F.col(k).alias(o) for k, o in zip(keys, own)], *[c for c in known.columns if c not in keys])
    if fits_broadcast(named):
        joined = rows.join(F.broadcast(named), [rows[k] == named[o] for k, o in zip(keys, own)], how)
    else:
        joined = skew_safe_join(rows, named, keys, own, how)
    return joined.drop(*own)
