"""Table writes: overwrite with a schema guard, partitioned layout, layout migration."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiform.operators.observed import observed
from stratiform.sources.landed import path_exists, stored_schema


class SchemaMismatch(ValueError):
    pass


def _shape(schema: StructType) -> list[tuple[str, str]]:
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


def check_schema(incoming: StructType, stored: StructType, partition_by: Iterable[str] | None = None) -> None:
    """Raise when the incoming columns differ from the stored ones (order-insensitive)."""
    got, have = dict(_shape(incoming)), dict(_shape(stored))
    if got != have:
        missing = sorted(set(have) - set(got))
        extra = sorted(set(got) - set(have))
        changed = sorted(k for k in set(got) & set(have) if got[k] != have[k])
        raise SchemaMismatch(f"schema differs from the stored table: missing={missing} "
                             f"extra={extra} changed_type={changed}")


def _writer(df: DataFrame, mode: str, partition_by: list[str] | None, rebalance: bool, observation: Observation | None = None):
    # AQE sizes the write tasks (advisory partition size): hot partition values are
    # split, small outputs merged, so repeated small appends do not pile up files
    if rebalance:
        df = df.hint("rebalance", *(partition_by or []))
    if observation is not None:
        # past the last shuffle: a result task counts once, however often it or an earlier one is retried
        df = observed(df, observation)
    writer = df.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def stored_layout(spark: SparkSession, path: str) -> list[str]:
    """Partition columns of the table at ``path``, from its folder names (first branch only)."""
    fs, hpath = _file_system(spark, path)
    found, here = [], path
    while True:
        names = [s.getPath().getName() for s in fs.listStatus(hpath(here)) if s.isDirectory() and "=" in s.getPath().getName()]
        if not names:
            return found
        found.append(names[0].split("=", 1)[0])
        here = f"{here}/{names[0]}"


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None,
                replace_schema: bool = False, rebalance: bool = True, observation: Observation | None = None) -> str:
    """Save ``df`` as Parquet.  A changed schema is refused unless ``replace_schema``.

    An overwrite is written to a new folder beside the table and switched in when it is
    complete, so a failed write leaves the old table, and ``df`` may read the table it
    replaces.  An append must have the stored partition columns: rows written beside
    partition folders would not be read back.  ``observation`` takes the counts of the rows written (``observed``).
    """
    spark = df.sparkSession
    exists = path_exists(spark, path)
    if exists and not replace_schema:
        stored = stored_schema(spark, path)
        if stored is not None:
            check_schema(df.schema, stored, partition_by)
            if mode == "append" and stored_layout(spark, path) != list(partition_by or []):
                raise SchemaMismatch(f"partition columns differ from the stored table: {stored_layout(spark, path)}")
    if mode != "overwrite" or not exists:
        _writer(df, mode, partition_by, rebalance, observation).parquet(path)
        return path
    fresh = f"{path.rstrip('/')}__new-{uuid.uuid4().hex[:12]}"
    _writer(df, "error", partition_by, rebalance, observation).parquet(fresh)
    fs, hpath = _file_system(spark, path)
    switch_folders(fs, hpath, path, fresh)
    spark.catalog.refreshByPath(path)
    return path


def switch_folders(fs, hpath, path: str, fresh: str) -> None:
    """Put the folder ``fresh`` in place of ``path``; the old one is moved aside first and moved back when that fails.

    A reader that lists the table between the two moves finds none; one that listed it before
    keeps reading the old files until they are deleted at the end.
    """
    aside = f"{path.rstrip('/')}__old-{uuid.uuid4().hex[:12]}"
    if not fs.rename(hpath(path), hpath(aside)):
        raise OSError(f"could not move {path} aside; the new rows are in {fresh}")
    moved = False
    try:
        moved = fs.rename(hpath(fresh), hpath(path))
    finally:
        if not moved and not fs.rename(hpath(aside), hpath(path)):
            raise OSError(f"the table {path} is in {aside}, the new rows are in {fresh}: neither could be moved")
    if not moved:
        raise OSError(f"could not move {fresh} to {path}; the old table is back in place")
    fs.delete(hpath(aside), True)


def replace_partitions(df: DataFrame, path: str, partition_by: list[str], observation: Observation | None = None) -> str:
    """Overwrite only the partitions that ``df`` holds rows of; the others stay as they are."""
    _writer(df, "overwrite", partition_by, True, observation).option("partitionOverwriteMode", "dynamic").parquet(path)
    return path


def append_table(df: DataFrame, path: str, partition_by: list[str] | None = None, rebalance: bool = True,
                 observation: Observation | None = None) -> str:
    return write_table(df, path, mode="append", partition_by=partition_by, rebalance=rebalance, observation=observation)


@dataclass(frozen=True)
class Move:
    name: str
    old_path: str
    new_path: str
    partition_by: tuple[str, ...] | None = None


def migrate_layout(spark: SparkSession, moves: Iterable[Move]) -> DataFrame:
    """Copy each table to its new location with its own partition columns.

    Returns ``(table, rows)`` read back from the new locations.
    """
    counts = []
    for m in moves:
        src = spark.read.parquet(m.old_path)
        write_table(src, m.new_path, mode="overwrite",
                    partition_by=list(m.partition_by) if m.partition_by else None, replace_schema=True)
        counts.append(spark.read.parquet(m.new_path)
                      .agg(F.count(F.lit(1)).alias("rows"))
                      .select(F.lit(m.name).alias("table"), "rows"))
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
