"""Entity tables stored in buckets of their key, so that a merge or a pending filter does not shuffle them.

The table's files are dealt by the hash that a join on the key would deal its rows by, and the catalog
knows it.  A batch is shuffled to the same buckets; the stored side is read where it lies.  With
as many buckets as shuffle partitions, or more, Spark keeps the stored layout.

Keys compare with SQL ``=``; ``null_safe`` adds that a NULL key matches a stored NULL key.  The catalog entry
is only a name for the folder: ``bucketed_table`` registers it again in a new session.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiform.operators.tables import _file_system, check_schema

BUCKETS = 64  # at least the session's shuffle partitions, see buckets_for


def buckets_for(spark: SparkSession, least: int = BUCKETS) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def bucketed_table(spark: SparkSession, name: str, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """The table of that name over ``path``, registered when this session does not know it."""
    if not spark.catalog.tableExists(name):
        fs, hpath = _file_system(spark, path)
        fs.mkdirs(hpath(path))
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet OPTIONS (path '{path}') "
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS")
    return spark.table(name)


def missing_rows(batch: DataFrame, stored: DataFrame, key: str, null_safe: bool = False) -> DataFrame:
    """Rows of ``batch`` whose key ``stored`` lacks; only the key column of ``stored`` is read, in place."""
    keys = stored.select(F.col(key).alias("__key")).distinct()  # per bucket, without a shuffle
    left = batch if not null_safe else batch.where(F.col(key).isNotNull())
    fresh = left.join(keys, left[key] == keys["__key"], "left_anti")
    if null_safe and stored.where(F.col(key).isNull()).isEmpty():
        fresh = fresh.unionByName(batch.where(F.col(key).isNull()))
    return fresh


def append_bucketed(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """Add rows to a bucketed table: one file a bucket, whatever number of tasks brought them."""
    check_schema(rows.schema, rows.sparkSession.table(name).schema)
    (rows.select(*rows.sparkSession.table(name).columns).repartition(buckets, key).sortWithinPartitions(key)
     .write.insertInto(name))


def merge_bucketed(batch: DataFrame, name: str, path: str, key: str, schema: StructType, buckets: int | None = None) -> DataFrame:
    """Insert-only merge into a bucketed table: every row of ``batch`` whose key is not stored, duplicates of the batch included."""
    spark = batch.sparkSession
    buckets = buckets or buckets_for(spark)
    stored = bucketed_table(spark, name, path, schema, key, buckets)
    append_bucketed(missing_rows(batch, stored, key), name, key, buckets)
    return spark.table(name)
