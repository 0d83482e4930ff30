"""Tables ordered by a lookup key inside their partitions, so that a lookup skips most row groups.

Rows are dealt by ranges of (partition columns, key) and sorted in each task, so every row group
covers a short range of keys; a Parquet bloom filter on the key tells which groups lack a value
inside their range.  A lookup of a short list of keys is pushed to the scan as literals.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stratiform.sources.landed import read_table

ROW_GROUP_BYTES = 16 * 1024 * 1024
PUSHED_MOST = 1_000  # keys pushed to the scan as literals at once


def write_clustered(df: DataFrame, path: str, key: str, partition_by: Sequence[str] = (), tasks: int | None = None,
                    row_group_bytes: int = ROW_GROUP_BYTES, expected_keys: int = 1_000_000) -> str:
    """Write ``df`` ordered by ``key`` within its partitions, with a bloom filter on ``key``.

    The ranges are found by sampling, and a key that fills several of them is split at the other columns' hash, so
    a hot key or a large partition is no single task's.  ``expected_keys`` is the number of distinct keys of a
    row group that the filter is sized for.
    """
    place = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    order = [*partition_by, key]
    dealt = df.withColumn("__place", place)
    dealt = dealt.repartitionByRange(tasks, *order, "__place") if tasks else dealt.repartitionByRange(*order, "__place")
    writer = (dealt.sortWithinPartitions(*order).drop("__place").write.mode("overwrite")
              .option("parquet.block.size", row_group_bytes)
              .option(f"parquet.bloom.filter.enabled#{key}", "true")
              .option(f"parquet.bloom.filter.expected.ndv#{key}", expected_keys))
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return path


def lookup_keys(spark: SparkSession, path: str, schema: StructType, key: str, values: Sequence) -> DataFrame:
    """Rows of the table whose key is one of ``values``, a list that its caller names (not data): at most ``PUSHED_MOST``."""
    if len(values) > PUSHED_MOST:
        raise ValueError(f"{len(values)} keys are too many literals; join with a table of keys instead")
    rows = read_table(spark, path, schema)
    if not values:
        return rows.where(F.lit(False))
    # one equality per value: each is tested against the statistics and the bloom filter of every row group
    wanted = F.col(key) == F.lit(values[0])
    for v in values[1:]:
        wanted = wanted | (F.col(key) == F.lit(v))
    return rows.where(wanted)
