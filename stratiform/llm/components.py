"""Connected components of an undirected link table, as Spark joins.

Alternates large-star and small-star steps until the links no longer change; every
node then points at the smallest id it can reach.  Each round is written to the shared
folder, so no lineage grows and a lost executor costs one round at most.  Minimum
labels are found by partial aggregation and brought back by a join that adaptive
execution may split, so a node with very many links is no single task's work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import staged


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.pmod(F.xxhash64("v", "u"), F.lit(1 << 20))).alias("s")).first()
    return row["n"], row["x"], row["s"]


def connected_components(links: DataFrame, src: str = "a", dst: str = "b") -> DataFrame:
    """(id, component) of every node that is not the smallest of its component.

    Links with a NULL end, and loops, are ignored.
    """
    a, b = F.col(src), F.col(dst)
    now = staged(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    before = None
    while True:
        state = _state(now)
        if state == before or state[0] == 0:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component"))
        before = state
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        large = (both.where("v > u").join(least, F.col("u") == F.col("x"))
                 .select(F.col("v").alias("u"), F.least("m", "x").alias("v")).distinct())
        smallest = large.groupBy(F.col("u").alias("x")).agg(F.min("v").alias("m"))
        hung = large.join(smallest, F.col("u") == F.col("x")).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = staged(hung.union(smallest.select(F.col("x").alias("u"), F.col("m").alias("v"))).distinct(), "links")
