"""Data-quality reports.  Each returns a DataFrame; the caller decides to warn or fail."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.functions.expr import official_number, provisional_designation, rebuilt_name
from stratiform.operators.joins import keys_bound, sized_join
from stratiform.operators.merge import anti_by_keys


def orphans_by_null(left: DataFrame, right: DataFrame, key: str = "id",
                    probe: str = "diameter_min_km") -> DataFrame:
    """``(key, orphan_rows)``: keys whose left join leaves ``probe`` NULL, and how many
    joined rows do -- a left row with no partner counts once, a left row with
    partners once per partner lacking the value.

    The multiset of orphan rows is kept whole as a count.  Both sides are reduced
    to one row per key first (map-side), so no pairs inside a key group are formed
    and a hot key costs no more than any other.
    """
    partners = (right.where(F.col(key).isNotNull())
                .groupBy(key)
                .agg(F.count(F.lit(1)).alias("_partners"),
                     F.count(F.when(F.col(probe).isNull(), 1)).alias("_missing")))
    rows = left.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    j = sized_join(rows, partners, key, "left", size_bound=keys_bound(right, key, 16))
    times = F.when(F.col("_partners").isNull(), F.lit(1)).otherwise(F.col("_missing"))
    return (j.select(key, (F.col("_rows") * times).cast("bigint").alias("orphan_rows"))
            .where(F.col("orphan_rows") > 0))


def orphans_by_key(left: DataFrame, right: DataFrame, keys: Sequence[str] = ("id",)) -> DataFrame:
    """Left rows with no partner key at all (missing keys only)."""
    # existence only: partner keys broadcast when measured small, else a hot left key is salted
    return anti_by_keys(left, right, list(keys), null_safe=False, measure_target=True)


def integrity_report(approaches: DataFrame, metadata: DataFrame, key: str = "id") -> DataFrame:
    """``(orphan_rows, orphan_ids)`` over the whole tables, as one row."""
    o = orphans_by_null(approaches, metadata, key)
    return o.agg(F.coalesce(F.sum("orphan_rows"), F.lit(0)).cast("bigint").alias("orphan_rows"),
                 F.count(F.col(key)).alias("orphan_ids"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row count ``n``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, nulls, rows)``: one pass, one partial aggregate per task."""
    cols = list(columns or df.columns)
    row = df.agg(F.count(F.lit(1)).alias("__rows"),
                 *[F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(c) for c in cols])
    return (row.unpivot(["__rows"], [F.col(f"`{c}`") for c in cols], "column", "nulls")
            .select("column", "nulls", F.col("__rows").alias("rows")))


def name_lossless(metadata_bronze: DataFrame, key: str = "id", name: str = "name") -> DataFrame:
    """Rows whose name cannot be rebuilt from the two parts silver keeps."""
    num = official_number(name)
    prov = provisional_designation(name)
    rebuilt = rebuilt_name(num, prov)
    return (metadata_bronze
            .select(F.col(key), F.col(name), num.alias("numero_oficial"),
                    prov.alias("designacion_provisional"), rebuilt.alias("rebuilt_name"))
            .where(~F.col("rebuilt_name").eqNullSafe(F.col(name))))
