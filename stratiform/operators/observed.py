"""Counts taken while a table is written: rows, NULLs per column, and rows that break a rule.

An ``Observation`` rides on the write's own plan, so no table is scanned again.  Each write leaves one
entry; a table's figures are the sums of its entries since the last that replaced it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ROWS, NULLS, BREAKS = "rows", "nulls:", "breaks:"


def observed(df: DataFrame, observation: Observation, rules: Mapping[str, Column] | None = None,
             columns: Sequence[str] | None = None) -> DataFrame:
    """``df`` that reports its rows, the NULLs of ``columns`` (all, unless given) and the rows on which a rule holds."""
    nulls = [F.count(F.when(F.col(f"`{c}`").isNull(), 1)).alias(f"{NULLS}{c}") for c in (df.columns if columns is None else columns)]
    breaks = [F.count(F.when(rule, 1)).alias(f"{BREAKS}{name}") for name, rule in (rules or {}).items()]
    return df.observe(observation, F.count(F.lit(1)).alias(ROWS), *nulls, *breaks)


@dataclass
class WriteLog:
    """What the writes of a run reported, table by table."""
    entries: list[tuple[str, str, bool, dict[str, int]]] = field(default_factory=list)

    def take(self, layer: str, table: str, observation: Observation, replaces: bool = False) -> dict[str, int]:
        """Add the figures of a finished write."""
        found = dict(observation.get)
        self.entries.append((layer, table, replaces, found))
        return found

    def totals(self) -> dict[tuple[str, str], dict[str, int]]:
        out: dict[tuple[str, str], dict[str, int]] = {}
        for layer, table, replaces, found in self.entries:
            here = out.setdefault((layer, table), {})
            if replaces:
                here.clear()
            for k, v in found.items():
                here[k] = here.get(k, 0) + v
        return out

    def report(self, spark: SparkSession) -> DataFrame:
        """``(layer, table, measure, column, n)``: rows, nulls and breaks of every table written."""
        rows = []
        for (layer, table), found in self.totals().items():
            for k, n in found.items():
                kind, _, column = k.partition(":")
                rows.append((layer, table, kind, column or None, int(n)))
        return spark.createDataFrame(rows, "layer string, table string, measure string, column string, n bigint")
