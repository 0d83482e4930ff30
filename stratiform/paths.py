"""Layer / source / table path template."""

from __future__ import annotations

from dataclasses import dataclass

LAYERS = ("bronze", "silver", "gold")


@dataclass(frozen=True)
class TablePath:
    root: str
    layer: str
    source: str
    table: str

    def __post_init__(self):
        if self.layer not in LAYERS:
            raise ValueError(f"unknown layer {self.layer!r}; expected one of {LAYERS}")

    def __str__(self) -> str:
        return f"{self.root.rstrip('/')}/{self.layer}/{self.source}/{self.table}"


@dataclass(frozen=True)
class Lake:
    """All tables of one source under one root."""
    root: str
    source: str = "neo_feed"

    def path(self, layer: str, table: str) -> str:
        return str(TablePath(self.root, layer, self.source, table))

    @property
    def bronze_approaches(self) -> str:
        return self.path("bronze", "approaches")

    @property
    def bronze_rejects(self) -> str:
        """Feed objects that could not be flattened (no close approach)."""
        return self.path("bronze", "approaches_rejected")

    @property
    def bronze_metadata(self) -> str:
        return self.path("bronze", "metadata")

    @property
    def silver_approaches(self) -> str:
        return self.path("silver", "approaches")

    @property
    def silver_metadata(self) -> str:
        return self.path("silver", "metadata")

    @property
    def gold_daily_summary(self) -> str:
        return self.path("gold", "daily_summary")

    @property
    def gold_partials(self) -> str:
        """Mergeable state of the summary, one row per (day, id)."""
        return self.path("gold", "daily_partials")

    @property
    def gold_by_day(self) -> str:
        """The daily summary, one partition per day."""
        return self.path("gold", "daily_summary_by_day")
