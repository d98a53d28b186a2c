"""Declarative configuration: model specification, column rules, outcome years, hyper-parameter grid."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from pathlib import Path

import yaml


def load_yaml(path: str | Path) -> dict:
    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}


@dataclass(frozen=True)
class ModelSpec:
    """What a model is trained on and whom it scores.

    ``features`` maps a feature block to the columns that are left out of it. One rule, by block, holds both
    for the data and for the registered feature list.
    """

    name: str
    cohort_table: str
    cohort_column: str
    cohort_values: tuple[str, ...]
    outcome: str
    population: str
    features: Mapping[str, tuple[str, ...]] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, d: Mapping) -> "ModelSpec":
        cohort = d["cohorts"]
        return cls(
            name=d["algorithm_name"],
            cohort_table=cohort["tbl"],
            cohort_column=cohort["col"],
            cohort_values=tuple(str(v) for v in cohort["included"]),
            outcome=d["outcomes"],
            population=d["predictions"],
            features={block: tuple(drop or ()) for block, drop in d["features"].items()},
        )

    @classmethod
    def from_yaml(cls, path: str | Path) -> "ModelSpec":
        return cls.from_dict(load_yaml(path))

    def to_dict(self) -> dict:
        return {
            "algorithm_name": self.name,
            "cohorts": {
                "tbl": self.cohort_table,
                "col": self.cohort_column,
                "included": list(self.cohort_values),
            },
            "outcomes": self.outcome,
            "predictions": self.population,
            "features": {block: list(drop) for block, drop in self.features.items()},
        }


def year_ranges(path: str | Path) -> dict[str, tuple[int, int]]:
    """``{name: {min_year, max_year}}`` as inclusive ranges."""
    return {name: (int(r["min_year"]), int(r["max_year"])) for name, r in load_yaml(path).items()}


def column_rules(path: str | Path) -> dict[str, dict[str, list[str]]]:
    """``{table: {keep: [...]}}`` or ``{table: {drop: [...]}}``."""
    rules = load_yaml(path)
    for table, rule in rules.items():
        if not isinstance(rule, dict) or len(rule) != 1 or next(iter(rule)) not in ("keep", "drop"):
            raise ValueError(f"{table}: give exactly one of keep and drop")
    return rules
