"""The table of registered models."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall import DEFAULT_KEY
from rollcall.plans.spec import ModelSpec
from rollcall.sources.tables import feature_catalog

SCHEMA = "id bigint, name string, description string, details array<string>, is_production boolean"


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def next_id(registry: DataFrame) -> int:
    """One more than the largest id (one job); the registry has a single writer."""
    return int(registry.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]) + 1


def register(
    registry: DataFrame,
    spec: ModelSpec,
    blocks: Mapping[str, DataFrame],
    algorithm_id: int | None = None,
    key: Sequence[str] = DEFAULT_KEY,
) -> tuple[DataFrame, int]:
    """Add a model with its specification as JSON and its feature list; fails if the id is taken."""
    if algorithm_id is None:
        algorithm_id = next_id(registry)
    elif not registry.filter(F.col("id") == algorithm_id).isEmpty():
        raise ValueError(f"algorithm id {algorithm_id} exists")
    chosen = {b: blocks[b] for b in spec.features}
    details = feature_catalog(chosen, spec.features, key)
    row = (algorithm_id, spec.name, json.dumps(spec.to_dict(), sort_keys=True), details, False)
    return registry.unionByName(registry.sparkSession.createDataFrame([row], SCHEMA)), algorithm_id


def set_production(registry: DataFrame, ids: Sequence[int], id_column: str = "id") -> DataFrame:
    """Make exactly these models the production set."""
    return registry.withColumn("is_production", F.coalesce(F.col(id_column).isin(list(ids)), F.lit(False)))


def production_ids(registry: DataFrame, is_production: Column | None = None) -> DataFrame:
    """Ids of production models; the flag may be boolean or 0/1."""
    condition = F.col("is_production").cast("int") == 1 if is_production is None else is_production
    return registry.filter(condition).select(F.col("id").alias("algorithm_id"))


def only_production(scores: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows scored by a production model."""
    return scores.join(production_ids(registry), ["algorithm_id"], "left_semi")


__all__ = ["SCHEMA", "empty_registry", "next_id", "only_production", "production_ids", "register", "set_production"]
