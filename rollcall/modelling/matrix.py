"""Training and scoring matrices of a model specification.

``tables`` holds the cohort table, the outcome table, the population and the feature blocks by name. Both
matrices start from keys, so a record that one block lacks is still trained on and still scored.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from rollcall import DEFAULT_KEY
from rollcall.operators.relational import in_keys
from rollcall.plans.cohorts import cohort_keys, not_scored_yet
from rollcall.plans.feature_sets import design_matrix, feature_blocks
from rollcall.plans.spec import ModelSpec


def training_matrix(
    spec: ModelSpec, tables: Mapping[str, DataFrame], key: Sequence[str] = DEFAULT_KEY, unique: bool = True
) -> DataFrame:
    """Outcome rows of the training cohort with all feature blocks."""
    members = cohort_keys(tables[spec.cohort_table], spec, "fit", key)
    outcome = in_keys(tables[spec.outcome], members, key)
    return design_matrix(outcome, feature_blocks(tables, spec.features), key, unique)


def scoring_matrix(
    spec: ModelSpec,
    tables: Mapping[str, DataFrame],
    predictions: DataFrame,
    algorithm_id: int,
    key: Sequence[str] = DEFAULT_KEY,
    unique: bool = True,
) -> DataFrame:
    """Features of the population's members of the scoring cohort that this model has not scored yet."""
    members = cohort_keys(tables[spec.cohort_table], spec, "predict", key)
    waiting = not_scored_yet(tables[spec.population], members, predictions, algorithm_id, key)
    return design_matrix(waiting, feature_blocks(tables, spec.features), key, unique)
