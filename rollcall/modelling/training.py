"""The training job as one call: specification, matrix, split, search, registry, stored model, stored scores."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.modelling.fitting import DEFAULT_GRID, fit_forest
from rollcall.modelling.matrix import training_matrix
from rollcall.modelling.scoring import save_model, score
from rollcall.modelling.split import stratified_split
from rollcall.plans.registry import register
from rollcall.plans.spec import ModelSpec
from rollcall.session import settle
from rollcall.sources.sinks import append_results


@dataclass(frozen=True)
class TrainingRun:
    """What a run leaves: the model's id, the registry with it, the fitted model and where it and its scores are stored."""

    algorithm_id: int
    registry: DataFrame
    model: CrossValidatorModel | PipelineModel
    model_path: str
    results_path: str


def train_model(
    spec: ModelSpec,
    tables: Mapping[str, DataFrame],
    registry: DataFrame,
    models: str,
    results: str,
    grid: Mapping[str, Mapping[str, Sequence]] = DEFAULT_GRID,
    algorithm_id: int | None = None,
    label: str = "outcome",
    key: Sequence[str] = DEFAULT_KEY,
    test: float = 0.2,
    folds: int = 5,
    parallelism: int = 2,
    seed: int = 1100,
    unique: bool = True,
) -> TrainingRun:
    """Train the model of a specification and store it.

    The training cohort's matrix is split by label, the grid is searched on the training rows, the best pipeline is saved
    below ``models`` and the scores of both sets are appended to ``results`` with their set and the model's id. The id
    comes from the registry (or must be free there), so a model never gets the rows of another. Rows without an outcome
    are left out. The caller stores the returned registry last: until then the run does not count and can be repeated.
    """
    registered, algorithm_id = register(registry, spec, tables, algorithm_id, key)
    matrix = training_matrix(spec, tables, key, unique).dropna(subset=[label])
    # the matrix is read by the search and by both scorings, so its joins are done once
    parts = settle(stratified_split(matrix, label, key, seed, test))
    train, held_out = (parts.filter(F.col("set") == name).drop("set") for name in ("train", "test"))
    model = fit_forest(train, label, key, grid, folds, parallelism, seed=seed)
    model_path = save_model(model, models, algorithm_id)
    append_results(score(model, train, key, label), score(model, held_out, key, label), algorithm_id, results)
    return TrainingRun(algorithm_id, registered, model, model_path, results)
