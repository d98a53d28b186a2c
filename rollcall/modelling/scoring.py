"""Score rows with a fitted pipeline; keep and find models by id."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.values import net_score, round_even
from rollcall.modelling.fitting import best_pipeline, label_index


def class_labels(model: CrossValidatorModel | PipelineModel) -> list[str]:
    return list(label_index(best_pipeline(model).stages).labels)


def score(
    model: CrossValidatorModel | PipelineModel,
    df: DataFrame,
    key: Sequence[str] = DEFAULT_KEY,
    label: str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Key, optional true label, and ``predicted_<class>`` per class; with two classes only the second."""
    labels = class_labels(model)
    chosen = list(enumerate(labels)) if len(labels) > 2 else [(1, labels[1])]
    truth = [F.col(label).alias("outcome")] if label else []
    scored = best_pipeline(model).transform(df).withColumn("p__", vector_to_array("probability"))
    return scored.select(*key, *keep, *truth, *[F.col("p__")[i].alias(f"predicted_{c}") for i, c in chosen])


def with_net_score(scores: DataFrame, best: str, worst: str, digits: int = 2) -> DataFrame:
    """Add ``score``: probability of the best minus that of the worst class, half-even rounded.

    It needs a column per class, so a model of two classes has no such score.
    """
    for c in (best, worst):
        if f"predicted_{c}" not in scores.columns:
            raise ValueError(f"the model gives no predicted_{c}")
    return scores.withColumn("score", round_even(net_score(f"predicted_{best}", f"predicted_{worst}"), digits))


def save_model(model: CrossValidatorModel | PipelineModel, root: str, algorithm_id: int) -> str:
    """Write the pipeline with its label and encoding state below ``root``; the id must be new."""
    path = f"{root.rstrip('/')}/id={algorithm_id}"
    best_pipeline(model).write().save(path)
    return path


def load_model(root: str, algorithm_id: int) -> PipelineModel:
    return PipelineModel.load(f"{root.rstrip('/')}/id={algorithm_id}")
