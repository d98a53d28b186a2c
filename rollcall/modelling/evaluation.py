"""Measures of stored scores, as relational jobs, and feature importances."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import VarianceThresholdSelectorModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.modelling.fitting import encoded_columns, stage_of
from rollcall.operators.ordered import group_join, running_totals


def _curve(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    positive = F.col(label).cast("long")
    return running_totals(
        df.filter(F.col(label).isNotNull()), score, {"pos": positive, "neg": F.lit(1) - positive}, by
    )


def auc(df: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve of a 0/1 label, ties counted half; NULL if one class is missing."""
    curve = _curve(df, label, score, by)
    won = F.sum(F.col("pos").cast("double") * (F.col("neg_before") + F.col("neg") / 2))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return curve.groupBy(*by).agg(F.try_divide(won, pairs).alias("auc"))


def precision_recall(df: DataFrame, label: str, score: str, stop_at_full_recall: bool = False) -> DataFrame:
    """Precision, recall and share of rows at or above each distinct score.

    ``stop_at_full_recall`` leaves out the scores below the smallest one of a positive row.
    """
    curve = _curve(df, label, score)
    hits = F.col("pos_total") - F.col("pos_before")
    chosen = hits + F.col("neg_total") - F.col("neg_before")
    out = curve.select(
        F.col(score).alias("threshold"),
        (hits / chosen).alias("precision"),
        F.try_divide(hits.cast("double"), F.col("pos_total").cast("double")).alias("recall"),
        (chosen / (F.col("pos_total") + F.col("neg_total"))).alias("share_positive"),
        (F.col("pos_before") > 0).alias("after_first__"),
        (F.col("pos") > 0).alias("has_positive__"),
    )
    if stop_at_full_recall:
        out = out.filter(F.col("after_first__") | F.col("has_positive__"))
    return out.drop("after_first__", "has_positive__")


def hard_label(score: str | Column, threshold: float = 0.5) -> Column:
    """1 from the threshold on."""
    c = F.col(score) if isinstance(score, str) else score
    return (c >= threshold).cast("int")


def confusion(df: DataFrame, actual: str, predicted: str, classes: Sequence, normalize: bool = False) -> DataFrame:
    """Counts for every pair of classes, zeros included, and for every other pair that occurs (also with NULL).

    ``normalize`` adds the share among all rows of the actual class.
    """
    counts = df.groupBy(F.col(actual).alias("actual"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )
    every = (
        df.sparkSession.createDataFrame([(c,) for c in classes], ["actual"])
        .select(
            F.col("actual").cast(df.select(actual).schema[0].dataType),
            F.explode(F.array(*[F.lit(c) for c in classes])).alias("predicted"),
        )
        .withColumn("predicted", F.col("predicted").cast(df.select(predicted).schema[0].dataType))
    )
    pairs = every.unionByName(counts.select("actual", "predicted")).distinct()
    out = group_join(pairs, counts, ["actual", "predicted"], "left").fillna(0, ["n"])
    if normalize:
        totals = out.groupBy("actual").agg(F.sum("n").alias("total"))
        out = group_join(out, totals, ["actual"]).withColumn("share", F.try_divide(F.col("n"), F.col("total"))).drop("total")
    return out


def importances(model: CrossValidatorModel | PipelineModel, spark) -> DataFrame:
    """Rank, feature, importance and its standard deviation over the trees; one row per used feature."""
    forest = stage_of(model, RandomForestClassificationModel)
    kept = stage_of(model, VarianceThresholdSelectorModel).selectedFeatures
    names = [encoded_columns(model)[i] for i in kept]
    mean = forest.featureImportances.toArray()
    spread = np.std([t.featureImportances.toArray() for t in forest.trees], axis=0)
    order = sorted(range(len(names)), key=lambda i: (-mean[i], names[i]))
    rows = [(place + 1, names[i], float(mean[i]), float(spread[i])) for place, i in enumerate(order)]
    return spark.createDataFrame(rows, "rank int, feature string, importance double, sd double")
