"""Fitted stages between the encoder and the classifier: exact imputation and a filter by population variance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import VarianceThresholdSelector, VarianceThresholdSelectorModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.ordered import add_slots, quantiles

STRATEGIES = ("mean", "median", "mode")


def known_value(column: str) -> Column:
    """The value as a number; NaN counts as missing."""
    return F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))


def typical_values(df: DataFrame, columns: Sequence[str], strategy: str) -> dict[str, float | None]:
    """Mean, exact median or most frequent value (the smallest of several) of each column; None without any value.

    The number of passes does not depend on the number of columns, and no column is ordered in one task.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"no such strategy: {strategy}")
    columns = list(columns)
    if not columns:
        return {}
    numbers = df.select(*[known_value(c).alias(f"v{i}") for i, c in enumerate(columns)])
    if strategy == "mean":
        row = numbers.agg(*[F.avg(c).alias(c) for c in numbers.columns]).first()
        return {c: row[f"v{i}"] for i, c in enumerate(columns)}
    slotted = add_slots(numbers, {f"v{i}": f"s{i}" for i in range(len(columns))}) if strategy == "median" else numbers
    slot = lambda i: F.col(f"s{i}") if strategy == "median" else F.lit(0.0)
    one = [F.struct(F.lit(i).alias("at"), F.col(f"v{i}").alias("value"), slot(i).alias("slot")) for i in range(len(columns))]
    melted = slotted.select(F.inline(F.array(*one))).filter(F.col("value").isNotNull())
    if strategy == "median":
        found = quantiles(melted, "value", {"value": 0.5}, ["at"], slot="slot")
    else:
        counts = melted.groupBy("at", "value").agg(F.count(F.lit(1)).alias("n"))
        found = counts.groupBy("at").agg(F.max(F.struct("n", (-F.col("value")).alias("low"))).alias("top")).select("at", (-F.col("top.low")).alias("value"))
    values = {r["at"]: r["value"] for r in found.collect()}  # one row for each column
    return {c: values.get(i) for i, c in enumerate(columns)}


class GapFiller(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Learn each column's typical value; the model adds ``<column>__known`` with gaps filled.

    A column without any value gets 0, so a fold that lacks it has a constant column, which the variance filter drops.
    """

    inputCols = Param(Params._dummy(), "inputCols", "number columns", TypeConverters.toListString)
    strategy = Param(Params._dummy(), "strategy", "mean, median or mode", TypeConverters.toString)

    def __init__(self, columns: Sequence[str] = (), strategy: str = "mean"):
        super().__init__()
        self._setDefault(inputCols=[], strategy="mean")
        self._set(inputCols=list(columns), strategy=strategy)

    def _fit(self, dataset: DataFrame) -> "FilledGaps":
        found = typical_values(dataset, self.getOrDefault(self.inputCols), self.getOrDefault(self.strategy))
        return FilledGaps({c: 0.0 if v is None else float(v) for c, v in found.items()})


class FilledGaps(Model, DefaultParamsReadable, DefaultParamsWritable):
    values = Param(Params._dummy(), "values", "value for gaps per column")

    def __init__(self, values: dict[str, float] | None = None):
        super().__init__()
        self._setDefault(values={})
        if values is not None:
            self._set(values=values)

    def known(self) -> dict[str, float]:
        return self.getOrDefault(self.values)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        filled = {f"{c}__known": F.coalesce(known_value(c), F.lit(float(v))) for c, v in self.known().items()}
        return dataset.withColumns(filled) if filled else dataset


class VarianceFilter(Estimator):
    """Keep the features whose population variance in the fitted rows is above the threshold."""

    threshold = Param(Params._dummy(), "threshold", "population variance that is not enough", TypeConverters.toFloat)

    def __init__(self, threshold: float = 0.0, features: str = "all_features", output: str = "features"):
        super().__init__()
        self._setDefault(threshold=0.0)
        self._set(threshold=float(threshold))
        self.features, self.output = features, output

    def _fit(self, dataset: DataFrame) -> VarianceThresholdSelectorModel:
        n = dataset.count()
        # Spark's selector compares sample variances
        scale = n / (n - 1) if n > 1 else 1.0
        selector = VarianceThresholdSelector(
            featuresCol=self.features, outputCol=self.output, varianceThreshold=self.getOrDefault(self.threshold) * scale
        )
        model = selector.fit(dataset)
        if not len(model.selectedFeatures):
            raise ValueError(f"no feature has a variance above {self.getOrDefault(self.threshold)}")
        return model
