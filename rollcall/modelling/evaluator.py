"""Scorer for model selection."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F


class MacroAUC(Evaluator):
    """Area under the ROC curve; with several classes the mean over classes, each against the rest.

    A class without rows, or without other rows, in the evaluated part is left out of the mean.
    """

    def __init__(self, label: str = "label", probability: str = "probability", classes: int = 2):
        super().__init__()
        self.label, self.probability, self.classes = label, probability, classes

    def _evaluate(self, dataset: DataFrame) -> float:
        label = F.col(self.label)
        chosen = range(self.classes) if self.classes > 2 else [1]
        per_class = dataset.select(label, vector_to_array(self.probability).alias("p"))
        sizes = per_class.agg(
            F.count(F.lit(1)).alias("rows"), *[F.count_if(label == i).alias(f"c{i}") for i in chosen]
        ).first()
        judge = BinaryClassificationEvaluator(
            rawPredictionCol="score", labelCol="hit", metricName="areaUnderROC", numBins=0
        )
        found = [
            judge.evaluate(per_class.select(F.col("p")[i].alias("score"), (label == i).cast("double").alias("hit")))
            for i in chosen
            if 0 < sizes[f"c{i}"] < sizes["rows"]
        ]
        return sum(found) / len(found) if found else 0.5

    def isLargerBetter(self) -> bool:
        return True
