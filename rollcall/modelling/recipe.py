"""A lasso with its own preparation: near-constant columns, imputation, scaling, rare levels, dummies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Imputer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, Window, functions as F

from rollcall import DEFAULT_KEY
from rollcall.modelling.encoder import DummyEncoder, RarePooler
from rollcall.modelling.evaluator import MacroAUC
from rollcall.modelling.fitting import LEVELS, feature_columns, training_rows
from rollcall.operators.profile import category_counts


def near_constant_columns(
    df: DataFrame, columns: Sequence[str], ratio: float = 95 / 5, unique_percent: float = 10.0
) -> list[str]:
    """Columns of one value, or with a dominant value and few distinct ones (one job).

    Dominant: the most frequent value occurs more than ``ratio`` times as often as the next. Few: distinct
    values are less than ``unique_percent`` of the rows. NULL is left out.
    """
    if not columns:
        return []
    counts = category_counts(df, columns=list(columns)).filter(F.col("value").isNotNull())
    # row_number <= 2 is applied before the shuffle, so no column's values gather in one task
    top = (
        counts.withColumn("place", F.row_number().over(Window.partitionBy("variable").orderBy(F.desc("n"), "value")))
        .filter(F.col("place") <= 2)
        .groupBy("variable")
        .agg(F.max("n").alias("most"), F.max(F.when(F.col("place") == 2, F.col("n"))).alias("next"))
    )
    sizes = counts.groupBy("variable").agg(F.count(F.lit(1)).alias("n_values"), F.sum("n").alias("n_known"))
    constant = F.col("next").isNull()
    dominant = F.col("most") > ratio * F.col("next")
    few = F.col("n_values") * 100.0 / F.col("n_known") < unique_percent
    found = {r[0] for r in top.join(sizes, "variable").filter(constant | (dominant & few)).select("variable").collect()}
    return [c for c in columns if c in found]


def lasso_pipeline(
    train: DataFrame,
    label: str,
    categorical: Sequence[str],
    numeric: Sequence[str],
    unscaled: Sequence[str] = (),
    rare: float = 0.05,
    max_iter: int = 50,
) -> tuple[Pipeline, LogisticRegression]:
    """Stages fitted on the training rows only, but for the label index. ``unscaled`` columns are imputed but keep their scale."""
    known = {c: f"{c}__known" for c in numeric}
    stages = [
        StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(train),
        RarePooler(list(categorical), rare),
        DummyEncoder(list(categorical), LEVELS),
    ]
    inputs = [LEVELS]
    if numeric:
        stages.append(Imputer(strategy="mean", inputCols=list(known), outputCols=list(known.values())))
        scaled = [known[c] for c in numeric if c not in unscaled]
        inputs = [known[c] for c in numeric if c in unscaled] + inputs
        if scaled:
            stages.append(VectorAssembler(inputCols=scaled, outputCol="to_scale"))
            stages.append(StandardScaler(inputCol="to_scale", outputCol="scaled", withMean=True, withStd=True))
            inputs = ["scaled", *inputs]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features"))
    lasso = LogisticRegression(
        labelCol="label", featuresCol="features", elasticNetParam=1.0, family="binomial", maxIter=max_iter
    )
    return Pipeline(stages=[*stages, lasso]), lasso


def fit_lasso(
    train: DataFrame,
    label: str = "outcome",
    key: Sequence[str] = DEFAULT_KEY,
    penalties: Sequence[float] = (0.1, 0.01, 0.001),
    unscaled: Sequence[str] = (),
    folds: int = 5,
    parallelism: int = 2,
    max_iter: int = 50,
    seed: int = 1100,
) -> CrossValidatorModel | PipelineModel:
    """L1 logistic regression of a two-class label with the penalty chosen by cross-validated AUC."""
    rows = training_rows(train, label, key, folds, seed)[0].persist()
    try:
        categorical, numeric = feature_columns(rows, label, key, ["fold__"])
        dull = set(near_constant_columns(rows, [*categorical, *numeric]))
        categorical = [c for c in categorical if c not in dull]
        numeric = [c for c in numeric if c not in dull]
        pipeline, lasso = lasso_pipeline(rows, label, categorical, numeric, unscaled, max_iter=max_iter)
        grid = ParamGridBuilder().addGrid(lasso.regParam, list(penalties)).build()
        if len(grid) == 1:
            return pipeline.fit(rows, grid[0])
        search = CrossValidator(
            estimator=pipeline,
            estimatorParamMaps=grid,
            evaluator=MacroAUC(),
            numFolds=folds,
            foldCol="fold__",
            parallelism=parallelism,
            seed=seed,
        )
        return search.fit(rows)
    finally:
        rows.unpersist()
