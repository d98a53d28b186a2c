"""L1 logistic regression along a path of penalties, with cross-validation in the same passes.

The path starts at the data's largest penalty, at which all coefficients are zero, and falls by a constant factor; each
penalty starts from the solution before it. All folds and the model of all rows are solved side by side: one pass over
the rows gives every model its gradient and its curvature on the columns that are in play, as sums that tasks add up
before they send them. The driver solves the small penalised quadratic problems by coordinate descent. Columns are
screened by the strong rule and the conditions of optimality are checked on all columns, so none is left out wrongly.

Columns are scaled to unit variance for the penalty; coefficients are returned on the scale of the features.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.modelling.encoder import DummyModel
from rollcall.modelling.evaluation import auc
from rollcall.modelling.fitting import feature_columns, label_index, training_rows
from rollcall.modelling.recipe import lasso_pipeline, near_constant_columns

PENALTIES, LOWEST = 40, 0.01
MOST_ROUNDS, ENOUGH = 25, 1e-7


@dataclass(frozen=True)
class LassoPath:
    """``coefficients`` has a row per penalty and model: the folds, then all rows (the last). ``auc`` has one per penalty and fold."""

    names: tuple[str, ...]
    penalties: np.ndarray
    intercepts: np.ndarray
    coefficients: np.ndarray
    scales: np.ndarray
    auc: np.ndarray

    @property
    def best(self) -> int:
        """Place of the penalty with the largest mean AUC, the largest of several."""
        return int(np.argmax(np.nanmean(self.auc, 1))) if self.auc.size else len(self.penalties) - 1

    @property
    def one_standard_error(self) -> int:
        """Place of the largest penalty whose mean AUC is within one standard error of the best."""
        if not self.auc.size:
            return self.best
        mean = np.nanmean(self.auc, 1)
        error = np.nanstd(self.auc[self.best], ddof=1) / np.sqrt(np.isfinite(self.auc[self.best]).sum())
        return int(np.flatnonzero(mean >= mean[self.best] - error)[0])

    def entries(self) -> list[tuple[int, str, int, float]]:
        """Place, feature, sign and penalty in the order in which features enter the model of all rows.

        Features that enter together are ordered by the size of their scaled coefficient.
        """
        path = self.coefficients[:, -1] * self.scales
        out = []
        for j in range(path.shape[1]):
            hit = np.flatnonzero(path[:, j])
            if len(hit):
                out.append((int(hit[0]), -abs(path[hit[0], j]), self.names[j], int(np.sign(path[hit[0], j]))))
        return [(place, name, sign, float(self.penalties[at])) for place, (at, _, name, sign) in enumerate(sorted(out), 1)]


def _solved(gradient: np.ndarray, curvature: np.ndarray, at: np.ndarray, penalty: np.ndarray) -> np.ndarray:
    """Coordinate descent on a quadratic around ``at`` with an L1 penalty per coordinate (0 for the intercept, which is the first)."""
    x, slope = at.copy(), gradient.copy()  # slope of the log-likelihood at x
    for _ in range(1000):
        most = 0.0
        for j in range(len(x)):
            if curvature[j, j] <= 0:
                continue
            u = slope[j] + curvature[j, j] * x[j]
            new = np.sign(u) * max(abs(u) - penalty[j], 0.0) / curvature[j, j]
            if new != x[j]:
                slope -= curvature[:, j] * (new - x[j])
                most = max(most, abs(new - x[j]))
                x[j] = new
        if most < ENOUGH / 10:
            break
    return x


def _sums(rows: DataFrame, beta: np.ndarray, active: np.ndarray, mean: np.ndarray, scale: np.ndarray, folds: int) -> dict[int, np.ndarray]:
    """Per model: rows, gradient (intercept first) and the upper triangle of the curvature on ``active`` (intercept first)."""
    upper = np.triu_indices(len(active) + 1)

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((folds + 1, 1 + 1 + len(mean) + len(upper[0])))
        for b in batches:
            if not len(b):
                continue
            x = (np.stack(b.x.to_list()) - mean) / scale
            y, fold = b.y.to_numpy(float), b.fold.to_numpy()
            for m in range(folds + 1):
                mine = fold != m  # the last model's number is no fold
                own, target = x[mine], y[mine]
                p = 1 / (1 + np.exp(-(beta[m, 0] + own @ beta[m, 1:])))
                w = np.maximum(p * (1 - p), 1e-5)
                r = target - p
                seen = np.column_stack([np.ones(len(own)), own[:, active]])
                square = (seen * w[:, None]).T @ seen
                total[m] += np.concatenate([[len(own), r.sum()], r @ own, square[upper]])
        yield pd.DataFrame({"model": range(folds + 1), "sums": list(total)})

    parts = rows.mapInPandas(summed, "model int, sums array<double>")
    found = parts.groupBy("model").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums")).collect()
    return {r["model"]: np.array(r["sums"]) for r in found}


def solve_path(rows: DataFrame, names: Sequence[str], folds: int, penalties: int = PENALTIES, lowest: float = LOWEST) -> LassoPath:
    """The path for rows ``(x array<double>, y 0/1, fold)``; AUC is left empty.

    Features that do not vary keep the coefficient 0. Every pass is one job whose result has the size of the model.
    """
    stats = rows.select(array_to_vector("x").alias("v"), "y").agg(Summarizer.metrics("mean", "variance", "count").summary(F.col("v")).alias("s"), F.avg("y").alias("y")).first()
    n, mean = stats["s"]["count"], stats["s"]["mean"].toArray()
    sd = np.sqrt(stats["s"]["variance"].toArray() * (n - 1) / max(n, 1))
    varies = sd > 1e-12 * np.maximum(1, np.abs(mean))
    scale, k = np.where(varies, sd, 1.0), len(mean)
    share = min(max(stats["y"], 1e-9), 1 - 1e-9)
    beta = np.zeros((folds + 1, k + 1))
    beta[:, 0] = np.log(share / (1 - share))
    sums = _sums(rows, beta, np.zeros(0, int), mean, scale, folds)
    gradient = np.stack([sums[m][2 : 2 + k] / max(sums[m][0], 1) for m in range(folds + 1)]) * varies
    largest = np.abs(gradient[-1]).max() if k else 0.0
    levels = largest * np.geomspace(1, lowest, penalties) if largest > 0 else np.zeros(1)
    path, before = [], largest
    for level in levels:
        # the strong rule: a column that is far from entering is left out until the check finds it
        inside = (np.abs(gradient) >= 2 * level - before).any(0) | (beta[:, 1:] != 0).any(0)
        for _ in range(MOST_ROUNDS):
            active = np.flatnonzero(inside & varies)
            sums = _sums(rows, beta, active, mean, scale, folds)
            upper, moved = np.triu_indices(len(active) + 1), 0.0
            for m in range(folds + 1):
                size = max(sums[m][0], 1)
                gradient[m] = sums[m][2 : 2 + k] / size * varies
                square = np.zeros((len(active) + 1,) * 2)
                square[upper] = sums[m][2 + k :] / size
                square = square + np.triu(square, 1).T
                seen = np.concatenate([[0], active + 1])
                slope = np.concatenate([[sums[m][1] / size], gradient[m][active]])
                new = _solved(slope, square, beta[m, seen], np.concatenate([[0.0], np.full(len(active), level)]))
                moved = max(moved, np.abs(new - beta[m, seen]).max())
                beta[m, seen] = new
            # the gradients are those before the step; once nothing moves they are those of the solution
            missing = (np.abs(gradient) > level * (1 + 1e-6)).any(0) & varies & ~inside
            if moved < ENOUGH and not missing.any():
                break
            inside |= missing
        before = level
        path.append(beta.copy())
    found = np.stack(path)
    coefficients = found[:, :, 1:] / scale
    intercepts = found[:, :, 0] - (coefficients * mean).sum(2)
    return LassoPath(tuple(names), levels, intercepts, coefficients, scale, np.zeros((0, folds)))


def linear(x: Column, intercept: float, coefficients: np.ndarray) -> Column:
    """Intercept plus the products with an array column."""
    known = F.array(*[F.lit(float(c)) for c in coefficients])
    return F.aggregate(F.zip_with(x, known, lambda a, b: a * b), F.lit(float(intercept)), lambda total, one: total + one)


def fold_aucs(rows: DataFrame, path: LassoPath, folds: int) -> np.ndarray:
    """AUC of each penalty on each fold, by the model that has not seen the fold; NaN where a fold lacks a class."""
    scored = []
    for at in range(len(path.penalties)):
        score = F.lit(None).cast("double")
        for m in range(folds):
            score = F.when(F.col("fold") == m, linear(F.col("x"), path.intercepts[at, m], path.coefficients[at, m])).otherwise(score)
        scored.append(F.struct(F.lit(at).alias("at"), score.alias("score")))
    melted = rows.select("fold", "y", F.inline(F.array(*scored)))
    found = auc(melted, "y", "score", ["at", "fold"]).collect()  # one row for each penalty and fold
    out = np.full((len(path.penalties), folds), np.nan)
    for r in found:
        out[r["at"], r["fold"]] = np.nan if r["auc"] is None else r["auc"]
    return out


@dataclass(frozen=True)
class FittedLasso:
    """The preparation and the path; ``score`` gives the probability of the second label."""

    preparation: PipelineModel
    path: LassoPath

    def score(self, df: DataFrame, key: Sequence[str] = DEFAULT_KEY, at: int | None = None, keep: Sequence[str] = ()) -> DataFrame:
        at = self.path.best if at is None else at
        z = linear(vector_to_array("features"), self.path.intercepts[at, -1], self.path.coefficients[at, -1])
        name = f"predicted_{label_index(self.preparation.stages).labels[1]}"
        return self.preparation.transform(df).select(*key, *keep, (1 / (1 + F.exp(-z))).alias(name))


def fit_lasso_path(
    train: DataFrame,
    label: str = "outcome",
    key: Sequence[str] = DEFAULT_KEY,
    unscaled: Sequence[str] = (),
    folds: int = 5,
    penalties: int = PENALTIES,
    lowest: float = LOWEST,
    seed: int = 1100,
) -> FittedLasso:
    """Preparation fitted on the training rows (near-constant columns, imputation, scaling, rare levels, dummies), then the path with its AUCs."""
    rows = training_rows(train, label, key, folds, seed)[0].persist()
    try:
        categorical, numeric = feature_columns(rows, label, key, ["fold__"])
        dull = set(near_constant_columns(rows, [*categorical, *numeric]))
        categorical, numeric = ([c for c in columns if c not in dull] for columns in (categorical, numeric))
        pipeline, _ = lasso_pipeline(rows, label, categorical, numeric, unscaled)
        pipeline.setStages(pipeline.getStages()[:-1])
        preparation = pipeline.fit(rows)
        if len(label_index(preparation.stages).labels) != 2:
            raise ValueError("the path needs a label of two classes")
        levels = next(s for s in preparation.stages if isinstance(s, DummyModel))
        names = [*[c for c in numeric if c not in unscaled], *[c for c in numeric if c in unscaled], *levels.output_names()]
        prepared = preparation.transform(rows).select(vector_to_array("features").alias("x"), F.col("label").cast("int").alias("y"), F.col("fold__").alias("fold")).persist()
        try:
            path = solve_path(prepared, names, folds, penalties, lowest)
            aucs = fold_aucs(prepared, path, folds)
        finally:
            prepared.unpersist()
        return FittedLasso(preparation, LassoPath(path.names, path.penalties, path.intercepts, path.coefficients, path.scales, aucs))
    finally:
        rows.unpersist()
