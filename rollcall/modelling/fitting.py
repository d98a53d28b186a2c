"""Training: pipeline, grid from configuration, cross-validated search."""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, StringIndexer, StringIndexerModel, VarianceThresholdSelector, VectorAssembler
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame, functions as F
from pyspark.storagelevel import StorageLevel

from rollcall import DEFAULT_KEY
from rollcall.modelling.encoder import DummyEncoder, DummyModel
from rollcall.modelling.evaluator import MacroAUC
from rollcall.modelling.split import categorical_columns, fold_column
from rollcall.modelling.stages import GapFiller, VarianceFilter
from rollcall.operators.columns import columns_of, empty_columns

# Option names of grid files and what they set here.
IMPUTE = {"mean": "mean", "median": "median", "most_frequent": "mode"}
MAX_DEPTH = 30  # the deepest tree Spark grows
LEVELS = "levels__"  # the vector column of the encoder

DEFAULT_GRID = {
    "imputer": {"strategy": ["mean"]},
    "variancethreshold": {"threshold": [0.0]},
    "randomforestclassifier": {"n_estimators": [10], "max_depth": [5]},
}


@dataclass
class Forest:
    """The stages of one training pipeline and the columns they work on."""

    pipeline: Pipeline
    imputer: Imputer | None
    selector: VarianceThresholdSelector
    classifier: RandomForestClassifier


def forest_pipeline(
    train: DataFrame, label: str, categorical: Sequence[str], numeric: Sequence[str], seed: int = 1100
) -> Forest:
    """Label index, dummies, imputation, variance filter and forest as one unfitted pipeline of Spark's own stages.

    The encoder is a stage like the others, so it is fitted with them; its state travels in the pipeline model.
    """
    encoder = DummyEncoder(list(categorical), LEVELS)
    indexer = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(train)
    imputer = None
    stages: list = [indexer, encoder]
    names = list(numeric)
    if numeric:
        imputer = Imputer(inputCols=list(numeric), outputCols=[f"{c}__known" for c in numeric])
        stages.append(imputer)
        names = [f"{c}__known" for c in numeric]
    assembler = VectorAssembler(inputCols=[*names, LEVELS], outputCol="all_features")
    selector = VarianceThresholdSelector(featuresCol="all_features", outputCol="features")
    classifier = RandomForestClassifier(labelCol="label", featuresCol="features", seed=seed)
    return Forest(Pipeline(stages=[*stages, assembler, selector, classifier]), imputer, selector, classifier)


@dataclass(frozen=True)
class Point:
    """One point of the grid: how gaps are filled, what varies enough, and the forest's parameters."""

    strategy: str = "mean"
    threshold: float = 0.0
    forest: tuple[tuple[str, object], ...] = ()


def grid_points(options: Mapping[str, Mapping[str, Sequence]]) -> list[Point]:
    """The points of grid options ``{step: {option: values}}``; unknown steps are ignored, unknown options are an error.

    Thresholds refer to the population variance. ``min_samples_split`` m becomes at least ceil(m / 2) rows per node, and
    depth is capped with a warning. Points that mean the same are one.
    """
    known = {"imputer": {"strategy"}, "variancethreshold": {"threshold"}}
    known["randomforestclassifier"] = {"n_estimators", "max_depth", "max_features", "min_samples_split"}
    unknown = [f"{step}.{o}" for step, given in options.items() if step in known for o in given if o not in known[step]]
    if unknown:
        raise ValueError(f"no such grid options: {', '.join(unknown)}")
    strategies = [IMPUTE[v] for v in options.get("imputer", {}).get("strategy", ["mean"])]
    thresholds = [float(v) for v in options.get("variancethreshold", {}).get("threshold", [0.0])]
    growing = options.get("randomforestclassifier", {})
    axes: list[list[tuple[str, object]]] = []

    def axis(param: str, values) -> None:
        axes.append([(param, v) for v in dict.fromkeys(values)])

    if "n_estimators" in growing:
        axis("numTrees", [int(v) for v in growing["n_estimators"]])
    if "max_depth" in growing:
        depths = [MAX_DEPTH if v is None else int(v) for v in growing["max_depth"]]  # None: as deep as Spark goes
        if max(depths) > MAX_DEPTH:
            warnings.warn(f"depths above {MAX_DEPTH} are grown to {MAX_DEPTH}", stacklevel=3)
        axis("maxDepth", [min(v, MAX_DEPTH) for v in depths])
    if "max_features" in growing:
        axis("featureSubsetStrategy", [str(v) for v in growing["max_features"]])
    if "min_samples_split" in growing:
        axis("minInstancesPerNode", [math.ceil(int(v) / 2) for v in growing["min_samples_split"]])
    return [Point(*front, tuple(forest)) for front in product(dict.fromkeys(strategies), dict.fromkeys(thresholds)) for forest in product(*axes)]


def build_grid(forest: Forest, options: Mapping[str, Mapping[str, Sequence]], n_rows: int) -> list[dict]:
    """:func:`grid_points` as parameter maps of one pipeline, thresholds rescaled to the sample variance of ``n_rows`` rows."""
    scale = n_rows / (n_rows - 1) if n_rows > 1 else 1.0
    maps = []
    for point in grid_points(options):
        one = {getattr(forest.classifier, name): value for name, value in point.forest}
        if forest.imputer is not None and "strategy" in options.get("imputer", {}):
            one[forest.imputer.strategy] = point.strategy
        if "threshold" in options.get("variancethreshold", {}):
            one[forest.selector.varianceThreshold] = point.threshold * scale
        if one not in maps:
            maps.append(one)
    return maps


def feature_columns(
    df: DataFrame, label: str, key: Sequence[str], skip: Sequence[str] = ()
) -> tuple[list[str], list[str]]:
    """Categorical and numeric feature columns of a training matrix; all-NULL columns are left out (jobs)."""
    leave_out = {label, *key, *skip, *empty_columns(df)}
    categorical = categorical_columns(df, exclude=list(leave_out))
    numeric = [c for c in columns_of(df, "number") if c not in leave_out and c not in categorical]
    return categorical, numeric


# Training rows per cached partition: at most the first, and for small tables about the second.
ROWS_PER_TASK, FEWEST_ROWS_PER_TASK = 100_000, 1_000


def training_rows(train: DataFrame, label: str, key: Sequence[str], folds: int, seed: int) -> tuple[DataFrame, int]:
    """Labelled rows with their fold, spread evenly by key, and their number (one job that reads the label only).

    The rows are read many times during training, so the partitions follow their number: enough for every core,
    and never more than a task's worth in one.
    """
    known = train.dropna(subset=[label])
    n = known.select(label).count()
    cores = train.sparkSession.sparkContext.defaultParallelism
    tasks = max(math.ceil(n / ROWS_PER_TASK), min(cores, math.ceil(n / FEWEST_ROWS_PER_TASK)), 1)
    return known.withColumn("fold__", fold_column(key, folds, seed)).repartition(tasks, *key), n


@dataclass(frozen=True)
class Columns:
    """What a forest learns from."""

    label: str
    categorical: tuple[str, ...]
    numeric: tuple[str, ...]
    seed: int


def _encoder(columns: Columns) -> DummyEncoder:
    return DummyEncoder(list(columns.categorical), LEVELS)


def _assembler(columns: Columns) -> VectorAssembler:
    return VectorAssembler(inputCols=[*[f"{c}__known" for c in columns.numeric], LEVELS], outputCol="all_features")


def _classifier(point: Point, columns: Columns) -> RandomForestClassifier:
    return RandomForestClassifier(labelCol="label", featuresCol="features", seed=columns.seed, **dict(point.forest))


def fit_point(rows: DataFrame, columns: Columns, point: Point, index: StringIndexerModel) -> PipelineModel:
    """All stages of one point, fitted on ``rows`` (with their label index)."""
    stages = [index, _encoder(columns), GapFiller(columns.numeric, point.strategy), _assembler(columns)]
    return Pipeline(stages=[*stages, VarianceFilter(point.threshold), _classifier(point, columns)]).fit(rows)


def _branches(points: Sequence[Point], part) -> dict:
    """Points by what a stage needs to know of them, in the order of the grid."""
    out: dict = {}
    for p in points:
        out.setdefault(part(p), []).append(p)
    return out


def _kept(pair: tuple[DataFrame, DataFrame]) -> tuple[DataFrame, DataFrame]:
    return tuple(df.persist(StorageLevel.MEMORY_AND_DISK) for df in pair)


def _freed(pair: tuple[DataFrame, DataFrame]) -> None:
    for df in pair:
        df.unpersist()


def search(
    rows: DataFrame, columns: Columns, points: Sequence[Point], index: StringIndexerModel, folds: int, parallelism: int, fold: str = "fold__"
) -> dict[Point, list[float]]:
    """AUC of each point on each fold, as a tree of stages.

    Points that agree on the first stages share them: in a fold the encoder is fitted once, gaps are filled once per
    strategy, the variance filter is fitted once per strategy and threshold, and only forests are fitted per point, on
    vectors that are kept meanwhile. Every stage learns from the fold's training rows alone.
    """
    judge = MacroAUC(classes=len(index.labels))
    indexed = index.transform(rows)
    scores: dict[Point, list[float]] = {p: [] for p in points}

    def both(stage, pair, *names):
        return tuple(stage.transform(df).select(*names) for df in pair)

    with ThreadPool(parallelism) as pool:
        for k in range(folds):
            parts = (indexed.filter(F.col(fold) != k), indexed.filter(F.col(fold) == k))
            encoder = _encoder(columns).fit(parts[0])
            coded = _kept(both(encoder, parts, "label", LEVELS, *[F.col(f"`{c}`") for c in columns.numeric]))
            for strategy, of_strategy in _branches(points, lambda p: p.strategy).items():
                filler = GapFiller(columns.numeric, strategy).fit(coded[0])
                assembler = _assembler(columns)
                vectors = _kept(tuple(assembler.transform(filler.transform(df)).select("label", "all_features") for df in coded))
                for threshold, of_threshold in _branches(of_strategy, lambda p: p.threshold).items():
                    chosen = _kept(both(VarianceFilter(threshold).fit(vectors[0]), vectors, "label", "features"))

                    def judged(point: Point, chosen=chosen) -> float:
                        return judge.evaluate(_classifier(point, columns).fit(chosen[0]).transform(chosen[1]))

                    for point, auc in zip(of_threshold, pool.map(judged, of_threshold)):
                        scores[point].append(auc)
                    _freed(chosen)
                _freed(vectors)
            _freed(coded)
    return scores


def fit_forest(
    train: DataFrame,
    label: str = "outcome",
    key: Sequence[str] = DEFAULT_KEY,
    grid: Mapping[str, Mapping[str, Sequence]] = DEFAULT_GRID,
    folds: int = 5,
    parallelism: int = 2,
    skip: Sequence[str] = (),
    seed: int = 1100,
) -> CrossValidatorModel | PipelineModel:
    """Search the grid by cross-validated AUC and refit the best point (the first of several) on all training rows.

    A grid of one point needs no search and is fitted directly. Rows without a label are left out.
    """
    points = grid_points(grid)
    known = training_rows(train, label, key, folds, seed)[0].persist()
    try:
        categorical, numeric = feature_columns(known, label, key, [*skip, "fold__"])
        columns = Columns(label, tuple(categorical), tuple(numeric), seed)
        index = StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc").fit(known)
        if len(points) == 1:
            return fit_point(known, columns, points[0], index)
        scores = search(known, columns, points, index, folds, parallelism)
        means = [float(np.mean(scores[p])) for p in points]
        best = fit_point(known, columns, points[int(np.argmax(means))], index)
        return CrossValidatorModel(best, avgMetrics=means, stdMetrics=[float(np.std(scores[p])) for p in points])
    finally:
        known.unpersist()


def best_pipeline(model: CrossValidatorModel | PipelineModel) -> PipelineModel:
    return model.bestModel if isinstance(model, CrossValidatorModel) else model


def stage_of(model: CrossValidatorModel | PipelineModel, kind: type):
    """The last stage of a type."""
    found = [s for s in best_pipeline(model).stages if isinstance(s, kind)]
    if not found:
        raise LookupError(f"no {kind.__name__} in the pipeline")
    return found[-1]


def stage_names(model: CrossValidatorModel | PipelineModel) -> list[str]:
    return [type(s).__name__ for s in best_pipeline(model).stages]


def label_index(stages: Sequence) -> StringIndexerModel:
    return next(s for s in stages if isinstance(s, StringIndexerModel))


def encoded_columns(model: CrossValidatorModel | PipelineModel) -> list[str]:
    """Names of the assembled features, before the variance filter."""
    out: list[str] = []
    for name in stage_of(model, VectorAssembler).getInputCols():
        out += encoder_of(model).output_names() if name == LEVELS else [name.removesuffix("__known")]
    return out


def encoder_of(model: CrossValidatorModel | PipelineModel) -> DummyModel:
    return stage_of(model, DummyModel)
