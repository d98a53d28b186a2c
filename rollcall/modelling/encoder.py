"""Pipeline stages with fitted state: dummy columns and pooling of rare levels."""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators.profile import category_counts

MISSING = "nan"
#: Labels of the index: NULL, and what comes before the text of a level, as a label cannot be empty.
NO_LEVEL, LEVEL = "none", "="


def level_text(df: DataFrame, column: str) -> Column:
    """A value as level text; whole numbers without a decimal point."""
    text = F.col(f"`{column}`").cast("string")
    is_float = dict(df.dtypes)[column] in ("double", "float")
    return F.regexp_replace(text, "\\.0$", "") if is_float else text


def level_counts(df: DataFrame, columns: list[str], max_levels: int) -> dict[str, dict[str, int]]:
    """Levels and their counts per column (two jobs); fails when a column has too many to be a category."""
    texts = df.select(*[level_text(df, c).alias(c) for c in columns])
    counts = category_counts(texts, columns=columns).filter(F.col("value").isNotNull())
    sizes = counts.groupBy("variable").agg(F.count(F.lit(1)).alias("n_levels"))
    for row in sizes.filter(F.col("n_levels") > max_levels).collect():
        raise ValueError(f"{row['variable']} has {row['n_levels']} levels, more than {max_levels}")
    out: dict[str, dict[str, int]] = {c: {} for c in columns}
    for row in counts.collect():  # at most max_levels rows per column
        out[row["variable"]][row["value"]] = row["n"]
    return {c: dict(sorted(levels.items())) for c, levels in out.items()}


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "categorical columns", TypeConverters.toListString)
    maxLevels = Param(Params._dummy(), "maxLevels", "most levels a column may have", TypeConverters.toInt)

    def _start(self, columns, max_levels=1_000_000):
        self._setDefault(inputCols=[], maxLevels=max_levels)
        if columns is not None:
            self._set(inputCols=list(columns))


class _Levels(Params):
    levels = Param(Params._dummy(), "levels", "known levels per column")

    def known(self) -> dict[str, list[str]]:
        return self.getOrDefault(self.levels)


class DummyEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learn the levels of categorical columns.

    The model gives one 0/1 value per level and one for missing values, no level left out. A level that was
    not seen at fit time is zero in all of them. With ``output`` they are one sparse vector, whose metadata holds
    their names, so a row costs as much as it has categorical columns, whatever the number of levels; without, each
    is a column.
    """

    outputCol = Param(Params._dummy(), "outputCol", "vector column, or empty for one column per level", TypeConverters.toString)

    def __init__(self, columns: list[str] | None = None, output: str = ""):
        super().__init__()
        self._setDefault(outputCol="")
        self._start(columns)
        self._set(outputCol=output)

    def _fit(self, dataset: DataFrame) -> "DummyModel":
        columns = self.getOrDefault(self.inputCols)
        levels = level_counts(dataset, columns, self.getOrDefault(self.maxLevels)) if columns else {}
        return DummyModel({c: list(found) for c, found in levels.items()}, self.getOrDefault(self.outputCol))


class DummyModel(Model, _Levels, DefaultParamsReadable, DefaultParamsWritable):
    outputCol = Param(Params._dummy(), "outputCol", "vector column, or empty for one column per level", TypeConverters.toString)

    def __init__(self, levels: dict[str, list[str]] | None = None, output: str = ""):
        super().__init__()
        self._setDefault(levels={}, outputCol="")
        if levels is not None:
            self._set(levels=levels, outputCol=output)

    def dummies(self) -> list[tuple[str, str | None, str]]:
        """Rows ``(column, level or None for missing, output name)`` in output order."""
        out = []
        for c, found in self.known().items():
            for level in [*found, None]:
                out.append((c, level, f"{c}_{MISSING if level is None else level}".replace(".", "_")))
        names = [name for _, _, name in out]
        if len(set(names)) < len(names):
            raise ValueError("two levels give the same column name")
        return out

    def output_names(self) -> list[str]:
        return [name for _, _, name in self.dummies()]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        output = self.getOrDefault(self.outputCol)
        return self._with_vector(dataset, output) if output else self._with_columns(dataset)

    def _with_vector(self, dataset: DataFrame, output: str) -> DataFrame:
        """A level index per column, then one sparse vector per row."""
        known, names = self.known(), self.output_names()
        attributes = {"attrs": {"binary": [{"idx": i, "name": n} for i, n in enumerate(names)]}, "num_attrs": len(names)}
        if not known:
            return dataset.withColumn(output, array_to_vector(F.array().cast("array<double>")))
        texts, places, hits = ([f"{c}__{kind}" for c in known] for kind in ("level", "place", "hit"))
        placed = dataset.withColumns({t: F.coalesce(F.concat(F.lit(LEVEL), level_text(dataset, c)), F.lit(NO_LEVEL)) for t, c in zip(texts, known)})
        # unseen levels come after the last place, which the one-hot encoder leaves out; both work without a job here.
        # One index per column: arrays of labels of unequal length do not reach the JVM as they are
        for found, text, place in zip(known.values(), texts, places):
            labels = [*[LEVEL + level for level in found], NO_LEVEL]
            placed = StringIndexerModel.from_labels(labels, inputCol=text, outputCol=place, handleInvalid="keep").transform(placed)
        encoded = OneHotEncoder(inputCols=places, outputCols=hits, dropLast=True).fit(placed).transform(placed)
        joined = VectorAssembler(inputCols=hits, outputCol=output).transform(encoded)
        return joined.select(*[F.col(f"`{c}`") for c in dataset.columns if c != output], F.col(output).alias(output, metadata={"ml_attr": attributes}))

    def _with_columns(self, dataset: DataFrame) -> DataFrame:
        columns = []
        for c, level, name in self.dummies():
            text = level_text(dataset, c)
            hit = text.isNull() if level is None else F.coalesce(text == level, F.lit(False))
            columns.append(hit.cast("double").alias(name))
        known = self.known()
        return dataset.select(*[F.col(f"`{c}`") for c in dataset.columns if c not in known], *columns)


class RarePooler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learn which levels are frequent; the model replaces all others by ``other``. NULL stays."""

    threshold = Param(Params._dummy(), "threshold", "smallest share of a level that is kept", TypeConverters.toFloat)

    def __init__(self, columns: list[str] | None = None, threshold: float = 0.05):
        super().__init__()
        self._setDefault(threshold=0.05)
        self._start(columns)
        self._set(threshold=threshold)

    def _fit(self, dataset: DataFrame) -> "PooledLevels":
        columns, least = self.getOrDefault(self.inputCols), self.getOrDefault(self.threshold)
        counts = level_counts(dataset, columns, self.getOrDefault(self.maxLevels)) if columns else {}
        kept = {}
        for c, levels in counts.items():
            total = sum(levels.values())
            kept[c] = [v for v, n in levels.items() if n >= least * total]
        return PooledLevels(kept)


class PooledLevels(Model, _Levels, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, levels: dict[str, list[str]] | None = None):
        super().__init__()
        self._setDefault(levels={})
        if levels is not None:
            self._set(levels=levels)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        pooled = {}
        for c, kept in self.known().items():
            text = level_text(dataset, c)
            pooled[c] = F.when(text.isin(kept), text).when(text.isNotNull(), F.lit("other"))
        return dataset.withColumns(pooled) if pooled else dataset
