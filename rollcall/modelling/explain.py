"""Local explanations of a classifier's scores, for many rows in one job.

Around every row, samples are drawn: each feature either keeps the row's value or takes a typical other one.
The model scores them, and a ridge regression weighted by closeness says how much keeping each feature's value
moved the score. Rows are spread first; a row's samples then are made, scored and added up in one task, a batch at a
time, so samples are never shuffled or held together: a task keeps the normal equations of one row.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollcall import DEFAULT_KEY
from rollcall.modelling.encoder import level_counts, level_text
from rollcall.modelling.fitting import best_pipeline
from rollcall.modelling.stages import FilledGaps, known_value
from rollcall.operators.ordered import search_text
from rollcall.operators.profile import summaries


@dataclass(frozen=True)
class Background:
    """How features are distributed in the training rows.

    ``cuts`` holds the quartile bounds of a numeric feature and ``centres`` one typical value per quarter;
    ``levels`` holds the level texts of a categorical feature with their cumulative shares.
    """

    cuts: dict[str, list[float]]
    centres: dict[str, list[float]]
    levels: dict[str, list[tuple[str, float]]] = field(default_factory=dict)

    @property
    def features(self) -> list[str]:
        return [*self.cuts, *self.levels]

    @classmethod
    def of(cls, train: DataFrame, numeric: Sequence[str], categorical: Sequence[str], max_levels: int = 1_000_000) -> "Background":
        """Learn it from training rows (jobs); all results are a few numbers per feature and one per level."""
        cuts, centres = {}, {}
        if numeric:
            for row in summaries(train, None, digits=12, columns=list(numeric)).collect():
                marks = [row[c] for c in ("min", "q25", "median", "q75", "max")]
                if row["n"]:
                    cuts[row["variable"]] = marks[1:4]
                    centres[row["variable"]] = [(a + b) / 2 for a, b in zip(marks, marks[1:])]
        levels = {}
        for c, found in level_counts(train, list(categorical), max_levels).items() if categorical else ():
            total, running, shares = sum(found.values()), 0, []
            for level, n in found.items():
                running += n
                shares.append((level, running / total))
            if shares:
                levels[c] = shares
        return cls(cuts, centres, levels)


def fills(model: CrossValidatorModel | PipelineModel) -> dict[str, float]:
    """The values that the model puts into gaps."""
    return {c: v for s in best_pipeline(model).stages if isinstance(s, FilledGaps) for c, v in s.known().items()}


def _uniform(key: Sequence[str], sample: Column, feature: int, seed: int) -> Column:
    mixed = F.xxhash64(F.lit(seed), F.lit(feature), sample, *[F.col(c) for c in key])
    return F.pmod(mixed, F.lit(1 << 30)).cast("double") / float(1 << 30)


def _numeric_sample(df: DataFrame, c: str, draw: Column, b: Background, first: Column) -> tuple[Column, Column]:
    kind = df.schema[c].dataType
    value = known_value(c)
    own = F.when(value <= b.cuts[c][0], 0).when(value <= b.cuts[c][1], 1).when(value <= b.cuts[c][2], 2)
    own = own.when(value.isNotNull(), 3)  # a gap that the model does not fill is in no quarter
    drawn = F.least(F.floor(draw * 4), F.lit(3)).cast("int")
    kept = first | F.coalesce(drawn == own, F.lit(False))
    typical = F.element_at(F.array(*[F.lit(v) for v in b.centres[c]]), drawn + 1)
    typical = F.round(typical) if isinstance(kind, T.IntegralType) else typical
    return kept, F.when(kept, F.col(f"`{c}`")).otherwise(typical.cast(kind))


def drawn_level(draw: str, levels: Sequence[tuple[str, float]]) -> Column:
    """The level at a draw (SQL text of a number from 0 to 1): the first whose cumulative share is above it.

    A binary search in an array, so the expression is as deep for 20,000 levels as for two.
    """
    place = search_text(draw, [f"{upto!r}D" for _, upto in levels[:-1]])
    texts = ", ".join(f"CAST(X'{level.encode().hex()}' AS STRING)" for level, _ in levels)
    return F.expr(f"get(array({texts}), {place})")


def _level_sample(df: DataFrame, c: str, draw: str, b: Background, first: Column) -> tuple[Column, Column]:
    drawn = drawn_level(draw, b.levels[c])
    kept = first | F.coalesce(drawn == level_text(df, c), F.lit(False))
    return kept, F.when(kept, F.col(f"`{c}`")).otherwise(drawn.try_cast(df.schema[c].dataType))


def samples(rows: DataFrame, background: Background, n_samples: int, key: Sequence[str], seed: int, filled: Mapping[str, float]) -> DataFrame:
    """The rows' columns with sampled features, ``row__`` (a number of the row), ``sample__`` and ``kept__`` (which features kept their value).

    Sample 0 is the row itself. Gaps are filled first, as the model does it. A row's samples follow one another.
    """
    names = background.features
    first = F.col("sample__") == 0
    gaps = {c: F.coalesce(known_value(c), F.lit(float(v))).cast(rows.schema[c].dataType) for c, v in filled.items() if c in names}
    rows = rows.withColumns(gaps) if gaps else rows
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = rows.repartition(tasks, *key).withColumn("row__", F.monotonically_increasing_id())
    spread = spread.withColumn("sample__", F.explode(F.sequence(F.lit(0), F.lit(n_samples - 1))))
    spread = spread.withColumns({f"draw__{i}": _uniform(key, F.col("sample__"), i, seed) for i in range(len(names))})
    kept, values = [], {}
    for i, c in enumerate(names):
        if c in background.cuts:
            one, values[c] = _numeric_sample(rows, c, F.col(f"draw__{i}"), background, first)
        else:
            one, values[c] = _level_sample(rows, c, f"draw__{i}", background, first)
        kept.append(one)
    others = [F.col(f"`{c}`") for c in rows.columns if c not in names]
    return spread.select(*others, *[v.alias(c) for c, v in values.items()], "row__", "sample__", F.array(*kept).alias("kept__"))


class Equations:
    """Weighted sums over the samples of one row, added batch by batch."""

    def __init__(self, k: int) -> None:
        self.total, self.y, self.z, self.zy, self.square = 0.0, 0.0, np.zeros(k), np.zeros(k), np.zeros((k, k))

    def add(self, z: np.ndarray, y: np.ndarray, kernel_width: float) -> None:
        w = np.sqrt(np.exp(-(z.shape[1] - z.sum(1)) / kernel_width**2))
        self.total += w.sum()
        self.y += w @ y
        self.z += w @ z
        self.zy += (w * y) @ z
        self.square += (z * w[:, None]).T @ z

    def weights(self, ridge: float) -> np.ndarray:
        mean = self.z / self.total
        square = self.square - self.total * np.outer(mean, mean) + ridge * np.eye(len(mean))
        return np.linalg.solve(square, self.zy - mean * self.y)


def explain(
    model: CrossValidatorModel | PipelineModel,
    rows: DataFrame,
    background: Background,
    class_index: int = 1,
    n_features: int = 5,
    n_samples: int = 5000,
    kernel_width: float = 3.0,
    key: Sequence[str] = DEFAULT_KEY,
    seed: int = 1100,
    ridge: float = 1.0,
) -> DataFrame:
    """Rows ``(key..., place, feature, weight)``: the features with the largest absolute weight first."""
    names = background.features
    sampled = samples(rows, background, n_samples, key, seed, fills(model))
    scored = best_pipeline(model).transform(sampled)
    y = vector_to_array("probability")[class_index]
    scored = scored.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(key)], "row__", "kept__", y.alias("y"))
    keys = [f"k{i}" for i in range(len(key))]
    kinds = ", ".join(f"{k} {rows.schema[c].dataType.simpleString()}" for k, c in zip(keys, key))

    def explained(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, who, sums = None, (), None  # the row whose samples come in

        def closed() -> list[tuple]:
            weights = sums.weights(ridge)
            best = sorted(range(len(names)), key=lambda i: (abs(weights[i]), names[i], weights[i]), reverse=True)[:n_features]
            return [(*who, place, names[i], float(weights[i])) for place, i in enumerate(best, 1)]

        for b in batches:
            out = []
            z, score = np.array(b["kept__"].to_list(), float).reshape(len(b), len(names)), b.y.to_numpy(float)
            row = b["row__"].to_numpy()
            begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(b) else []
            for i, j in zip(begin, [*begin[1:], len(b)]):
                if row[i] != at:
                    out += closed() if sums is not None else []
                    at, who, sums = row[i], tuple(b[k].iloc[i] for k in keys), Equations(len(names))
                sums.add(z[i:j], score[i:j], kernel_width)
            yield pd.DataFrame(out, columns=[*keys, "place", "feature", "weight"])
        if sums is not None:
            yield pd.DataFrame(closed(), columns=[*keys, "place", "feature", "weight"])

    found = scored.mapInPandas(explained, f"{kinds}, place int, feature string, weight double")
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, key)], "place", "feature", "weight")
