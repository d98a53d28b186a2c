"""Whitening of embeddings by a covariance that is put together from variances alone.

The polarisation identity: cov(a, b) = (var(a + b) - var(a) - var(b)) / 2. Each task adds up squared centred values of every dimension and of every sum of two dimensions; their
differences are all cross-covariances.

1. Components become integers floor(scale * c). The fit list holds each distinct integer vector once, in a kept table; a vector that a third of all rows share is one row of it.
2. First pass: the size n of the list and the sum S of each dimension.
3. Second pass: y is a vector less the integer nearest to the mean, and tasks add the squares of y_i and of y_i + y_j. With r = S - n * nearest, the sum of (n x_i - S_i)^2 is n (n sum(y_i^2) - r_i^2),
   so sums of squares around the true mean are exact, with nothing lost to rounding however far the mean is from zero.
4. The driver turns d (d + 1) / 2 numbers into the covariance, divides exactly and calls eigh. Its work depends on the dimensions, not on the rows.
5. Rows are projected where they lie. A third pass over the fit list measures how far the covariance of the whitened list is from the identity.

Sums travel as text and meet as decimals of 38 digits, so they are exact beyond 64 bits.

Rules. Rows whose vector is null or holds null or non-finite entries are dropped. Vectors of different lengths are fitted apart; identity_error is the largest of all. Vectors shorter than
the number of components have fewer of them; an empty vector has none, so its row is in no result. A component along which the fit list does not vary (a variance within rounding of zero) has a null
whitened value and does not count for identity_error; explained is null where nothing varies, and identity_error is null where no component does. Of the two signs a component takes the one
that makes its largest entry positive. Rows with a null or repeated id are rows of their own. An empty table gives an empty result. Entries beyond 2^53 after scaling, and sums beyond 38 digits, are an error. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.common import kept_table

SCALE, COMPONENTS = 256, 4
#: Rows whose pair sums a task squares at once.
CHUNK = 2048
#: Whole numbers beyond 64 bits go from Python to Spark as text.
WHOLE = "decimal(38,0)"


def integers(rows: DataFrame, scale: int, id_column: str, vector_column: str) -> DataFrame:
    """id, x (array of long): the rows that take part."""
    c = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    good = rows.select(F.col(id_column).alias("id"), c.alias("c"))
    good = good.where(F.col("c").isNotNull() & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))
    large = F.exists("c", lambda v: F.abs(v) * scale >= 2.0**53)
    x = F.when(large, F.raise_error(F.lit("an entry is too large to be whitened"))).otherwise(F.transform("c", lambda v: F.floor(v * scale).cast("long")))
    return good.select("id", x.alias("x"))


def matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_list()).astype(np.int64)


def exact(values: np.ndarray, most: int) -> np.ndarray:
    """``values`` as 64-bit numbers where numbers up to ``most`` stay in 64 bits, as Python's integers else."""
    return values if most < 1 << 62 else values.astype(object)


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.min())), abs(int(values.max()))) if values.size else 0


def totals(fit: DataFrame, add) -> dict[tuple[int, int], int]:
    """Exact totals over the list of what ``add`` makes of a matrix: {(i, j): sum}. Each task sends one row for each pair (i, j)."""

    def added(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[tuple[int, int], int] = {}
        for b in batches:
            if len(b):
                for k, v in add(matrix(b.x)).items():
                    sums[k] = sums.get(k, 0) + v
        yield pd.DataFrame([(i, j, str(v)) for (i, j), v in sums.items()], columns=["i", "j", "total"])

    parts = fit.select("x").mapInPandas(added, "i int, j int, total string")
    found = parts.groupBy("i", "j").agg(F.sum(F.col("total").cast(WHOLE)).alias("total")).collect()
    return {(r["i"], r["j"]): int(r["total"]) for r in found}


def sums(x: np.ndarray) -> dict[tuple[int, int], int]:
    """The sum of each dimension at (i, i), and the number of rows at (-1, -1)."""
    s = exact(x, largest(x) * len(x)).sum(0)
    return {(-1, -1): len(x)} | {(i, i): int(v) for i, v in enumerate(s)}


def squares(x: np.ndarray, nearest: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of squared centred values: of dimension i at (i, i), of the sum of dimensions i < j at (i, j)."""
    out: dict[tuple[int, int], int] = {}
    for start in range(0, len(x), CHUNK):
        y = x[start : start + CHUNK] - nearest
        y = exact(y, 4 * largest(y) ** 2 * len(y))
        for i in range(y.shape[1]):
            pairs = y[:, i:] + y[:, i : i + 1]
            pairs[:, 0] = y[:, i]
            for j, v in enumerate((pairs * pairs).sum(0), i):
                out[i, j] = out.get((i, j), 0) + int(v)
    return out


class Whitening:
    """n, S, the covariance's components, their variances and shares, for vectors of one length."""

    def __init__(self, fit: DataFrame, length: int, components: int) -> None:
        first = totals(fit, sums)
        self.n = n = first[-1, -1]
        self.sums = [first[i, i] for i in range(length)]
        near = [(2 * s + n) // (2 * n) for s in self.sums]
        rest = [s - n * m for s, m in zip(self.sums, near)]
        center = np.array(near, np.int64)
        second = totals(fit, lambda x: squares(x, center))
        # n^2 times the squares of what lies around the true mean; a pair's mean is the sum of the two
        around = {(i, j): n * q - (rest[i] if i == j else rest[i] + rest[j]) ** 2 for (i, j), q in second.items()}
        cov = np.zeros((length, length))
        for (i, j), q in around.items():
            twice = 2 * q if i == j else q - around[i, i] - around[j, j]
            cov[i, j] = cov[j, i] = float(Fraction(twice, 2 * n * n))
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(-values, kind="stable")[:components]
        self.trace = float(Fraction(sum(around[i, i] for i in range(length)), n * n)) if length else 0.0
        self.values = values[order]
        signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(length)]) if length else np.zeros(0)
        self.vectors = (vectors * signs)[:, order]
        self.varies = self.values > max(self.trace, 1e-300) * length * np.finfo(float).eps

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n x - S, exactly."""
        most = max([self.n * largest(x), *(abs(s) for s in self.sums)]) * 2
        return exact(x, most) * self.n - np.array(self.sums, object if most >= 1 << 62 else np.int64)

    def project(self, z: np.ndarray) -> np.ndarray:
        """Whitened values; components that do not vary are NaN."""
        scale = np.where(self.varies, np.sqrt(np.where(self.varies, self.values, 1)), np.nan)
        return (z.astype(float) / self.n) @ self.vectors / scale

    def identity_error(self, fit: DataFrame) -> float | None:
        """The largest entry of the whitened list's covariance less the identity."""
        keep = np.flatnonzero(self.varies)
        if not len(keep):
            return None

        def products(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if len(b):
                    w = self.project(self.centred(matrix(b.x)))[:, keep]
                    yield pd.DataFrame([(i, j, float((w[:, i] * w[:, j]).sum())) for i in range(len(keep)) for j in range(i + 1)], columns=["i", "j", "s"])
                    yield pd.DataFrame([(-1, i, float(s)) for i, s in enumerate(w.sum(0))], columns=["i", "j", "s"])

        found = fit.select("x").mapInPandas(products, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
        total = {(r["i"], r["j"]): r["s"] / self.n for r in found}
        return max(abs(s - total[-1, i] * total[-1, j] - (i == j)) for (i, j), s in total.items() if i >= 0)

    def rows(self, vectors: DataFrame) -> DataFrame:
        """id, component, n, deviation (as text), whitened, explained."""
        shares = self.values / self.trace if self.trace > 0 else np.full(len(self.values), np.nan)

        def whitened(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                if not len(b):
                    continue
                z = self.centred(matrix(b.x))
                z = exact(z, z.shape[1] * largest(z) ** 2)
                deviation = [str(d) for d in (z * z).sum(1)]
                w = self.project(z)
                for k in range(w.shape[1]):
                    yield pd.DataFrame({"id": b.id, "component": k + 1, "n": self.n, "deviation": deviation, "whitened": w[:, k], "explained": shares[k]})

        kind = vectors.schema["id"].dataType.simpleString()
        return vectors.mapInPandas(whitened, f"id {kind}, component int, n long, deviation string, whitened double, explained double")


def whiten(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """The id column, component, n, deviation (decimal: squares of n x - S over the dimensions), whitened, explained and identity_error, one row for each kept row and component."""
    vectors = integers(rows, scale, id_column, vector_column)
    fit = kept_table(vectors.select("x").where(F.size("x") > 0).distinct(), "whitening-fit")
    kind = rows.schema[id_column].dataType.simpleString()
    out = rows.sparkSession.createDataFrame([], f"id {kind}, component int, n long, deviation string, whitened double, explained double")
    errors = []
    # one row for each length that occurs
    for length in sorted(r["n"] for r in fit.select(F.size("x").alias("n")).distinct().collect()):
        of_length = fit.where(F.size("x") == length)
        model = Whitening(of_length, length, components)
        errors.append(model.identity_error(of_length))
        out = out.unionAll(model.rows(vectors.where(F.size("x") == length)))
    error = max((e for e in errors if e is not None), default=None)
    return out.select(
        F.col("id").alias(id_column),
        "component",
        "n",
        F.col("deviation").cast(WHOLE).alias("deviation"),
        F.nanvl("whitened", F.lit(None)).alias("whitened"),
        F.nanvl("explained", F.lit(None)).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
