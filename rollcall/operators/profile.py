"""Descriptive profile of a table, each report in a fixed number of passes whatever the number of columns.

Reports are long: one row per variable and group. Groups may be NULL. Group totals are joined back instead of
taken by a window, so a group with a third of all rows is split by adaptive execution.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from rollcall.operators.columns import columns_of
from rollcall.operators.ordered import add_slots, group_join, quantiles
from rollcall.operators.types import binary_columns

QUARTILES = {"q25": 0.25, "median": 0.5, "q75": 0.75}


def _group(group: str | Sequence[str] | None) -> list[str]:
    if group is None:
        return []
    return [group] if isinstance(group, str) else list(group)


def _melt(df: DataFrame, by: Sequence[str], columns: Sequence[str], kind: str, extra: Mapping[str, str] | None = None) -> DataFrame:
    rows = []
    for c in columns:
        fields = [F.lit(c).alias("variable"), F.col(f"`{c}`").cast(kind).alias("value")]
        if extra:
            fields.append(F.col(extra[c]).alias("slot"))
        rows.append(F.struct(*fields))
    return df.select(*[F.col(f"`{c}`") for c in by], F.inline(F.array(*rows)))


def summaries(
    df: DataFrame,
    group: str | Sequence[str] | None = None,
    kind: str = "number",
    digits: int = 2,
    approx: bool = False,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Minimum, quartiles, mean, maximum and standard deviation of the number or time columns per group.

    Quartiles are exact and interpolated; ``approx`` takes approximate ones in the same single pass. Times
    come back as timestamps, their standard deviation in seconds. NULL values are left out.
    """
    by = _group(group)
    columns = [c for c in (columns or columns_of(df, kind)) if c not in by]
    if not columns:
        raise ValueError(f"no {kind} columns to summarise")
    numbers = df.select(
        *by,
        *[
            (F.unix_micros(F.col(f"`{c}`").cast("timestamp")) if kind == "time" else F.col(f"`{c}`"))
            .cast("double")
            .alias(c)
            for c in columns
        ],
    )
    keys = ["variable", *by]
    moments: list[Column] = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        moments += [
            F.count(value).alias(f"n{i}"),
            F.min(value).alias(f"min{i}"),
            F.avg(value).alias(f"mean{i}"),
            F.max(value).alias(f"max{i}"),
            F.stddev_samp(value).alias(f"sd{i}"),
        ]
        if approx:
            moments.append(F.percentile_approx(value, list(QUARTILES.values())).alias(f"cuts{i}"))
    fields = ["n", "min", "mean", "max", "sd"]
    rows = []
    for i, c in enumerate(columns):
        one = [F.lit(c).alias("variable"), *[F.col(f"{f}{i}").alias(f) for f in fields]]
        if approx:
            one += [F.get(f"cuts{i}", F.lit(j)).alias(name) for j, name in enumerate(QUARTILES)]
        rows.append(F.struct(*one))
    found = numbers.groupBy(*by).agg(*moments).select(*by, F.inline(F.array(*rows)))
    if not approx:
        slots = {c: f"slot__{i}" for i, c in enumerate(columns)}
        melted = _melt(add_slots(numbers, slots), by, columns, "double", slots)
        found = group_join(found, quantiles(melted, "value", QUARTILES, keys, slot="slot"), keys, "left")
    names = ["min", "q25", "median", "mean", "q75", "max"]
    if kind == "time":
        shown = [F.timestamp_micros(F.col(c).cast("long")).alias(c) for c in names]
        sd = F.round(F.col("sd") / 1e6, digits).alias("sd")
    else:
        shown = [F.round(c, digits).alias(c) for c in names]
        sd = F.round("sd", digits).alias("sd")
    return found.select(*keys, "n", *shown, sd)


def wide_summaries(
    df: DataFrame, group: str | Sequence[str], columns: Sequence[str], functions: Mapping[str, Callable[[Column], Column]]
) -> DataFrame:
    """One row per group with caller-chosen statistics ``<column>_<name>``."""
    return df.groupBy(*_group(group)).agg(
        *[f(F.col(f"`{c}`")).alias(f"{c}_{name}") for c in columns for name, f in functions.items()]
    )


def group_quantiles(
    df: DataFrame, value: str, group: str | Sequence[str] | None, probs: Mapping[str, float] = QUARTILES
) -> DataFrame:
    """Exact quantiles and the mean of one column per group."""
    by = _group(group)
    means = df.groupBy(*by).agg(F.avg(value).alias("mean"))
    cuts = quantiles(df, value, probs, by)
    return group_join(means, cuts, by, "left") if by else means.join(cuts)


def category_counts(df: DataFrame, group: str | Sequence[str] | None = None, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows per variable, group and value of the text columns; NULL is a value."""
    by = _group(group)
    columns = [c for c in (columns or columns_of(df, "text")) if c not in by]
    melted = _melt(df, by, columns, "string")
    return melted.groupBy("variable", *by, "value").agg(F.count(F.lit(1)).alias("n"))


def n_distinct(df: DataFrame, group: str | Sequence[str] | None = None, approx: bool = False, columns: Sequence[str] | None = None) -> DataFrame:
    """Number of distinct non-null values of each text column per group."""
    by = _group(group)
    if approx:
        columns = [c for c in (columns or columns_of(df, "text")) if c not in by]
        melted = _melt(df, by, columns, "string")
        return melted.groupBy("variable", *by).agg(F.approx_count_distinct("value").alias("n_distinct"))
    counts = category_counts(df, group, columns)
    return counts.groupBy("variable", *by).agg(F.count("value").alias("n_distinct"))


def category_shares(
    df: DataFrame,
    group: str | Sequence[str] | None = None,
    top_n: int | None = None,
    digits: int = 3,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Share of each value within its variable and group; combinations that do not occur have no row.

    With ``top_n``, a variable with more values than that (NULL is one) shows only its most frequent non-null
    values overall, ties in text order; the shares still refer to all rows of the group.
    """
    by = _group(group)
    keys = ["variable", *by]
    counts = category_counts(df, group, columns)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("total"))
    shares = group_join(counts, totals, keys).withColumn("share", F.round(F.col("n") / F.col("total"), digits))
    if top_n is not None:
        overall = counts.groupBy("variable", "value").agg(F.sum("n").alias("n"))
        sizes = overall.groupBy("variable").agg(F.count(F.lit(1)).alias("n_values"))
        # the row_number filter becomes a group limit before the shuffle: a task sends at most top_n rows
        order = Window.partitionBy("variable").orderBy(F.desc("n"), F.asc("value"))
        frequent = (
            overall.filter(F.col("value").isNotNull())
            .withColumn("place", F.row_number().over(order))
            .filter(F.col("place") <= top_n)
            .select("variable", "value", F.lit(True).alias("is_frequent"))
        )
        shares = shares.join(sizes, "variable")
        shares = group_join(shares, frequent, ["variable", "value"], "left").filter(
            (F.col("n_values") <= top_n) | F.col("is_frequent")
        )
    return shares.select(*keys, "value", "n", "share")


def binary_shares(df: DataFrame, key: Sequence[str], group: str, digits: int = 3) -> DataFrame:
    """Share of each value of the binary number columns per group (two jobs find the columns)."""
    numbers = [c for c in columns_of(df, "number") if c not in key and c != group]
    found = binary_columns(df, columns=numbers)
    if not found:
        raise ValueError("no binary number columns")
    return category_shares(df, group, None, digits, columns=found)


def pct_missing(df: DataFrame, group: str | Sequence[str] | None = None, digits: int = 1) -> DataFrame:
    """Percentage of NULL per column and group."""
    by = _group(group)
    columns = [c for c in df.columns if c not in by]
    wide = df.groupBy(*by).agg(
        *[(F.avg(F.col(f"`{c}`").isNull().cast("int")) * 100).alias(f"m{i}") for i, c in enumerate(columns)]
    )
    rows = [
        F.struct(F.lit(c).alias("variable"), F.round(f"m{i}", digits).alias("pct_missing"))
        for i, c in enumerate(columns)
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def null_counts(df: DataFrame) -> DataFrame:
    """Number of NULL per column."""
    wide = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"m{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(c).alias("variable"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(df.columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def _complete(columns: Sequence[str]) -> Column:
    # without nested booleans per column: the number of missing values in the row is zero
    missing = F.lit(0)
    for c in columns:
        missing = missing + F.col(f"`{c}`").isNull().cast("int")
    return missing == 0


def complete_cases(df: DataFrame, group: str | Sequence[str] | None = None, digits: int | None = None) -> DataFrame:
    """Percentage of rows without any NULL, per group or overall."""
    pct = F.avg(_complete(df.columns).cast("int")) * 100
    return df.groupBy(*_group(group)).agg((pct if digits is None else F.round(pct, digits)).alias("pct_complete"))


def missing_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each combination of missing columns occurs: 0/1 per column and ``n``."""
    columns = list(columns or df.columns)
    flags = [F.col(f"`{c}`").isNull().cast("int").alias(c) for c in columns]
    return df.select(*flags).groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


#: Rows that centres are taken from. They keep sums of squares small and have no bearing on the answer.
CENTRE_ROWS = 1000
#: Bytes of sums that a task holds before it sends them.
SUMS_BYTES = 64 << 20


def _pair_sums(x: np.ndarray) -> np.ndarray:
    """Six matrices over the rows in which both columns are known: count, sums of the one and the other, their squares and product."""
    known = ~np.isnan(x)
    m, v = known.astype(float), np.where(known, x, 0.0)
    n, first, second = m.T @ m, v.T @ m, (v * v).T @ m
    return np.stack([n, first, first.T, second, second.T, v.T @ v], 1)


def correlations(
    df: DataFrame,
    group: str | Sequence[str] | None = None,
    digits: int = 3,
    columns: Sequence[str] | None = None,
    complete: bool = False,
) -> DataFrame:
    """Pearson correlations of the number columns as rows ``(group..., x, y, r)``, full matrix, in one pass.

    Pairs use all rows in which both values are known; ``complete`` uses only rows without any NULL. NaN counts as
    unknown; ``r`` is NULL for pairs without two rows and where a value does not vary. Tasks add up matrices of
    pairwise sums, so the plan is the same for any number of columns, and send one vector per column and group.
    """
    by = _group(group)
    columns = [c for c in (columns or columns_of(df, "number")) if c not in by]
    if complete:
        df = df.dropna(subset=columns)
    numbers = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")).alias(f"c{i}") for i, c in enumerate(columns)]
    # the group travels as text, so that its types stay as they are
    keys = F.struct(*[F.col(f"`{c}`") for c in by]) if by else F.struct(F.lit(0).alias("all"))
    rows = df.select(F.to_json(keys).alias("group"), *numbers)
    some = rows.limit(CENTRE_ROWS).agg(*[F.avg(f"c{i}") for i in range(len(columns))]).first()
    centre = np.array([0.0 if v is None or not math.isfinite(v) else v for v in some])

    def summed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}

        def sent() -> pd.DataFrame:
            out = [(g, i, s.ravel()) for g, matrix in sums.items() for i, s in enumerate(matrix)]
            sums.clear()
            return pd.DataFrame(out, columns=["group", "i", "sums"])

        for b in batches:
            x = b[[f"c{i}" for i in range(len(columns))]].to_numpy(float) - centre
            codes, groups = pd.factorize(b["group"])
            for k, g in enumerate(groups):
                own = _pair_sums(x[codes == k])
                sums[g] = sums[g] + own if g in sums else own
                if len(sums) * own.nbytes >= SUMS_BYTES:
                    yield sent()
        yield sent()

    parts = rows.mapInPandas(summed, "group string, i int, sums array<double>")
    totals = parts.groupBy("group", "i").agg(Summarizer.sum(array_to_vector("sums")).alias("sums"))
    part = lambda k: F.get("s", F.lit(k * len(columns)) + F.col("j"))
    n, x, y, xx, yy, xy = (part(k) for k in range(6))
    # less than rounding leaves is no variation
    varies = lambda squares, total: F.when(squares - total * total / n > squares * 1e-13, squares - total * total / n).otherwise(0.0)
    spread = F.sqrt(varies(xx, x)) * F.sqrt(varies(yy, y))
    r = F.when((n < 2) | (spread == 0), None).otherwise((xy - x * y / n) / spread)
    one = totals.select("group", "i", vector_to_array("sums").alias("s"), F.explode(F.sequence(F.lit(0), F.lit(len(columns) - 1))).alias("j"))
    names = F.array(*[F.lit(c) for c in columns])
    schema = T.StructType([T.StructField(c, df.schema[c].dataType) for c in by] or [T.StructField("all", T.IntegerType())])
    shown = one.select(F.from_json("group", schema).alias("g"), F.get(names, F.col("i")).alias("x"), F.get(names, F.col("j")).alias("y"), F.round(r, digits).alias("r"))
    return shown.select(*[F.col(f"g.`{c}`").alias(c) for c in by], "x", "y", "r")


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int = 25) -> DataFrame:
    """Counts per equal-width bin, ``bin`` 1 to ``bins``; the last bin includes ``hi``, outsiders are 0 and bins + 1."""
    value = F.col(column)
    place = F.width_bucket(value, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins))
    place = F.when(value == hi, F.lit(bins).cast("long")).otherwise(place)
    return df.filter(value.isNotNull()).groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def bin2d(df: DataFrame, x: str, y: str, wx: float, wy: float) -> DataFrame:
    """Counts on a grid of two values."""
    return (
        df.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.floor(F.col(x) / wx).alias("bin_x"), F.floor(F.col(y) / wy).alias("bin_y"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
