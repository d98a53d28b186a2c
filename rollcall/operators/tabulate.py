"""Counts and shares by group, contingency tables, band totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.values import count_true, share

ALL = "All"


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per combination of values, or overall."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def with_all(df: DataFrame, band: str, aggregates: Sequence[Column], dedup: bool = True) -> DataFrame:
    """Aggregates per band and, in a row ``All``, over all bands, from one grouping.

    ``dedup`` first removes rows that are equal in every column, as a ``UNION`` of the rows with their copy
    would. It costs a shuffle of the whole rows: leave it out for rows with a unique key.
    """
    rows = df.distinct() if dedup else df
    total = F.grouping(band).alias("is_total__")
    grouped = rows.rollup(band).agg(total, *aggregates)
    label = F.when(F.col("is_total__") == 1, F.lit(ALL)).otherwise(F.col(band))
    return grouped.withColumn(band, label).drop("is_total__")


def label_order(column: str, labels: Sequence[str]) -> Column:
    """Sort key: position in a list, anything else last."""
    out = F.lit(len(labels) + 1)
    for i, label in enumerate(labels):
        out = F.when(F.col(column) == label, F.lit(i + 1)).otherwise(out)
    return out


def crosstab_shares(
    df: DataFrame, band: str, flags: Mapping[str, Column], digits: int = 3, dedup: bool = True
) -> DataFrame:
    """Per band and overall: number of rows, and for each flag the number and the share of true values.

    Rows in which a flag is unknown are outside its share.
    """
    prepared = df.withColumns({f"flag__{name}": c.cast("int") for name, c in flags.items()})
    columns = [F.count(F.lit(1)).alias("n")]
    for name in flags:
        known = F.col(f"flag__{name}")
        columns += [F.sum(known).alias(name), F.round(F.avg(known), digits).alias(f"pct_{name}")]
    return with_all(prepared, band, columns, dedup)


def count_between(score: Column, lower: float, upper: float) -> Column:
    """Aggregate: rows with ``lower < score <= upper``."""
    return F.sum(F.when((score > lower) & (score <= upper), F.lit(1)).otherwise(F.lit(0)))


def crosstab2(df: DataFrame, a: str, b: str, as_share: bool = False) -> DataFrame:
    """Contingency table in long form; ``as_share`` adds the share of all counted rows. NULL values leave."""
    counts = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    if not as_share:
        return counts
    total = counts.agg(F.sum("n").alias("n")).scalar()
    return counts.withColumn("share", F.col("n") / total)


def crosstab_wide(df: DataFrame, rows: str, columns: str, values: Sequence, condition: Column | None = None) -> DataFrame:
    """Contingency table with one column per listed value and zeros filled in; optionally one slice of the rows."""
    part = df if condition is None else df.filter(condition)
    counts = part.groupBy(rows).pivot(columns, list(values)).agg(F.count(F.lit(1)))
    return counts.fillna(0, subset=[str(v) for v in values])


def funnel(df: DataFrame, year: str, flags: Mapping[str, Column]) -> DataFrame:
    """Rows per year and how many of them reach each step."""
    steps = [F.coalesce(count_true(c), F.lit(0)).alias(name) for name, c in flags.items()]
    return df.groupBy(year).agg(F.count(F.lit(1)).alias("n"), *steps)


def rates_by(df: DataFrame, by: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Share of true values per combination of codes."""
    return df.groupBy(*by).agg(*[share(c).alias(name) for name, c in flags.items()])


def totals(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Sums that skip NULL; the sum of nothing is 0."""
    return df.groupBy(*by).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"total_{c}") for c in columns])


def part_of(true: Column, other: Column) -> Column:
    """Aggregate: true / (true + other), unknown values skipped; NULL if neither occurs."""
    a, b = F.count_if(true), F.count_if(other)
    return F.try_divide(a.cast("double"), (a + b).cast("double"))
