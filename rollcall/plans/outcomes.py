"""Outcome tables: key columns and ``outcome``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.rules import if_known
from rollcall.functions.values import recode
from rollcall.operators.people import rank_bands


def within_years(
    df: DataFrame, outcome: str, years: tuple[int, int], key: Sequence[str] = DEFAULT_KEY, extra: Sequence[str] = ()
) -> DataFrame:
    """Rows of the years for which the outcome is complete; the year is the last key column."""
    year = key[-1]
    return df.filter(F.col(year).between(*years)).select(*key, F.col(outcome).alias("outcome"), *extra)


def missing_as(df: DataFrame, value: object) -> DataFrame:
    return df.fillna({"outcome": value})


def banded(df: DataFrame, outcome: str, years: tuple[int, int], cuts: Sequence[float], key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Known scores by percent rank over all rows: 0 for the lowest band, 1, 2, ... (runs jobs)."""
    scored = within_years(df, outcome, years, key)
    return rank_bands(scored, "outcome", cuts, "band__").select(*key, F.col("band__").alias("outcome"))


def positive(df: DataFrame, outcome: str, years: tuple[int, int], key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """1 for values above zero, 0 for others, NULL stays."""
    rows = within_years(df, outcome, years, key)
    return rows.withColumn("outcome", if_known(F.col("outcome") > 0, F.lit(1), F.lit(0)))


def special_class(
    df: DataFrame, outcome: str, years: tuple[int, int], special: Column, label: int, key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """Known outcomes, with a class of their own for special rows; unknown ``special`` gives NULL."""
    rows = df.filter(F.col(key[-1]).between(*years)).filter(F.col(outcome).isNotNull())
    return rows.select(*key, if_known(special, F.lit(label), F.col(outcome).cast("int")).alias("outcome"))


def weak_match(
    df: DataFrame,
    top: str,
    difficulty: str,
    years: tuple[int, int],
    limit: float,
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """1 for rows outside the top group with a difficulty below the limit, over rows that can be judged."""
    rows = df.filter(F.col(key[-1]).between(*years)).filter(F.col(top).isNotNull())
    rows = rows.filter((F.col(top) == 1) | F.col(difficulty).isNotNull())
    weak = (F.col(top) == 0) & (F.col(difficulty) < limit)
    return rows.select(*key, if_known(weak, F.lit(1), F.lit(0)).alias("outcome"))


def from_codes(df: DataFrame, code: str, values: Mapping, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Known codes recoded to outcome classes."""
    return df.filter(F.col(code).isNotNull()).select(*key, recode(code, values).alias("outcome"))
