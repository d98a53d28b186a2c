"""Row-level records to one feature row per key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY


def _counts(code: str, buckets: Mapping[str, Sequence[str]]) -> list[Column]:
    return [
        F.sum(F.when(F.col(code).isin(list(values)), 1).otherwise(0)).alias(name) for name, values in buckets.items()
    ]


def bucket_counts(
    df: DataFrame, code: str, buckets: Mapping[str, Sequence[str]], key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """How many codes of each key fall into each bucket of values; NULL and unlisted codes fall into none."""
    return df.groupBy(*key).agg(*_counts(code, buckets))


def bucket_counts_by(
    df: DataFrame,
    code: str,
    buckets: Mapping[str, Sequence[str]],
    by: str,
    by_values: Sequence[str],
    total: str,
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """:func:`bucket_counts` overall, as ``<total>_<bucket>``, and per class, as ``<class>_<bucket>``.

    One conditional aggregate in one shuffle, with zeros for classes a key does not have.
    """
    columns = [c.alias(f"{total}_{name}") for name, c in zip(buckets, _counts(code, buckets))]
    for value in by_values:
        for name, codes in buckets.items():
            hit = (F.col(by) == value) & F.col(code).isin(list(codes))
            columns.append(F.sum(F.when(hit, 1).otherwise(0)).alias(f"{value.lower()}_{name}"))
    return df.groupBy(*key).agg(*columns)


def level_trend(
    df: DataFrame,
    level: str,
    value: str,
    levels: Sequence[str],
    pairs: Mapping[str, tuple[str, str]],
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Whether a value rises between levels: ``{column: (higher, lower)}`` gives 1, 0 or, if one is missing, NULL.

    A key has one value per level; should it have several, the largest counts.
    """
    known = df.filter(F.col(level).isin(list(levels)))
    at = {v: F.max(F.when(F.col(level) == v, F.col(value))) for v in levels}
    return known.groupBy(*key).agg(
        *[(at[higher] > at[lower]).cast("int").alias(name) for name, (higher, lower) in pairs.items()]
    )


def level_block(
    df: DataFrame, level: str, wanted: str, columns: Sequence[str], suffix: str, key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """The rows of one level with their value columns suffixed."""
    return df.filter(F.col(level) == wanted).select(*key, *[F.col(c).alias(f"{c}_{suffix}") for c in columns])
