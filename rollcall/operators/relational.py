"""Joins, set operations and key checks.

Joins carry no broadcast hints: Spark broadcasts a side only when its measured size is below the session's
threshold, and adaptive execution splits hot partitions of the others.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.operators.ordered import null_safe_semi


def in_keys(df: DataFrame, keys: DataFrame, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Rows whose key occurs in ``keys``.

    Keys are made distinct first. The join needs them hashed by key anyway, and a key that ``keys`` holds very
    often shrinks to one row before it is sent.
    """
    return df.join(keys.select(*key).distinct(), list(key), "left_semi")


def not_yet_in(
    df: DataFrame, done: DataFrame, key: Sequence[str] = DEFAULT_KEY, null_aware: bool = False
) -> DataFrame:
    """Rows whose key does not occur in ``done``.

    By default a NULL in a key matches nothing. ``null_aware`` gives the meaning of SQL ``NOT IN``: a row
    stays only if it certainly differs from every row of ``done`` (runs two jobs).
    """
    if not null_aware:
        return df.join(done.select(*key).distinct(), list(key), "left_anti")
    return _certainly_absent(df, done.select(*key).distinct(), list(key))


def null_pattern(key: Sequence[str]) -> Column:
    """Which of the columns are NULL, as bits: bit i for column i."""
    bits = [F.when(F.col(f"`{c}`").isNull(), F.lit(1 << i)).otherwise(F.lit(0)).cast("long") for i, c in enumerate(key)]
    return reduce(lambda a, b: a + b, bits, F.lit(0).cast("long"))


def _patterns(df: DataFrame, key: Sequence[str]) -> list[int]:
    return sorted(r[0] for r in df.select(null_pattern(key)).distinct().collect())


def _certainly_absent(df: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    # A pair may be equal if it agrees on the columns known on both sides. The patterns of NULL that occur are looked
    # up first (two jobs); rows of one pattern need a hash anti-join for each set of columns that they and some pattern
    # of ``done`` both know, so keys without NULL need one join, whatever the number of columns
    mine, theirs = _patterns(df, key), _patterns(done, key)
    if not theirs:
        return df
    parts = []
    for pattern in mine:
        by_shared: dict[tuple[str, ...], list[int]] = {}
        for other in theirs:
            by_shared.setdefault(tuple(c for i, c in enumerate(key) if not (pattern | other) >> i & 1), []).append(other)
        if () in by_shared:
            continue  # some row of ``done`` may equal every row of this pattern
        rest = df if len(mine) == 1 else df.filter(null_pattern(key) == pattern)
        for shared, others in by_shared.items():
            known = done if len(others) == len(theirs) else done.filter(null_pattern(key).isin(others))
            rest = rest.join(known.select(*shared).distinct(), list(shared), "left_anti")
        parts.append(rest.select(*[F.col(f"`{c}`") for c in df.columns]))
    return reduce(DataFrame.unionAll, parts) if parts else df.limit(0)


def duplicate_keys(df: DataFrame, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def duplicate_rows(df: DataFrame, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """The rows behind :func:`duplicate_keys`, rows with NULL in the key included."""
    return null_safe_semi(df, duplicate_keys(df, key), key)


def require_unique(df: DataFrame, key: Sequence[str], name: str = "table") -> DataFrame:
    """Fail if a key occurs twice (runs a job that stops at the first duplicate)."""
    if not duplicate_keys(df, key).isEmpty():
        raise ValueError(f"{name}: key {tuple(key)} is not unique")
    return df


def star_join(
    base: DataFrame,
    blocks: Mapping[str, DataFrame],
    key: Sequence[str] = DEFAULT_KEY,
    unique: bool = True,
) -> DataFrame:
    """Left-join feature blocks onto the base rows.

    With ``unique`` each block is checked first, since a repeated key would multiply base rows. Blocks made by
    grouping on the key are unique already; pass ``unique=False`` to save the job.
    """
    out = base
    for name, block in blocks.items():
        if unique:
            require_unique(block, key, name)
        clash = (set(block.columns) & set(out.columns)) - set(key)
        if clash:
            raise ValueError(f"{name}: columns already present: {sorted(clash)}")
        out = out.join(block, list(key), "left")
    return out


def left_join_any(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Left join to a table in which a key may have very many rows.

    Adaptive execution can split the right side of an inner join but not that of a left join, so the matched
    rows come from an inner join and the unmatched ones from an anti-join.
    """
    matched = left.join(right, list(key), "inner")
    return matched.unionByName(not_yet_in(left, right, key), allowMissingColumns=True)


def join_shared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left join on every column the two tables share."""
    shared = [c for c in left.columns if c in right.columns]
    if not shared:
        raise ValueError("the tables share no column")
    return left_join_any(left, right, shared)


def lookup(df: DataFrame, table: DataFrame, on: Column, how: str = "left") -> DataFrame:
    """Join on an expression, such as the first letters of a code."""
    return df.join(table, on, how)


def conflicting(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Keys with more than one distinct value of a column, and how many ``n_values``."""
    return df.groupBy(*key).agg(F.count_distinct(F.col(column)).alias("n_values")).filter("n_values > 1")


def distinct_combinations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row ``n``: number of distinct combinations."""
    return df.select(*columns).distinct().agg(F.count(F.lit(1)).alias("n"))


def union_distinct(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts).distinct()


def set_difference(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct combinations on the left that the right lacks; NULL equals NULL here."""
    return left.select(*columns).subtract(right.select(*columns))


def lost_rows(earlier: DataFrame, later: DataFrame, key: Sequence[str], detail: DataFrame) -> DataFrame:
    """Keys present in an earlier step and missing in a later one, with their detail columns."""
    return left_join_any(set_difference(earlier, later, key), detail, key)


def first_n(df: DataFrame, n: int, order: Sequence[Column | str]) -> DataFrame:
    """The first rows in a stated order (a report, not a safety cap)."""
    return df.orderBy(*order).limit(n)
