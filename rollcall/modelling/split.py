"""Categorical columns, the stratified split and the fold column."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.operators.columns import columns_of
from rollcall.operators.ordered import at_or_before_cut, cut_rows, group_join, small_or_lazy
from rollcall.operators.relational import in_keys
from rollcall.operators.types import binary_columns

# Fixed value: names of grade-count columns, which stay numeric even with two values.
COUNT_COLUMN = r"_[ABCDF]$"


def categorical_columns(df: DataFrame, exclude: Sequence[str] = (), numeric_pattern: str = COUNT_COLUMN) -> list[str]:
    """Text columns and columns with just two values (runs two jobs); ``exclude`` names key and outcome."""
    texts = [c for c in columns_of(df, "text") if c not in exclude]
    others = [c for c in df.columns if c not in exclude and c not in texts and not re.search(numeric_pattern, c)]
    two_values = set(binary_columns(df, exact=True, columns=others))
    return [c for c in df.columns if c in texts or c in two_values]


def row_digest(key: Sequence[str], seed: int) -> Column:
    """The first 60 bits of an MD5 of the key, as a number: evenly spread and independent of partitioning."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key], F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def stratified_split(
    df: DataFrame,
    label: str,
    key: Sequence[str] = DEFAULT_KEY,
    seed: int = 1100,
    test: float = 0.2,
    name: str = "set",
) -> DataFrame:
    """Add ``set``: per label the first ``test`` share of rows in digest order is ``test``, the rest ``train``.

    The digest of the last test row of each label is looked up (jobs), then joined to the rows of its label, so
    no label is gathered or sorted in one task, whatever the number of labels.
    """
    order = ["digest__", *key]
    digested = df.withColumn("digest__", row_digest(key, seed))
    last = cut_rows(digested, order, {"last": lambda n: F.floor(n * F.lit(test) + 0.5) - 1}, by=[label])
    cuts = last.select(label, "depth__", *[F.col(f"`{c}`").alias(f"cut__{c}") for c in order])
    beside = group_join(digested, small_or_lazy(cuts), [label], "left")
    in_test = F.coalesce(at_or_before_cut(order, "cut__", "depth__"), F.lit(False))
    out = beside.withColumn(name, F.when(in_test, "test").otherwise("train"))
    return out.select(*[F.col(f"`{c}`") for c in df.columns if c != name], name)


def fold_column(key: Sequence[str], folds: int, seed: int = 1100) -> Column:
    """Fold 0 to ``folds`` - 1 from the key only."""
    return F.pmod(F.xxhash64(F.lit(seed), *[F.col(c) for c in key]), F.lit(folds)).cast("int")


def split_stored(data: DataFrame, results: DataFrame, key: Sequence[str] = DEFAULT_KEY) -> tuple[DataFrame, DataFrame]:
    """Feature rows of the stored training and test results."""
    return tuple(in_keys(data, results.filter(F.col("set") == s), key) for s in ("train", "test"))
