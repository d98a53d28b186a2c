"""Scalar column functions."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(score: str | Column, lower: float, upper: float, labels: tuple[str, str, str] = ("Reject", "Hold", "Invite")) -> Column:
    """Three bands by two strict thresholds; a NULL score falls into the lowest band."""
    s = col(score)
    return F.when(s > upper, labels[2]).when(s > lower, labels[1]).otherwise(labels[0])


def round_away(c: str | Column, digits: int = 0) -> Column:
    """Round half away from zero, as SQL does."""
    return F.round(col(c), digits)


def round_even(c: str | Column, digits: int = 0) -> Column:
    """Round half to even, as numeric libraries do."""
    return F.bround(col(c), digits)


def net_score(positive: str | Column, negative: str | Column) -> Column:
    """Probability of the best class minus probability of the worst."""
    return col(positive) - col(negative)


def to_number(c: str | Column, kind: str = "double") -> Column:
    """Cast; text that is no number is NULL."""
    return col(c).try_cast(kind)


def to_unsigned(c: str | Column) -> Column:
    """Whole non-negative number or NULL."""
    number = col(c).try_cast("bigint")
    return F.when(number >= 0, number)


def first_letters(c: str | Column, n: int) -> Column:
    return F.substring(col(c), 1, n)


def strip_text(c: str | Column, pattern: str) -> Column:
    return F.regexp_replace(col(c), pattern, "")


def recode(c: str | Column, values: Mapping, otherwise: Column | None = None) -> Column:
    """Look values up in a small dictionary; others become ``otherwise`` (NULL by default)."""
    out = F.lit(None) if otherwise is None else otherwise
    for old, new in values.items():
        out = F.when(col(c) == old, F.lit(new)).otherwise(out)
    return out


def year_band(year: str | Column, bands: Sequence[tuple[int, str]], otherwise: str = "") -> Column:
    """The label of the first upper year bound that is not exceeded; a NULL year has a NULL band."""
    y = col(year)
    out = F.when(y.isNotNull(), F.lit(otherwise))
    for last, label in reversed(list(bands)):
        out = F.when(y <= last, F.lit(label)).otherwise(out)
    return out


def flag(condition: Column) -> Column:
    """0/1 integer; unknown stays NULL."""
    return condition.cast("int")


def flag_or_zero(condition: Column) -> Column:
    """0/1 integer; unknown counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def share(condition: Column) -> Column:
    """Aggregate: share of true among known values."""
    return F.avg(condition.cast("int"))


def count_true(condition: Column) -> Column:
    """Aggregate: number of true values; NULL if nothing is known."""
    return F.sum(condition.cast("long"))


def safe_ratio(over: Column, under: Column) -> Column:
    """Division in which x/0 is NULL."""
    return F.try_divide(over.cast("double"), under.cast("double"))


def key_digest(c: str | Column, salt: str | None) -> Column:
    """Digest of an identifier: keyed SHA-256, or plain MD5 when ``salt`` is None.

    Plain MD5 of a short numeric identifier can be reversed by trying all numbers; use it only to match
    existing data.
    """
    text = col(c).cast("string")
    return F.md5(text) if salt is None else F.sha2(F.concat(F.lit(salt), text), 256)


def percent_text(share_column: str | Column, digits: int = 3) -> Column:
    """A share as percent text with some significant digits."""
    p = col(share_column) * 100
    whole = F.when(p == 0, F.lit(1)).otherwise(F.floor(F.log10(F.abs(p))).cast("int") + 1)
    decimals = F.greatest(F.lit(digits) - whole, F.lit(0))
    rounded = F.format_string(f"%.{digits + 6}f", _round_to(p, decimals, digits))
    return F.concat(F.regexp_replace(F.regexp_replace(rounded, "0+$", ""), "\\.$", ""), F.lit("%"))


def _round_to(number: Column, decimals: Column, most: int) -> Column:
    out = number
    for d in range(most + 6):
        out = F.when(decimals == d, F.round(number, d)).otherwise(out)
    return out


def as_json(value: object) -> Column:
    """A small driver-side value as a JSON text column."""
    return F.lit(json.dumps(value, sort_keys=True))


def explicit_missing(df: DataFrame, columns: Sequence[str], label: str = "N/A") -> DataFrame:
    """Give missing text values a level of their own."""
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(label)) for c in columns})
