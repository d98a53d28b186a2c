"""Row predicates with a stated rule for NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.values import col


def in_years(year: str | Column, first: int, last: int) -> Column:
    return col(year).between(first, last)


def in_set(c: str | Column, values: Sequence) -> Column:
    """Membership that is never unknown: NULL is not a member."""
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def not_in_set(c: str | Column, values: Sequence, drop_null: bool = False) -> Column:
    """Negated membership. NULL passes by default; with ``drop_null`` it does not, as in SQL."""
    return ~col(c).isin(list(values)) if drop_null else ~in_set(c, values)


def differs(c: str | Column, value: object) -> Column:
    """Inequality that drops NULL."""
    return col(c) != F.lit(value)


def matches(c: str | Column, pattern: str, ignore_case: bool = False) -> Column:
    return col(c).rlike(f"(?i){pattern}" if ignore_case else pattern)


def all_known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def any_of(*conditions: Column) -> Column:
    """True if any condition is true; unknown ones count as false."""
    return reduce(lambda a, b: a | b, [F.coalesce(c, F.lit(False)) for c in conditions])


def if_known(condition: Column, yes: Column, no: Column) -> Column:
    """If/else in which an unknown condition gives NULL instead of ``no``."""
    return F.when(condition, yes).when(~condition, no)


def only_latest(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold the largest value of a column anywhere in the table, by a scalar subquery."""
    return df.filter(F.col(column) == df.agg(F.max(column).alias("latest")).scalar())


def threshold_policy(score: Column, invited: Column, offered: Column, lower: float, upper: float) -> dict[str, Column]:
    """Decisions of a two-threshold policy: strict comparison on both sides."""
    reject, invite = score < lower, score > upper
    screen = ~reject & ~invite
    interview = invite | (screen & invited)
    return {
        "automatic_reject": reject,
        "automatic_invited": invite,
        "model_screen": screen,
        "model_interview": interview,
        "model_offer": interview & offered,
    }
