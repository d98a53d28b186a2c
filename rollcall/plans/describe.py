"""A full descriptive report of one table or a family of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame

from rollcall import DEFAULT_KEY
from rollcall.operators import profile
from rollcall.operators.columns import columns_of
from rollcall.operators.types import binary_columns, recode_yes_no, variable_types, yes_no_columns


def describe_table(
    df: DataFrame,
    group: str,
    key: Sequence[str] = DEFAULT_KEY,
    top_n: int = 10,
    digits: int = 3,
    approx: bool = False,
    only: Sequence[str] | None = None,
) -> dict[str, DataFrame]:
    """Every report on a table, or those named in ``only``, as ``{name: DataFrame}``.

    A report without matching columns is left out. Yes/no columns are recoded to numbers first. Identifier
    columns are not summarised.
    """
    yes_no = yes_no_columns(df)
    data = recode_yes_no(df, yes_no) if yes_no else df
    ids = {*key, group}
    texts = [c for c in columns_of(data, "text") if c not in ids]
    numbers = [c for c in columns_of(data, "number") if c not in ids]
    times = [c for c in columns_of(data, "time") if c not in ids]

    def binary_shares() -> DataFrame | None:
        found = binary_columns(data, columns=numbers)
        return profile.category_shares(data, group, None, digits, found) if found else None

    reports: dict[str, Callable[[], DataFrame | None]] = {
        "variable_types": lambda: variable_types(data),
        "pct_missing": lambda: profile.pct_missing(data, group),
        "missing_patterns": lambda: profile.missing_patterns(data),
        "complete_cases": lambda: profile.complete_cases(data, group),
    }
    if texts:
        reports["n_distinct"] = lambda: profile.n_distinct(data, group, approx, texts)
        reports["category_shares"] = lambda: profile.category_shares(data, group, top_n, digits, texts)
    if numbers:
        reports["summaries"] = lambda: profile.summaries(data, group, "number", digits, approx, numbers)
        reports["correlations"] = lambda: profile.correlations(data, None, digits, numbers)
        reports["correlations_by_group"] = lambda: profile.correlations(data, group, digits, numbers)
        reports["binary_shares"] = binary_shares
    if times:
        reports["time_summaries"] = lambda: profile.summaries(data, group, "time", digits, approx, times)
    made = {name: make() for name, make in reports.items() if only is None or name in only}
    return {name: report for name, report in made.items() if report is not None}


def describe_tables(tables: Mapping[str, DataFrame], group: str, **options) -> dict[str, dict[str, DataFrame]]:
    return {name: describe_table(df, group, **options) for name, df in tables.items()}
