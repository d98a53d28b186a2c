"""Projection, renaming and column cleaning."""

from __future__ import annotations

import re
import warnings
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _known(df: DataFrame, columns: Sequence[str]) -> list[str]:
    unknown = [c for c in columns if c not in df.columns]
    if unknown:
        warnings.warn(f"unknown columns: {', '.join(unknown)}", stacklevel=3)
    return [c for c in columns if c in df.columns]


def select_by_rule(df: DataFrame, keep: Sequence[str] | None = None, drop: Sequence[str] | None = None) -> DataFrame:
    """Keep or drop a list of columns; names the table lacks only warn."""
    if (keep is None) == (drop is None):
        raise ValueError("give exactly one of keep and drop")
    return df.select(*_known(df, keep)) if keep is not None else df.drop(*_known(df, drop))


def rule_name(table: str) -> str | None:
    """The dictionary entry for a table name: its first run of letters, single separators allowed."""
    found = re.search(r"[^\W\d_]+(.?[^\W\d_])*", table)
    return found.group(0) if found else None


def select_by_rules(
    tables: Mapping[str, DataFrame], rules: Mapping[str, Mapping[str, Sequence[str]]]
) -> dict[str, DataFrame]:
    """:func:`select_by_rule` for a family; ``2014_scores`` and ``2015_scores`` share the rule ``scores``."""
    out = {}
    for name, df in tables.items():
        rule = rule_name(name.split("$", 2)[-1])
        if rule not in rules:
            raise KeyError(f"no column rule for table {name}")
        out[name] = select_by_rule(df, **rules[rule])
    return out


def _renamed(df: DataFrame, change: Callable[[str], str]) -> DataFrame:
    names = [change(c) for c in df.columns]
    if len(set(names)) < len(names):
        raise ValueError(f"renaming makes column names collide: {sorted(n for n in names if names.count(n) > 1)}")
    return df.toDF(*names)


def fix_colnames(df: DataFrame) -> DataFrame:
    """Spaces to underscores, lower case."""
    return _renamed(df, lambda c: c.replace(" ", "_").lower())


def rename_regex(df: DataFrame, patterns: Mapping[str, str]) -> DataFrame:
    """Apply regex replacements to the column names, in order."""

    def change(name: str) -> str:
        for pattern, text in patterns.items():
            name = re.sub(pattern, text, name)
        return name

    return _renamed(df, change)


def suffix_columns(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns})


def prefix_by_type(df: DataFrame, prefix: str, types: Sequence[str] = ("int", "bigint"), skip: Sequence[str] = ()) -> DataFrame:
    """Prefix the columns of some types, integers by default."""
    return df.withColumnsRenamed({c: f"{prefix}_{c}" for c, t in df.dtypes if t in types and c not in skip})


def columns_of(df: DataFrame, kind: str) -> list[str]:
    """Names of the ``number``, ``text``, ``time`` or ``flag`` columns."""
    kinds = {
        "number": T.NumericType,
        "text": T.StringType,
        "time": (T.TimestampType, T.TimestampNTZType, T.DateType),
        "flag": T.BooleanType,
    }
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds[kind])]


def transform_by_type(df: DataFrame, kind: str, change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({c: change(F.col(f"`{c}`")) for c in columns_of(df, kind)})


def select_like(
    df: DataFrame,
    first: Sequence[str] = (),
    starts: Sequence[str] = (),
    ends: Sequence[str] = (),
    between: tuple[str, str] | None = None,
    rest: bool = False,
) -> DataFrame:
    """Select named columns, then those by prefix, suffix or name range, then optionally all others."""
    chosen = list(first)
    if between:
        at = df.columns.index
        chosen += df.columns[at(between[0]) : at(between[1]) + 1]
    chosen += [c for c in df.columns if any(c.startswith(s) for s in starts)]
    chosen += [c for c in df.columns if any(c.endswith(s) for s in ends)]
    if rest:
        chosen += df.columns
    return df.select(*dict.fromkeys(chosen))


def empty_columns(df: DataFrame) -> list[str]:
    """Columns that hold only NULL (one aggregate, one job); an empty table has none."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows__"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    ).first()
    return [c for c in df.columns if counts["rows__"] > 0 and counts[c] == 0]


def drop_empty_cols(df: DataFrame) -> DataFrame:
    """Drop the columns that hold only NULL."""
    return df.drop(*empty_columns(df))


def fill_values(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Replace NULL by a value per column."""
    return df.fillna(dict(values))


def mask_outside_years(df: DataFrame, ranges: Mapping[str, tuple[int, int]], year: str = "app_year") -> DataFrame:
    """Set each column to NULL outside its inclusive range of years."""
    return df.withColumns(
        {c: F.when(F.col(year).between(lo, hi), F.col(f"`{c}`")) for c, (lo, hi) in ranges.items()}
    )


def add_presence_flags(df: DataFrame, flags: Mapping[str, str]) -> DataFrame:
    """``{flag: column}``: true where the column is not NULL."""
    return df.withColumns({flag: F.col(f"`{c}`").isNotNull() for flag, c in flags.items()})


def tag(df: DataFrame, **values: object) -> DataFrame:
    """Add constant columns."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def row_total(columns: Sequence[str], missing_as_zero: bool = False) -> Column:
    """Sum over columns; NULL if any is NULL, unless missing values count as zero."""
    total = F.lit(0)
    for c in columns:
        total = total + (F.coalesce(F.col(f"`{c}`"), F.lit(0)) if missing_as_zero else F.col(f"`{c}`"))
    return total


def split_code(df: DataFrame, code: str, spread: str, pairs: Mapping[int, tuple[int, int]], spread_pairs: Mapping[int, tuple[tuple[int, int], tuple[int, int]]], names: tuple[str, str, str]) -> DataFrame:
    """Split a summed code into its two parts and their total.

    ``pairs`` gives the parts of unambiguous codes. ``spread_pairs`` gives, for codes with two readings, the
    parts when ``spread`` is zero and when it is not; both parts are NULL when ``spread`` is NULL.
    """

    def part(i: int) -> Column:
        chosen = F.lit(None).cast("int")
        for value, parts in pairs.items():
            chosen = F.when(F.col(code) == value, F.lit(parts[i])).otherwise(chosen)
        for value, (even, uneven) in spread_pairs.items():
            reading = F.when(F.col(spread) == 0, F.lit(even[i])).when(F.col(spread) != 0, F.lit(uneven[i]))
            chosen = F.when(F.col(code) == value, reading).otherwise(chosen)
        return chosen

    first, second, total = names
    return df.withColumns({first: part(0), second: part(1)}).withColumn(total, F.col(first) + F.col(second))
