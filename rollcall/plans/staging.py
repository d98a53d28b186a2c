"""Stages between raw and analysed tables: de-identify and clean."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.functions.values import key_digest
from rollcall.operators.columns import (
    add_presence_flags,
    drop_empty_cols,
    empty_columns,
    fill_values,
    rename_regex,
    row_total,
    select_by_rules,
    split_code,
)
from rollcall.operators.people import first_rows
from rollcall.sources.tables import map_tables, stack_rows, tables_with_column


def hash_key(df: DataFrame, column: str, out: str, salt: str | None, drop: bool = False) -> DataFrame:
    """Put a digest of an identifier first; the identifier leaves with ``drop``. See :func:`key_digest`."""
    rest = [c for c in df.columns if not (drop and c == column)]
    return df.select(key_digest(column, salt).alias(out), *[F.col(f"`{c}`") for c in rest])


def deidentify(
    tables: Mapping[str, DataFrame],
    column: str,
    out: str,
    salt: str | None,
    rules: Mapping[str, Mapping[str, Sequence[str]]],
) -> dict[str, DataFrame]:
    """Hash the identifier of every table that has it, then keep or drop columns by rule."""
    identified = {n: tables[n] for n in tables_with_column(tables, column)}
    hashed = map_tables(identified, hash_key, column, out, salt)
    return {n: df.drop(column) for n, df in select_by_rules(hashed, rules).items()}


def clean_applications(
    tables: Mapping[str, DataFrame],
    person: str,
    year: str,
    years: tuple[int, int],
    rules: Sequence[Column],
    flags: Mapping[str, str],
    drop: Sequence[str] = (),
) -> DataFrame:
    """Yearly tables as one: rows that meet the rules, each person's first year, no empty columns, date flags."""
    rows = stack_rows(*tables.values())
    for rule in rules:
        rows = rows.filter(rule)
    first = first_rows(rows, person, year, *years)
    return add_presence_flags(drop_empty_cols(first).drop(*drop), flags)


@dataclass(frozen=True)
class SplitCode:
    """How a summed code is split into two parts; see :func:`split_code`."""

    code: str
    spread: str
    pairs: Mapping[int, tuple[int, int]]
    spread_pairs: Mapping[int, tuple[tuple[int, int], tuple[int, int]]]
    names: tuple[str, str, str]


@dataclass(frozen=True)
class Fixes:
    """What is done to one table on its way to the clean stage, in the order of the fields.

    ``rename`` changes column names by regex; ``numbers`` removes a text from a column's values and makes them whole
    numbers; ``fill`` replaces NULL; ``totals`` adds sums (NULL if a part is); ``split`` splits a code; ``flags`` says of
    which columns a value is known; ``drop`` removes columns at the end.
    """

    rename: Mapping[str, str] = field(default_factory=dict)
    numbers: Mapping[str, str] = field(default_factory=dict)
    fill: Mapping[str, object] = field(default_factory=dict)
    totals: Mapping[str, Sequence[str]] = field(default_factory=dict)
    split: SplitCode | None = None
    flags: Mapping[str, str] = field(default_factory=dict)
    drop: Sequence[str] = ()

    def columns(self) -> set[str]:
        """Columns that the fixes read, by their new names."""
        split = {self.split.code, self.split.spread} if self.split else set()
        return {*self.numbers, *self.fill, *(c for parts in self.totals.values() for c in parts), *split, *self.flags.values()}


def clean_table(df: DataFrame, fixes: Fixes | None = None) -> DataFrame:
    """A table without its empty columns and with its fixes (one job). A column that a fix reads stays, also if it is empty."""
    fixes = fixes or Fixes()
    out = rename_regex(df, fixes.rename) if fixes.rename else df
    out = out.drop(*[c for c in empty_columns(out) if c not in fixes.columns()])
    for c, text in fixes.numbers.items():
        out = out.withColumn(c, F.replace(F.col(f"`{c}`"), F.lit(text), F.lit("")).try_cast("int"))
    out = fill_values(out, fixes.fill) if fixes.fill else out
    out = out.withColumns({name: row_total(parts) for name, parts in fixes.totals.items()}) if fixes.totals else out
    if fixes.split:
        s = fixes.split
        out = split_code(out, s.code, s.spread, s.pairs, s.spread_pairs, s.names)
    return (add_presence_flags(out, fixes.flags) if fixes.flags else out).drop(*fixes.drop)


def clean_tables(tables: Mapping[str, DataFrame], fixes: Mapping[str, Fixes]) -> dict[str, DataFrame]:
    """Every table of a family cleaned, each with its own fixes; fixes for a table that is not there are an error."""
    if missing := sorted(set(fixes) - set(tables)):
        raise KeyError(f"no tables named {', '.join(missing)}")
    return {name: clean_table(df, fixes.get(name)) for name, df in tables.items()}
