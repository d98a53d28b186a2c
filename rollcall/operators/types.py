"""What kind of values columns hold: dates in text, yes/no, binary, declared types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from rollcall.operators.columns import columns_of

def parse_dates(column: Column, layouts: Sequence[str]) -> Column:
    """Timestamp by the first layout that fits, else NULL."""
    return F.coalesce(*[F.try_to_timestamp(column, F.lit(layout)) for layout in layouts])


def year_first_timestamp(column: Column) -> Column:
    """Parse year-first text with any date separator or none and an optional, possibly shortened time part.

    The time may have any separator as well (``2018-06-24 12-03-51``), or none after a date without one
    (``20180624120351``, ``20180624 120351``).
    """
    text = F.regexp_replace(F.trim(column), "^(\\d{4})(\\d{2})(\\d{2})(\\d{2})(\\d{2})(\\d{2})$", "$1-$2-$3 $4:$5:$6")
    text = F.regexp_replace(text, "^(\\d{4})(\\d{2})(\\d{2})(?=$|[T ])", "$1-$2-$3")
    text = F.regexp_replace(text, "^(\\d{4})[/.\\- ](\\d{1,2})[/.\\- ](\\d{1,2})(?=$|[T ])", "$1-$2-$3")
    text = F.regexp_replace(text, "^(\\d{4}-\\d{1,2}-\\d{1,2}[T ])(\\d{2})(\\d{2})(\\d{2})?$", "$1$2:$3:$4")
    text = F.regexp_replace(text, "^(\\d{4}-\\d{1,2}-\\d{1,2}[T ]\\d{1,2})[-.](\\d{1,2})(?=$|[-.])", "$1:$2")
    text = F.regexp_replace(text, "^(\\d{4}-\\d{1,2}-\\d{1,2}[T ]\\d{1,2}:\\d{1,2})[-.](\\d{1,2})", "$1:$2")
    text = F.regexp_replace(text, ":$", "")
    whole_hour = F.when(text.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}[T ]\\d{1,2}$"), F.concat(text, F.lit(":00")))
    year_first = text.rlike("^\\d{4}-\\d{1,2}-\\d{1,2}")
    return F.when(year_first, F.coalesce(whole_hour, text).try_cast("timestamp"))


def date_columns(df: DataFrame, columns: Sequence[str] | None = None) -> list[str]:
    """Text columns in which every value parses as a date (one aggregate, one job); all-NULL columns are not."""
    columns = columns_of(df, "text") if columns is None else list(columns)
    if not columns:
        return []
    tests = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`")
        tests.append(F.bool_and(year_first_timestamp(value).isNotNull() | value.isNull()).alias(f"ok{i}"))
        tests.append(F.count(value).alias(f"n{i}"))
    row = df.agg(*tests).first()
    return [c for i, c in enumerate(columns) if row[f"ok{i}"] and row[f"n{i}"] > 0]


def promote_dates(df: DataFrame, columns: Sequence[str] | None = None, zone: str | None = None) -> DataFrame:
    """Turn text columns into timestamps if every value parses, leave the others alone.

    ``zone`` says in which time zone the texts were written; by default the session's.
    """
    found = date_columns(df, columns)

    def promoted(c: str) -> Column:
        stamp = year_first_timestamp(F.col(f"`{c}`"))
        return F.convert_timezone(F.lit(zone), F.current_timezone(), stamp.cast("timestamp_ntz")).cast("timestamp") if zone else stamp

    return df.withColumns({c: promoted(c) for c in found}) if found else df


def yes_no_columns(df: DataFrame) -> list[str]:
    """Text columns that hold only Y, N and NULL (one job); an all-NULL column counts."""
    texts = columns_of(df, "text")
    if not texts:
        return []
    row = df.agg(
        *[F.bool_and(F.coalesce(F.col(f"`{c}`").isin("Y", "N"), F.lit(True))).alias(f"c{i}") for i, c in enumerate(texts)]
    ).first()
    return [c for i, c in enumerate(texts) if row[f"c{i}"] is not False]


def recode_yes_no(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Y to 1 and N to 0; the recoded columns move to the end."""
    columns = yes_no_columns(df) if columns is None else list(columns)
    recoded = [
        F.when(F.col(f"`{c}`") == "Y", 1.0).when(F.col(f"`{c}`") == "N", 0.0).alias(c) for c in columns
    ]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in columns], *recoded)


def value_variety(df: DataFrame, columns: Sequence[str] | None = None) -> dict[str, tuple[int, bool]]:
    """For each column: 0, 1, 2 or 3 (three or more) distinct non-null values, and whether NULL occurs.

    A column has at most two values if every value is its minimum or its maximum. That takes two scans with
    two numbers per column instead of a distinct set per column.
    """
    columns = [c for c, t in df.dtypes if not t.startswith("map")] if columns is None else list(columns)
    if not columns:
        return {}
    types = {f.name: f.dataType for f in df.schema.fields}
    plain = (T.NumericType, T.StringType, T.BooleanType)
    cols = {
        c: F.col(f"`{c}`") if isinstance(types[c], plain) else F.col(f"`{c}`").cast("string") for c in columns
    }
    ends = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.min(v).alias(f"lo{i}") for i, v in enumerate(cols.values())],
        *[F.max(v).alias(f"hi{i}") for i, v in enumerate(cols.values())],
        *[F.count(v).alias(f"n{i}") for i, v in enumerate(cols.values())],
    )
    row = ends.first()
    between = []
    one = lambda i: row[f"lo{i}"] == row[f"hi{i}"] or row[f"lo{i}"] != row[f"lo{i}"]  # noqa: E731  NaN is the largest: all are NaN
    for i, (c, v) in enumerate(cols.items()):
        if row[f"n{i}"] and not one(i):
            lo, hi = F.lit(row[f"lo{i}"]), F.lit(row[f"hi{i}"])
            between.append(F.count_if((v != lo) & (v != hi)).alias(f"m{i}"))
    more = df.agg(*between).first().asDict() if between else {}
    out = {}
    for i, c in enumerate(columns):
        if not row[f"n{i}"]:
            distinct = 0
        elif one(i):
            distinct = 1
        else:
            distinct = 3 if more[f"m{i}"] else 2
        out[c] = (distinct, row["rows"] > row[f"n{i}"])
    return out


def binary_columns(df: DataFrame, exact: bool = False, count_null: bool = False, columns: Sequence[str] | None = None) -> list[str]:
    """Columns with at most two (``exact``: just two) distinct values; ``count_null`` counts NULL as one."""
    out = []
    for c, (distinct, has_null) in value_variety(df, columns).items():
        n = distinct + (1 if count_null and has_null else 0)
        if n == 2 if exact else n <= 2:
            out.append(c)
    return out


def select_binary(df: DataFrame, key: Sequence[str], numeric: bool = False) -> DataFrame:
    """The key and the binary columns; with ``numeric`` only those that hold numbers."""
    numbers = set(columns_of(df, "number"))
    others = [c for c in df.columns if c not in key and (not numeric or c in numbers)]
    return df.select(*key, *binary_columns(df, columns=others))


def display_dates(df: DataFrame, layout: str = "MM-dd-yy") -> DataFrame:
    """Timestamps as text for display."""
    stamps = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]
    return df.withColumns({c: F.date_format(F.col(f"`{c}`"), layout) for c in stamps}) if stamps else df


def variable_types(df: DataFrame) -> DataFrame:
    """Rows ``(variable, type, is_binary)``; NULL counts as a value here."""
    binary = set(binary_columns(df, count_null=True))
    rows = [(c, t, int(c in binary)) for c, t in df.dtypes]
    return df.sparkSession.createDataFrame(rows, "variable string, type string, is_binary int")


def schemas_agree(tables: Mapping[str, DataFrame]) -> tuple[bool, bool]:
    """Whether all tables have the same column names, and the same types, position by position."""
    names = {tuple(df.columns) for df in tables.values()}
    types = {tuple(t for _, t in df.dtypes) for df in tables.values()}
    return len(names) == 1, len(types) == 1


def same_across_row(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row ``all_equal``: whether in every row the columns, as text, hold one single value."""
    columns = df.columns if columns is None else columns
    texts = F.array(*[F.col(f"`{c}`").cast("string") for c in columns])
    return df.agg(F.bool_and(F.size(F.array_distinct(texts)) == 1).alias("all_equal"))
