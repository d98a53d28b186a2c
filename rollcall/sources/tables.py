"""Table names, families of tables, and readers."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from rollcall import DEFAULT_KEY
from rollcall.operators.types import promote_dates

Tables = dict[str, DataFrame]


@dataclass(frozen=True)
class TableName:
    """A staged name ``identity$status$name``, such as ``deidentified$clean$grades``."""

    name: str
    identity: str = "deidentified"
    status: str = "clean"

    SEPARATOR = "$"

    def __str__(self) -> str:
        return self.SEPARATOR.join((self.identity, self.status, self.name))

    @property
    def path(self) -> str:
        return "/".join((self.identity, self.status, self.name))

    @classmethod
    def parse(cls, text: str) -> "TableName":
        identity, status, name = text.split(cls.SEPARATOR, 2)
        return cls(name, identity, status)


def suffix(name: str) -> str:
    """What follows the second separator; names with fewer parts keep their last part."""
    return name.split(TableName.SEPARATOR, 2)[-1]


def names_in_stage(names: Sequence[str], identity: str, status: str) -> list[str]:
    """Names that start with ``identity``, one separator, ``status``, one separator and a letter or digit."""
    stage = re.compile(rf"^{re.escape(identity)}\W{re.escape(status)}\W[^\W_]")
    return [n for n in names if stage.search(n)]


def map_tables(tables: Mapping[str, DataFrame], step: Callable[..., DataFrame], *args, **kwargs) -> Tables:
    """Apply one operator to every table of a family."""
    return {name: step(df, *args, **kwargs) for name, df in tables.items()}


def read_table(spark: SparkSession, path: str, promote: bool = False, zone: str | None = None) -> DataFrame:
    """One parquet table; ``promote`` turns text columns that are all dates into timestamps (one job)."""
    df = spark.read.parquet(path)
    return promote_dates(df, zone=zone) if promote else df


def list_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """Name to path of the parquet tables directly below ``root``, from the file system Spark uses."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = {}
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            found[re.sub(r"\.parquet$", "", name)] = status.getPath().toString()
    return dict(sorted(found.items()))


def read_tables(spark: SparkSession, root: str, pattern: str = "", promote: bool = False) -> Tables:
    """All tables below ``root`` whose name matches the case-insensitive pattern, keyed by name suffix."""
    wanted = re.compile(pattern, re.IGNORECASE)
    return {
        suffix(name): read_table(spark, path, promote)
        for name, path in list_tables(spark, root).items()
        if wanted.search(name)
    }


def read_catalog_tables(spark: SparkSession, pattern: str = "", database: str | None = None) -> Tables:
    """Like :func:`read_tables`, over the session catalog."""
    wanted = re.compile(pattern, re.IGNORECASE)
    names = [t.name for t in spark.catalog.listTables(database) if wanted.search(t.name)]
    prefix = f"`{database}`." if database else ""
    return {suffix(n): spark.table(f"{prefix}`{n}`") for n in names}


def tables_with_column(tables: Mapping[str, DataFrame], column: str) -> list[str]:
    """Names of the tables that have the column; schema only, no job."""
    return [name for name, df in tables.items() if column in df.columns]


def feature_catalog(
    blocks: Mapping[str, DataFrame], dropped: Mapping[str, Sequence[str]], key: Sequence[str] = DEFAULT_KEY
) -> list[str]:
    """Qualified feature names ``block.column`` without key and dropped columns; schema only, no job."""
    names = []
    for block, df in blocks.items():
        leave_out = {*key, *(dropped.get(block) or ())}
        names += [f"{block}.{c}" for c in df.columns if c not in leave_out]
    return sorted(names)


# Texts that stand for a missing value in CSV input.
NA_TOKENS = ("NA", "N/A", "null", "")


def read_csv_na(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str,
    na_tokens: Sequence[str] = NA_TOKENS,
    keep: Sequence[str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """CSV with a header and a declared schema; any of ``na_tokens`` is NULL in every column.

    Columns are read as text, cleared of the tokens and cast, so the CSV reader prunes unselected columns.
    A value that does not fit its declared type is NULL.
    """
    fields = (T.StructType.fromDDL(schema) if isinstance(schema, str) else schema).fields
    text = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
    raw = spark.read.csv(path, header=True, schema=text, quote='"', escape='"', enforceSchema=False)
    chosen = [f for f in fields if (keep is None or f.name in keep) and f.name not in drop]
    return raw.select(
        *[
            F.when(~F.col(f"`{f.name}`").isin(list(na_tokens)), F.col(f"`{f.name}`").try_cast(f.dataType)).alias(
                f.name
            )
            for f in chosen
        ]
    )


def header_schema(spark: SparkSession, path: str) -> T.StructType:
    """The columns of a CSV's header as text; reads the header only."""
    header = spark.read.csv(path, header=True, quote='"', escape='"')
    return T.StructType([T.StructField(c, T.StringType()) for c in header.columns])


def read_csv_folder(
    spark: SparkSession, root: str, schemas: Mapping[str, T.StructType | str] | None = None, undeclared: str = "text", **options
) -> Tables:
    """One table per CSV file or folder below ``root``, named by the file without ``.csv``.

    A file without a schema is read with its header's columns as text; ``undeclared`` may be ``skip`` or ``error``
    instead. A schema without a file is an error.
    """
    if undeclared not in ("text", "skip", "error"):
        raise ValueError("undeclared must be 'text', 'skip' or 'error'")
    schemas = schemas or {}
    found = {re.sub(r"\.csv$", "", n): p for n, p in list_tables(spark, root).items()}
    if missing := sorted(set(schemas) - set(found)):
        raise FileNotFoundError(f"no files for {', '.join(missing)}")
    others = sorted(set(found) - set(schemas))
    if others and undeclared == "error":
        raise ValueError(f"no schemas for {', '.join(others)}")
    out = {n: read_csv_na(spark, found[n], schema, **options) for n, schema in schemas.items()}
    if undeclared == "text":
        out |= {n: read_csv_na(spark, found[n], header_schema(spark, found[n]), **options) for n in others}
    return out


def stack_columns(tables: Mapping[str, DataFrame], columns: Sequence[str]) -> DataFrame:
    """The chosen columns of many tables as one table; a column a table lacks is NULL there."""
    parts = [df.select(*[c for c in columns if c in df.columns]) for df in tables.values()]
    return stack_rows(*parts)


def stack_rows(*parts: DataFrame) -> DataFrame:
    """Row bind with the union of the columns."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
