"""Writers, and the stored-table changes (update, delete, rename, retype) as rewrites to a new path."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from rollcall.operators.columns import fix_colnames
from rollcall.operators.ordered import null_safe_semi
from rollcall.session import settle


def booleans_to_int(df: DataFrame) -> DataFrame:
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(f"`{c}`").cast("int") for c in flags}) if flags else df


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write parquet with flags as 0/1 integers."""
    booleans_to_int(df).write.mode(mode).parquet(path)


def write_tables(tables: Mapping[str, DataFrame], root: str, mode: str = "overwrite") -> None:
    for name, df in tables.items():
        write_table(df, f"{root.rstrip('/')}/{name}", mode)


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """CSV with a header. ``one_file`` is for small reports only: it makes one task write everything."""
    out = df.coalesce(1) if one_file else df
    out.write.mode("overwrite").csv(path, header=True, quote='"', escape='"')


def write_split(df: DataFrame, band: str, root: str, year: str, key: Sequence[str] = ()) -> dict[str, list[str]]:
    """One CSV folder per band, newest year first, without the columns that are empty in that band.

    One aggregate finds the empty columns of all bands. Rows are range-partitioned on the year and key within
    each band, so a large band is written by many tasks; the files of a folder are ordered by their number.
    An empty band goes to the folder ``rest``, NULL to ``unknown``. Returns the columns written per band.
    """
    others = [c for c in df.columns if c != band]
    filled = df.groupBy(band).agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in others])
    written: dict[str, list[str]] = {}
    for row in filled.collect():  # one row per band
        columns = [c for c in others if row[c] > 0] or others[:1]  # rows without any value stay rows
        part = df.filter(F.col(band).eqNullSafe(F.lit(row[band]))).select(*[F.col(f"`{c}`") for c in columns])
        part = fix_colnames(part)
        order = [F.col(year).desc(), *[F.col(k) for k in key]] if year in part.columns else []
        if order:
            part = part.repartitionByRange(*order).sortWithinPartitions(*order)
        name = "unknown" if row[band] is None else str(row[band]) or "rest"
        if name in written:
            raise ValueError(f"two bands would be written to {name}")
        write_csv(part, f"{root.rstrip('/')}/{name}")
        written[name] = part.columns
    return written


def append_results(train: DataFrame, test: DataFrame, algorithm_id: int, path: str) -> None:
    """Append scored training and test rows, tagged with their set and model."""
    both = train.withColumn("set", F.lit("train")).unionByName(
        test.withColumn("set", F.lit("test")), allowMissingColumns=True
    )
    both.withColumn("algorithm_id", F.lit(algorithm_id).cast("long")).write.mode("append").partitionBy(
        "algorithm_id"
    ).parquet(path)


def replace_partitions(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """Overwrite only the partitions present in ``df``; running it twice changes nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(path)


def update_rows(df: DataFrame, condition: Column, values: Mapping[str, Column | object]) -> DataFrame:
    """``UPDATE ... SET ... WHERE``: rows for which the condition is unknown stay as they are."""
    new = {
        c: F.when(condition, v if isinstance(v, Column) else F.lit(v)).otherwise(F.col(f"`{c}`"))
        for c, v in values.items()
    }
    return df.withColumns(new)


def delete_rows(df: DataFrame, condition: Column) -> DataFrame:
    """``DELETE ... WHERE``: rows for which the condition is unknown stay."""
    return df.filter(~F.coalesce(condition, F.lit(False)))


def _rewrite(df: DataFrame, path: str, condition: Column, change, partitions: Sequence[str]) -> int:
    hit = df.filter(condition)
    if not partitions:
        n = hit.count()
        if n:
            settle(change(df)).write.mode("overwrite").parquet(path)
        return n
    touched = hit.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n__")).collect()  # one row per touched partition
    if not touched:
        return 0
    keys = df.sparkSession.createDataFrame([tuple(r[p] for p in partitions) for r in touched], df.select(*partitions).schema)
    kept = settle(change(null_safe_semi(df, F.broadcast(keys), partitions)))
    replace_partitions(kept, path, partitions)
    # a partition that lost its last row is not among those that were replaced
    left = {tuple(r) for r in kept.select(*partitions).distinct().collect()}
    for r in touched:
        if tuple(r[p] for p in partitions) not in left:
            _drop_partition(df.sparkSession, path, {p: r[p] for p in partitions})
    return sum(r["n__"] for r in touched)


def _drop_partition(spark: SparkSession, path: str, values: Mapping[str, object]) -> None:
    # Spark's writers name partition folders this way
    folders = ["__HIVE_DEFAULT_PARTITION__" if v is None else str(v) for v in values.values()]
    if any(not re.fullmatch(r"[\w.\- ]+", f) for f in folders):
        raise ValueError(f"no plain folder name for the partition {dict(values)}")
    folder = spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *[f"{k}={f}" for k, f in zip(values, folders)]]))
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def update_table(
    spark: SparkSession, path: str, schema: str | T.StructType, condition: Column, values: Mapping[str, Column | object], partitions: Sequence[str] = ()
) -> int:
    """``UPDATE`` of a stored table in place; returns the number of rows that met the condition.

    Only the partitions that hold such rows are rewritten, from a copy that is complete in the shared folder before the
    first file is replaced, so a lost executor costs a task. The table has a single writer. Partition columns stay as
    they are.
    """
    if clash := sorted(set(values) & set(partitions)):
        raise ValueError(f"partition columns cannot be updated: {', '.join(clash)}")
    df = spark.read.schema(schema).parquet(path)
    return _rewrite(df, path, condition, lambda rows: update_rows(rows, condition, values), partitions)


def delete_from_table(spark: SparkSession, path: str, schema: str | T.StructType, condition: Column, partitions: Sequence[str] = ()) -> int:
    """``DELETE`` from a stored table in place, as :func:`update_table` does it; returns the number of rows deleted."""
    df = spark.read.schema(schema).parquet(path)
    return _rewrite(df, path, condition, lambda rows: delete_rows(rows, condition), partitions)


def alter_columns(
    df: DataFrame,
    rename: Mapping[str, str] | None = None,
    retype: Mapping[str, str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Drop, retype (by old name) and rename columns in one projection."""
    retype, rename = retype or {}, rename or {}
    return df.select(
        *[
            (F.col(f"`{c}`").cast(retype[c]) if c in retype else F.col(f"`{c}`")).alias(rename.get(c, c))
            for c in df.columns
            if c not in drop
        ]
    )


def rename_table(spark: SparkSession, old: str, new: str) -> None:
    """Rename a catalog table."""
    spark.sql(f"ALTER TABLE `{old}` RENAME TO `{new}`")
