"""Feature tables built from record tables, and the matrix that joins them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.rules import differs, not_in_set
from rollcall.operators.features import bucket_counts_by, level_block, level_trend
from rollcall.operators.people import latest
from rollcall.operators.relational import in_keys, star_join
from rollcall.sources.sinks import write_table
from rollcall.sources.tables import TableName, list_tables, names_in_stage, stack_rows


def trend_pairs(prefix: str, levels: Sequence[str], names: Sequence[str]) -> dict[str, tuple[str, str]]:
    """Each level against the one before: ``{prefix_name_higher: (level, previous level)}``."""
    return {
        f"{prefix}_{name}_higher": (levels[i + 1], levels[i]) for i, name in enumerate(names)
    }


def grade_point_features(
    df: DataFrame,
    level: str,
    excluded: str,
    overall: tuple[str, Sequence[str]],
    later: tuple[str, str, Sequence[str]],
    further: tuple[str, str, str],
    values: Mapping[str, Mapping[str, tuple[str, str]]],
    levels: Sequence[str],
    hours: float,
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Averages of the overall level, of a later level, trends over levels and two attendance flags.

    ``overall`` is (level value, columns); ``later`` is (level value, hours column, further columns);
    ``further`` is (level value, hours column, flag name). ``values`` maps a value column to its trend pairs.
    A person with at least ``hours`` in the later or further level gets its flag; a missing level gives 0.
    """
    rows = df.filter(differs(level, excluded))
    base = level_block(rows, level, overall[0], overall[1], "cumulative", key)
    later_value, later_hours, later_columns = later
    second = level_block(rows, level, later_value, [later_hours, *later_columns], "later", key)
    third = level_block(rows, level, further[0], [further[1]], "further", key)
    blocks = {"later": second, "further": third}
    for column, pairs in values.items():
        blocks[column] = level_trend(rows, level, column, levels, pairs, key)
    joined = star_join(base, blocks, key, unique=False)
    attended = {
        "did_later": (F.col(f"{later_hours}_later") >= hours).cast("int"),
        further[2]: (F.col(f"{further[1]}_further") >= hours).cast("int"),
    }
    filled = {"did_later": 0, further[2]: 0, **{f"{c}_later": 0 for c in later_columns if "hours" in c}}
    return joined.withColumns(attended).fillna(filled).drop(f"{later_hours}_later", f"{further[1]}_further")


def latest_score_features(
    older: DataFrame,
    newer: DataFrame,
    older_names: Mapping[str, str],
    newer_names: Mapping[str, str],
    person: str,
    date: str,
    tie: Sequence[str] = (),
    ties: str = "first",
) -> DataFrame:
    """The latest test per person over an old and a new form of the test, with the number of tests taken."""
    parts = [
        df.select(*[F.col(old).alias(new) for old, new in names.items()]).withColumn("form", F.lit(form))
        for df, names, form in ((older, older_names, "old"), (newer, newer_names, "new"))
    ]
    return latest(stack_rows(*parts), person, date, tie, ties, count="n_tests").drop(date)


def grade_count_features(
    df: DataFrame,
    level: str,
    excluded: Sequence[str],
    science: str,
    code: str,
    buckets: Mapping[str, Sequence[str]],
    by: str,
    by_values: Sequence[str],
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Grade counts per class and overall for keys with any science record; rows without a level stay."""
    rows = df.filter(not_in_set(level, excluded)).filter(F.col(science) == 1)
    return bucket_counts_by(rows, code, buckets, by, by_values, "science", key)


def design_matrix(
    outcome: DataFrame, blocks: Mapping[str, DataFrame], key: Sequence[str] = DEFAULT_KEY, unique: bool = True
) -> DataFrame:
    """Outcome rows with all feature blocks; a row without features keeps NULL there."""
    return star_join(outcome, blocks, key, unique)


def feature_blocks(
    tables: Mapping[str, DataFrame],
    features: Mapping[str, Sequence[str]],
    keys: DataFrame | None = None,
    key: Sequence[str] = DEFAULT_KEY,
) -> dict[str, DataFrame]:
    """The blocks of a specification without their left-out columns, optionally for some keys only.

    Blocks that are left-joined to their keys afterwards need no ``keys`` here; it would join them twice.
    """
    chosen = {b: tables[b].drop(*dropped) for b, dropped in features.items()}
    return chosen if keys is None else {b: in_keys(df, keys, key) for b, df in chosen.items()}


def outcome_matrices(
    spark: SparkSession,
    root: str,
    feature_sets: Mapping[str, Sequence[str]],
    key: Sequence[str] = DEFAULT_KEY,
    identity: str = "deidentified",
    outcomes: str = "outcome",
    features: str = "generated",
    made: str = "model_data",
    unique: bool = True,
) -> list[str]:
    """One stored matrix for each outcome table and feature set; returns their names, ``outcome_set`` in the stage ``made``.

    Outcome and feature tables are those below ``root`` whose names lie in their stages. ``feature_sets`` says by the
    set's name which feature tables it leaves out. A table that is named but not there is an error, and so is a stage
    without tables.
    """
    paths = list_tables(spark, root)
    targets, blocks = (names_in_stage(list(paths), identity, status) for status in (outcomes, features))
    if not targets or not blocks:
        raise FileNotFoundError(f"no tables in the stage {outcomes if not targets else features}")
    named = {TableName.parse(n).name: spark.read.parquet(paths[n]) for n in blocks}
    if unknown := sorted({b for left_out in feature_sets.values() for b in left_out} - set(named)):
        raise KeyError(f"no feature tables named {', '.join(unknown)}")
    written = []
    for target in targets:
        rows = spark.read.parquet(paths[target])
        for name, left_out in feature_sets.items():
            chosen = {b: df for b, df in named.items() if b not in left_out}
            out = TableName(f"{TableName.parse(target).name}_{name}", identity, made)
            write_table(design_matrix(rows, chosen, key, unique), f"{root.rstrip('/')}/{out}")
            written.append(str(out))
    return written
