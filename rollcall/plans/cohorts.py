"""Who is eligible, who belongs to which cohort, who still waits for a score."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.rules import any_of, in_set, only_latest
from rollcall.operators.people import first_rows
from rollcall.operators.relational import in_keys, not_yet_in
from rollcall.plans.registry import only_production
from rollcall.plans.spec import ModelSpec


def eligible(
    records: DataFrame,
    eligibility: DataFrame,
    reasons: Sequence[Column],
    required: Sequence[Column],
    year: str,
    key: Sequence[str] = DEFAULT_KEY,
    income: DataFrame | None = None,
    income_on: Column | None = None,
    added: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Records of the latest year that meet all requirements and at least one reason to be eligible.

    ``eligibility`` holds flags per key; ``income`` is an optional lookup joined on an expression. The latest
    year is taken over all records, before any filter.
    """
    rows = only_latest(records, year)
    if income is not None:
        rows = rows.join(income, income_on, "left")
    rows = rows.join(eligibility, list(key), "inner")
    for condition in required:
        rows = rows.filter(condition)
    return rows.filter(any_of(*reasons)).withColumns(dict(added or {}))


def unsent(
    scores: DataFrame, eligible_rows: DataFrame, registry: DataFrame, sent: DataFrame, key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """Scores of production models for eligible records that were not delivered yet."""
    current = only_production(in_keys(scores, eligible_rows, key), registry)
    return not_yet_in(current, sent, key)


def cohort_labels(df: DataFrame, first: Column, second: Column, names: tuple[str, str], key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Text labels of two flags and of their combination; an unknown flag counts as false."""
    a, b = any_of(first), any_of(second)
    one, two = names
    pair = (
        F.when(a & b, f"{one} + {two}")
        .when(a, f"{one} not {two}")
        .when(b, f"{two} not {one}")
        .otherwise(f"neither {one} nor {two}")
    )
    return df.select(
        *key,
        F.when(a, one).otherwise(f"not {one}").alias(one),
        F.when(b, f"is {two}").otherwise(f"not {two}").alias(two),
        pair.alias(f"{one}_{two}"),
    )


def fit_and_predict(fit: DataFrame, predict: DataFrame) -> DataFrame:
    """Training and scoring cohorts in one table, equal rows once."""
    tagged = fit.withColumn("fit_or_predict", F.lit("fit"))
    return tagged.unionByName(predict.withColumn("fit_or_predict", F.lit("predict"))).distinct()


def first_eligible(records: DataFrame, person: str, year: str, years: tuple[int, int], rules: Sequence[Column]) -> DataFrame:
    """Training population: rows that meet the rules, of each person's first such year in the range."""
    rows = records
    for rule in rules:
        rows = rows.filter(rule)
    return first_rows(rows, person, year, *years)


def cohort_keys(cohorts: DataFrame, spec: ModelSpec, phase: str, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    """Keys of the specification's cohort for ``fit`` or ``predict``."""
    member = F.col(spec.cohort_column).isin(list(spec.cohort_values)) & (F.col("fit_or_predict") == phase)
    return cohorts.filter(member).select(*key).distinct()


def not_scored_yet(
    population: DataFrame,
    cohort: DataFrame,
    predictions: DataFrame,
    algorithm_id: int,
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Keys of the population in the cohort that this model has not scored."""
    done = predictions.filter(F.col("algorithm_id") == algorithm_id)
    return not_yet_in(in_keys(population.select(*key).distinct(), cohort, key), done, key)


def program_population(df: DataFrame, action: str, wanted: Sequence[str], program: str, excluded: Sequence[str]) -> DataFrame:
    """Rows with a wanted final action outside the excluded programs; an unknown program leaves too."""
    return df.filter(in_set(action, wanted)).filter(~F.col(program).isin(list(excluded)))
