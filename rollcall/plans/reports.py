"""Reports on scores and decisions: risk buckets, back-tests, threshold policies, subgroups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.rules import if_known, in_set, threshold_policy
from rollcall.functions.values import share
from rollcall.operators.ordered import group_join, quantiles
from rollcall.operators.people import ntile_bucket
from rollcall.operators.profile import bin2d, group_quantiles
from rollcall.operators.tabulate import crosstab_wide, part_of


def risk_buckets(df: DataFrame, best: str, worst: str, n: int, tie: Sequence[str], name: str = "risk_bucket") -> DataFrame:
    """Bucket 1 to ``n`` by the score difference, ties by key (runs jobs)."""
    scored = df.withColumn("difference__", F.col(best) - F.col(worst))
    return ntile_bucket(scored, ["difference__", *tie], n, name).drop("difference__")


def bucket_report(
    df: DataFrame, bucket: str, scores: Sequence[str], flags: Mapping[str, str], digits: int = 2
) -> DataFrame:
    """Per bucket: score quartiles, rows, and for each flag its count ``num_`` and share ``pct_``."""
    columns = [F.count(F.lit(1)).alias("total")]
    for name, flag in flags.items():
        columns += [F.sum(F.col(flag).cast("int")).alias(f"num_{name}"), share(F.col(flag)).alias(f"pct_{name}")]
    out = df.groupBy(bucket).agg(*columns)
    for s in scores:
        cuts = quantiles(df, s, {f"p25_{s}": 0.25, f"p75_{s}": 0.75}, [bucket])
        rounded = cuts.select(bucket, *[F.round(c, digits).alias(c) for c in (f"p25_{s}", f"p75_{s}")])
        out = group_join(out, rounded, [bucket], "left")
    return out


def backtest(
    df: DataFrame,
    bucket: str,
    screened: Sequence[int],
    always: int,
    interviewed: str,
    accepted: str,
    enrolled: str,
) -> DataFrame:
    """Per bucket: what happened, and what would have if only ``screened`` buckets had been reviewed.

    Bucket ``always`` would have been interviewed without a review; the others not at all. Each later step
    needs the one before.
    """
    screen = in_set(bucket, screened).cast("int")
    interview = F.when(screen == 1, F.col(interviewed).cast("int")).otherwise((F.col(bucket) == always).cast("int"))
    accept = F.when(interview == 1, F.col(accepted).cast("int")).otherwise(F.lit(0))
    enrol = F.when(accept == 1, F.col(enrolled).cast("int")).otherwise(F.lit(0))
    columns = [F.count(F.lit(1)).alias("total")]
    for name, flag in (("interviewed", interviewed), ("accepted", accepted), ("matriculated", enrolled)):
        columns += [F.sum(F.col(flag).cast("int")).alias(f"num_{name}"), share(F.col(flag)).alias(f"pct_{name}")]
    columns += [
        F.sum(screen).alias("num_screened_model"),
        F.sum(interview).alias("num_interview_model"),
        F.sum(accept).alias("num_accepted_model"),
        F.sum(enrol).alias("num_matriculated_model"),
    ]
    return df.groupBy(bucket).agg(*columns)


def payoff(buckets: DataFrame) -> DataFrame:
    """Totals of :func:`backtest` over all buckets, as it was and by the model."""
    pairs = {
        "n_screened_old": "total",
        "n_screened_model": "num_screened_model",
        "n_interviewed_old": "num_interviewed",
        "n_interviewed_model": "num_interview_model",
        "n_accepted_old": "num_accepted",
        "n_accepted_model": "num_accepted_model",
        "n_matriculated_old": "num_matriculated",
        "n_matriculated_model": "num_matriculated_model",
    }
    return buckets.agg(*[F.sum(c).alias(name) for name, c in pairs.items()])


def score_by_outcome(df: DataFrame, score: str, outcome: str) -> DataFrame:
    """Mean and exact quartiles of the score per outcome."""
    return group_quantiles(df, score, outcome)


def threshold_totals(df: DataFrame, score: str, invited: str, offered: str, lower: float, upper: float) -> DataFrame:
    """One row: how many were screened, interviewed and offered, actually and by the policy."""
    policy = threshold_policy(F.col(score), F.col(invited), F.col(offered), lower, upper)

    def total(c: Column) -> Column:
        return F.sum(c.cast("int"))

    return df.agg(
        F.count(F.lit(1)).alias("actual_screened"),
        total(policy["model_screen"]).alias("model_screened"),
        total(policy["automatic_reject"]).alias("automatic_reject"),
        total(F.col(invited)).alias("actual_interviewed"),
        total(policy["model_interview"]).alias("model_interviewed"),
        total(policy["automatic_invited"]).alias("automatic_invited"),
        total(F.col(offered)).alias("actual_offered"),
        total(policy["model_offer"]).alias("model_offered"),
    )


def threshold_groups(
    df: DataFrame, score: str, invited: str, outcome: str, classes: Sequence[str], lower: float, upper: float
) -> DataFrame:
    """Per decision of the policy: rows, actual invitation rate and the share of each outcome class."""
    s = F.col(score)
    decision = F.when(s < lower, "automatic_reject").when(s > upper, "automatic_invited").otherwise("screened")
    return (
        df.groupBy(decision.alias("decision"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            share(F.col(invited)).alias("pct_invited"),
            *[share(F.col(outcome) == c).alias(f"pct_{c}") for c in classes],
        )
    )


def decision_slice(df: DataFrame, rows: str, columns: str, values: Sequence, condition: Column) -> DataFrame:
    """One slice of a three-way contingency table."""
    return crosstab_wide(df, rows, columns, values, condition)


def auto_reject(
    df: DataFrame, protected: Column, bucket: str, reject_buckets: tuple[int, int], name: str = "predicted_status"
) -> DataFrame:
    """``automatic_reject`` for unprotected rows in the low buckets, else ``further_review``; unknown stays NULL."""
    low = F.col(bucket).between(*reject_buckets) & ~protected
    return df.withColumn(name, if_known(low, F.lit("automatic_reject"), F.lit("further_review")))


def subgroup_profile(
    df: DataFrame, by: str, category: str, values: tuple[str, str], means: Sequence[str], digits: int = 2
) -> DataFrame:
    """Rows, the two shares of a category among its two values, and means that skip NULL."""
    one, two = (F.col(category) == v for v in values)
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("total"),
        F.round(part_of(one, two), digits).alias(f"fra_{values[0].lower()}"),
        F.round(part_of(two, one), digits).alias(f"fra_{values[1].lower()}"),
        *[F.round(F.avg(c), digits).alias(f"{c}_average") for c in means],
    )


def compare_scores(
    a: DataFrame, b: DataFrame, score_a: str, score_b: str, width: float, key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """Counts on a grid of two models' scores for the same keys."""
    return bin2d(a.join(b, list(key), "left"), score_a, score_b, width, width)


