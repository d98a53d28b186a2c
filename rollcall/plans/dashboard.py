"""Score dashboard: production scores, enrichment, band table, cycle projection."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall import DEFAULT_KEY
from rollcall.functions.values import band, net_score, safe_ratio, share
from rollcall.operators.relational import star_join
from rollcall.operators.tabulate import ALL, count_between, crosstab_shares, with_all
from rollcall.plans.registry import only_production

# The band labels, lowest first.
BANDS = ("Reject", "Hold", "Invite")


def current_scores(predictions: DataFrame, registry: DataFrame, key: Sequence[str] = DEFAULT_KEY) -> DataFrame:
    return only_production(predictions, registry).select(*key, "score")


def historic_scores(
    predictions: DataFrame,
    registry: DataFrame,
    best: str = "predicted_invite",
    worst: str = "predicted_reject",
    key: Sequence[str] = DEFAULT_KEY,
) -> DataFrame:
    """Held-out scores of production models with the true outcome."""
    held_out = only_production(predictions.filter(F.col("set") == "test"), registry)
    return held_out.select(*key, net_score(best, worst).alias("score"), "outcome")


def enrich(
    scores: DataFrame,
    blocks: Mapping[str, DataFrame],
    defaults: Mapping[str, object] | None = None,
    key: Sequence[str] = DEFAULT_KEY,
    unique: bool = True,
) -> DataFrame:
    """Left-join person attributes; ``defaults`` fill what is missing after the join."""
    out = star_join(scores, blocks, key, unique)
    return out.fillna(dict(defaults)) if defaults else out


def historic_outcomes(
    scores: DataFrame, records: DataFrame, flags: Sequence[str], status: str, prefixes: Sequence[str], key: Sequence[str] = DEFAULT_KEY
) -> DataFrame:
    """All held-out scores with what happened; enrolled if the first letter of the status is one of ``prefixes``."""
    enrolled = F.substring(F.col(status), 1, 1).isin(list(prefixes)).alias("is_matriculated")
    return records.select(*key, *flags, enrolled).join(scores, list(key), "right")


def banded(df: DataFrame, lower: float, upper: float, score: str = "score") -> DataFrame:
    return df.withColumn("predicted_outcome", band(score, lower, upper, BANDS))


def band_table(
    df: DataFrame, flags: Mapping[str, Column], lower: float, upper: float, digits: int = 3, dedup: bool = True
) -> DataFrame:
    """Rows, flag counts and flag shares per predicted band and overall."""
    return crosstab_shares(banded(df, lower, upper), "predicted_outcome", flags, digits, dedup)


def screening_counts(current: DataFrame, lower: float, upper: float, dedup: bool = True) -> DataFrame:
    rows = banded(current, lower, upper)
    return with_all(
        rows,
        "predicted_outcome",
        [F.count(F.lit(1)).alias("total"), count_between(F.col("score"), lower, upper).alias("n_screenings")],
        dedup,
    )


def historic_rates(
    historic: DataFrame, invited: str, offered: str, enrolled: str, lower: float, upper: float, dedup: bool = True
) -> DataFrame:
    """Rates per band and overall: invited, accepted, enrolled, and the last two among the invited."""
    flags = {"i": invited, "o": offered, "e": enrolled}
    rows = banded(historic, lower, upper)

    def total(c: str) -> Column:
        return F.sum(F.col(c).cast("int"))

    columns = [
        share(F.col(flags["i"])).alias("invited"),
        share(F.col(flags["o"])).alias("accepted"),
        share(F.col(flags["e"])).alias("matriculated"),
        F.count(F.lit(1)).alias("hist_total"),
        safe_ratio(total(flags["o"]), total(flags["i"])).alias("accepted_if_invited"),
        safe_ratio(total(flags["e"]), total(flags["i"])).alias("matriculated_if_invited"),
    ]
    return with_all(rows, "predicted_outcome", columns, dedup)


def project_cycle(rates: DataFrame, counts: DataFrame, digits: int = 3) -> DataFrame:
    """Expected invitations, acceptances and enrolments of the current cycle.

    Invitations: none in the lowest band, all in the highest, the historic rate in the middle. The row ``All``
    holds the sums of the others. Inputs have one row per band.
    """
    label = F.col("predicted_outcome")
    expected = (
        F.when(label == BANDS[0], F.lit(0.0))
        .when(label == BANDS[1], F.round(F.col("invited") * F.col("total")))
        .when(label == BANDS[2], F.col("total").cast("double"))
    )
    joined = rates.join(counts, ["predicted_outcome"], "left").withColumn("n_invites", expected)
    details = joined.withColumns(
        {
            "projected_accepted": F.round(F.col("accepted_if_invited") * F.col("n_invites")),
            "projected_matriculated": F.round(F.col("matriculated_if_invited") * F.col("n_invites")),
        }
    )
    sums = details.agg(
        *[F.sum(c).alias(f"sum_{c}") for c in ("n_invites", "projected_accepted", "projected_matriculated")]
    )
    # the row of sums meets the one row All by an equality join
    whole = sums.withColumn("predicted_outcome", F.lit(ALL))
    out = details.join(whole, ["predicted_outcome"], "left")

    def filled(c: str) -> Column:
        return F.when(label == ALL, F.col(f"sum_{c}")).otherwise(F.col(c))

    return out.select(
        "predicted_outcome",
        F.round(safe_ratio(filled("n_invites"), F.col("total")), digits).alias("pct_applicants_invited"),
        "n_screenings",
        filled("n_invites").alias("n_invites"),
        *[F.round(c, digits).alias(f"historic_{c}") for c in ("invited", "accepted", "matriculated")],
        "hist_total",
        *[F.round(c, digits).alias(f"historic_{c}") for c in ("accepted_if_invited", "matriculated_if_invited")],
        filled("projected_accepted").alias("projected_accepted"),
        filled("projected_matriculated").alias("projected_matriculated"),
    )
