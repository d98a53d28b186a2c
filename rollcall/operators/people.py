"""First, last and latest rows per person, and ranks over the whole table.

Per-person work is grouping followed by a join, not a window: groups shrink on the map side and adaptive
execution splits the join, so a person with a third of all rows does not end in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollcall.operators.ordered import at_or_after, group_join, null_safe_semi, rows_at_ranks, values_at_ranks


def _edge_rows(df: DataFrame, person: str, year: str, first: int, last: int, edge) -> DataFrame:
    within = df.filter(F.col(year).between(first, last))
    edges = within.groupBy(person).agg(edge(year).alias(year))
    return null_safe_semi(within, edges, [person, year])


def first_rows(df: DataFrame, person: str, year: str, first: int, last: int) -> DataFrame:
    """All rows of each person's earliest year within the range; rows without a person are one person's."""
    return _edge_rows(df, person, year, first, last, F.min)


def last_rows(df: DataFrame, person: str, year: str, first: int, last: int) -> DataFrame:
    """All rows of each person's latest year within the range; rows without a person are one person's."""
    return _edge_rows(df, person, year, first, last, F.max)


def latest(
    df: DataFrame,
    person: str,
    date: str,
    tie: Sequence[str] = (),
    ties: str = "first",
    count: str | None = None,
) -> DataFrame:
    """The row with the latest date of each person; rows without a date come last.

    ``ties="first"`` keeps, among rows of the same date, the one with the smallest ``tie`` columns (these must
    be numeric). ``ties="drop"`` leaves out persons with several rows on their latest date. ``count`` names an
    extra column with the person's number of rows.
    """
    others = [c for c in df.columns if c != person]
    row = F.struct(*[F.col(f"`{c}`") for c in others])
    size = F.count(F.lit(1)).alias("size__")
    if ties == "first":
        order = F.struct(F.col(date), *[-F.col(t) for t in tie])
        picked = df.groupBy(person).agg(F.max_by(row, order).alias("row__"), size)
    elif ties == "drop":
        per_date = df.groupBy(person, date).agg(F.max(row).alias("row__"), F.count(F.lit(1)).alias("n__"))
        picked = (
            per_date.groupBy(person)
            .agg(
                F.max_by(F.struct("row__", "n__"), F.struct(F.col(date))).alias("top__"),
                F.sum("n__").alias("size__"),
            )
            .filter("top__.n__ = 1")
            .select(person, "top__.row__", "size__")
        )
    else:
        raise ValueError("ties must be 'first' or 'drop'")
    extra = [F.col("size__").alias(count)] if count else []
    return picked.select(person, "row__.*", *extra)


def with_group_size(df: DataFrame, by: Sequence[str], name: str = "n_rows") -> DataFrame:
    """Number of rows of the group beside each row; NULL is a group of its own."""
    return group_join(df, df.groupBy(*by).agg(F.count(F.lit(1)).alias(name)), by)


def rank_bands(df: DataFrame, column: str, cuts: Sequence[float], name: str = "band") -> DataFrame:
    """Band 0, 1, ... by percent rank: band i ends at percent rank ``cuts[i]``. NULL values leave (runs jobs).

    The percent rank of a value is at most c just if the value is at most the one at rank c * (n - 1), so a
    few cut-off values replace a ranking of all rows.
    """
    known = df.filter(F.col(column).isNotNull())
    ranks = {str(i): (lambda n, c=c: F.floor((n - 1) * F.lit(float(c)))) for i, c in enumerate(cuts)}
    found = {r["rank_name"]: r[column] for r in values_at_ranks(known, column, ranks).collect()}
    out = F.lit(len(cuts))
    for i in reversed(range(len(cuts))):
        if str(i) in found:
            out = F.when(F.col(column) <= F.lit(found[str(i)]), F.lit(i)).otherwise(out)
    return known.withColumn(name, out)


def ntile_bucket(df: DataFrame, order: Sequence[str], n: int, name: str = "bucket") -> DataFrame:
    """Bucket 1 to ``n`` of equal size in the order of ``order``, the first ones larger by one (runs jobs).

    Only the n - 1 rows at the bucket starts are looked up; every other row is compared with them. ``order``
    must end with columns that make it unique.
    """

    def start(j: int):
        return lambda total: F.floor(total / n) * j + F.least(F.lit(j), total % n)

    cuts = rows_at_ranks(df, order, {str(j): start(j) for j in range(1, n)})
    bucket = F.lit(1)
    for row in cuts:
        bucket = bucket + at_or_after(order, row).cast("int")
    return df.withColumn(name, bucket)


def top_k_label(df: DataFrame, score: str, k: float, name: str = "label") -> DataFrame:
    """1 for scores above the cut-off that leaves about k of the rows positive, else 0 (runs jobs).

    ``k`` below 1 is a share, from 1 on a percentage. The cut-off is the score at position int(n * k) of the
    descending order and comparison is strict, so ties at the cut-off give fewer positives. ``k=100`` makes
    every row positive.
    """
    part = k / 100.0 if k >= 1 else k
    if part >= 1:
        return df.withColumn(name, F.lit(1))
    found = values_at_ranks(df, score, {"cut": lambda n: n - 1 - F.floor(n * F.lit(part))}).collect()
    if not found:
        return df.withColumn(name, F.lit(0))
    above = F.col(score) > F.lit(found[0][score])
    return df.withColumn(name, F.coalesce(above.cast("int"), F.lit(0)))
