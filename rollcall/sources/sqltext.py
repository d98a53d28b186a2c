"""Parameterised SQL text and scalar parameters taken from data."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None, **views: DataFrame) -> DataFrame:
    """Run SQL with named parameters (``:name``, ``IDENTIFIER(:name)``) over frames given as views.

    Parameters are bound by Spark and never pasted into the text.
    """
    return spark.sql(text, args=dict(args or {}), **views)


def scalar(df: DataFrame) -> Column:
    """A one-row, one-column frame as a scalar subquery; no job on the driver."""
    return df.scalar()


def as_view(df: DataFrame, name: str) -> DataFrame:
    """Register a session view and return the frame unchanged."""
    df.createOrReplaceTempView(f"`{name}`")
    return df
