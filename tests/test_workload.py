"""Registered queries against their SQL at the smallest scale.

The headline queries by default; ROLLCALL_ALL=1 runs all of them. ``check.py`` does the same at any scale.
"""

import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
import bench
import check

SLOW = {"forest_scores", "multi_model_scores", "explanations", "score_new_rows"}
ORACLES = spark_entry.oracle_sql()


@pytest.fixture(scope="module")
def con(smoke):
    con = duckdb.connect()
    for t in check.TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{smoke}/{t}.parquet'")
    return con


def test_registered_names():
    queries = spark_entry.queries()
    assert set(ORACLES) <= set(queries)
    assert len(ORACLES) >= 0.9 * len(queries)


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert df.count() == 4 and df.columns[0] == "predicted_outcome"


CHOSEN = list(ORACLES) if os.environ.get("ROLLCALL_ALL") else [n for n in bench.HEADLINE if n in ORACLES and n not in SLOW]


@pytest.mark.parametrize("name", CHOSEN)
def test_query_matches_sql(spark, con, smoke, name):
    df = spark_entry.queries()[name](spark, smoke)
    cursor = con.execute(ORACLES[name])
    got, want = [tuple(r) for r in df.collect()], cursor.fetchall()
    assert check.difference(df.columns, got, [d[0] for d in cursor.description], want) is None
