import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from rollcall.functions import rules, values as v
from rollcall.operators import profile, tabulate
from rollcall.plans import dashboard, reports
from rollcall.plans.describe import describe_table

# Published aggregate counts per bucket (bucket, total, interviewed, accepted, matriculated, and by
# the model screened, interviewed, accepted, matriculated) and their published totals.
BUCKETS = [
    (0, 2324, 919, 501, 113, 2324, 919, 500, 113),
    (1, 698, 15, 1, 0, 0, 0, 0, 0),
    (2, 607, 30, 11, 10, 0, 0, 0, 0),
    (3, 615, 42, 4, 2, 0, 0, 0, 0),
    (4, 638, 43, 9, 7, 0, 0, 0, 0),
    (5, 598, 53, 11, 5, 0, 0, 0, 0),
    (6, 585, 84, 18, 12, 0, 0, 0, 0),
    (7, 610, 91, 14, 8, 0, 0, 0, 0),
    (8, 624, 101, 22, 13, 624, 101, 22, 13),
    (9, 652, 122, 37, 15, 652, 122, 37, 15),
    (10, 655, 182, 55, 31, 655, 182, 55, 31),
    (11, 619, 228, 75, 31, 619, 228, 75, 31),
    (12, 601, 338, 108, 47, 601, 338, 108, 47),
    (13, 629, 415, 153, 49, 629, 415, 153, 49),
    (14, 654, 509, 229, 74, 654, 509, 229, 74),
    (15, 718, 607, 385, 72, 0, 718, 385, 72),
]
TOTALS = {
    "n_screened_old": 11827,
    "n_screened_model": 6758,
    "n_interviewed_old": 3779,
    "n_interviewed_model": 3532,
    "n_accepted_old": 1633,
    "n_accepted_model": 1564,
    "n_matriculated_old": 489,
    "n_matriculated_model": 445,
}
# Published percent texts of some of those shares.
PERCENTS = [((919, 2324), "39.5%"), ((1, 698), "0.143%"), ((0, 698), "0%"), ((108, 601), "18%"), ((113, 2324), "4.86%"),
            ((4, 615), "0.65%"), ((229, 654), "35%"), ((55, 655), "8.4%"), ((14, 610), "2.3%")]


def test_payoff_equals_published_totals(spark):
    schema = "risk_bucket int, total int, num_interviewed int, num_accepted int, num_matriculated int, "
    schema += "num_screened_model int, num_interview_model int, num_accepted_model int, num_matriculated_model int"
    assert reports.payoff(spark.createDataFrame(BUCKETS, schema)).first().asDict() == TOTALS


def test_percent_texts_equal_published(spark):
    df = spark.createDataFrame([(a / b, text) for (a, b), text in PERCENTS], "share double, want string")
    for r in df.select(v.percent_text("share").alias("got"), "want").collect():
        assert r["got"] == r["want"]


def test_backtest_steps_need_the_one_before(spark):
    rows = [(0, 1, 1, 1), (5, 1, 1, 1), (9, 1, 0, 1), (15, 0, 1, 1), (None, 1, 1, 1)]
    df = spark.createDataFrame(rows, "b int, i int, a int, e int")
    out = reports.payoff(reports.backtest(df, "b", [0, 8, 9], 15, "i", "a", "e")).first()
    assert out["n_screened_model"] == 2 and out["n_interviewed_model"] == 3
    assert out["n_accepted_model"] == 2 and out["n_matriculated_model"] == 2


def test_band_limits_are_strict_and_null_falls_low(spark):
    df = spark.createDataFrame([(-0.15,), (0.5,), (0.51,), (None,)], "score double")
    assert [r[0] for r in df.select(v.band("score", -0.15, 0.5)).collect()] == ["Reject", "Hold", "Invite", "Reject"]


def test_all_row_counts_equal_rows_once(spark):
    df = spark.createDataFrame([("x", 0.9), ("x", 0.9), ("y", 0.0)], "id string, score double")
    flags = {"high": F.col("score") > 0.5}
    once = {r["predicted_outcome"]: r["n"] for r in dashboard.band_table(df, flags, -0.1, 0.5).collect()}
    assert once == {"Invite": 1, "Hold": 1, "All": 2}
    every = {r["predicted_outcome"]: r["n"] for r in dashboard.band_table(df, flags, -0.1, 0.5, dedup=False).collect()}
    assert every == {"Invite": 2, "Hold": 1, "All": 3}


def test_shares_leave_unknown_out_and_sum_of_unknown_is_null(spark):
    df = spark.createDataFrame([("a", None), ("a", "F"), ("a", "M"), ("b", None)], "band string, g string")
    out = {r["band"]: r for r in tabulate.crosstab_shares(df, "band", {"f": F.col("g") == "F"}, dedup=False).collect()}
    assert (out["a"]["f"], out["a"]["pct_f"], out["a"]["n"]) == (1, 0.5, 3)
    assert (out["b"]["f"], out["b"]["pct_f"]) == (None, None)
    assert out["All"]["pct_f"] == 0.5


def test_rounding_rules(spark):
    df = spark.createDataFrame([(0.125,), (0.375,), (-0.125,)], "x double")
    got = df.select(v.round_away("x", 2), v.round_even("x", 2)).collect()
    assert [tuple(r) for r in got] == [(0.13, 0.12), (0.38, 0.38), (-0.13, -0.12)]


def test_membership_rules(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert df.filter(rules.not_in_set("x", ["a"])).count() == 2
    assert df.filter(rules.not_in_set("x", ["a"], drop_null=True)).count() == 1
    assert df.filter(rules.differs("x", "a")).count() == 1
    assert df.filter(rules.in_set("x", ["a"])).count() == 1


def test_digest_depends_on_the_text_form(spark):
    row = spark.createDataFrame([(13, 13.0)], "a int, b double")
    got = row.select(v.key_digest("a", None), v.key_digest("b", None), v.key_digest("a", "s")).first()
    assert got[0] == "c51ce410c124a10e0db5e4b97fc2af39" and got[0] != got[1] and len(got[2]) == 64


def test_summaries_of_single_rows_and_empty_columns(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("b", 1.0, None), ("b", 3.0, None)], "g string, x double, y double")
    got = {(r["variable"], r["g"]): r for r in profile.summaries(df, "g").collect()}
    assert got[("x", "a")]["sd"] is None and got[("x", "a")]["median"] == 1.0
    assert got[("x", "b")]["q25"] == 1.5 and got[("y", "b")]["n"] == 0 and got[("y", "b")]["q75"] is None
    with pytest.raises(ValueError):
        profile.summaries(df.select("g"), "g")


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(None, "x"), (None, None), ("a", "x")], "g string, t string")
    got = {(r["g"], r["value"]): r["share"] for r in profile.category_shares(df, "g").collect()}
    assert got == {(None, "x"): 0.5, (None, None): 0.5, ("a", "x"): 1.0}


def test_top_categories_are_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 100).cast("string").alias("t"), F.lit("g").alias("g"))
    plan = profile.category_shares(df, "g", top_n=3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert profile.category_shares(df, "g", top_n=3).count() == 3


def test_correlation_needs_two_rows(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("b", 1.0, 2.0), ("b", 2.0, 1.0)], "g string, x double, y double")
    got = {(r["g"], r["x"], r["y"]): r["r"] for r in profile.correlations(df, "g").collect()}
    assert got[("a", "x", "y")] is None and got[("b", "x", "y")] == -1.0 and got[("b", "y", "x")] == -1.0


def test_correlations_of_many_columns_with_gaps(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 300)) @ rng.normal(size=(300, 300)) * 0.05 + rng.normal(size=300) * 1e6
    x[rng.random(x.shape) < 0.2] = np.nan
    x[:, 7] = 0.1  # does not vary
    rows = [(i % 3 or None, "2020-01-01", *[None if v != v else float(v) for v in row]) for i, row in enumerate(x)]
    names = [f"c.{i}" for i in range(300)]
    df = spark.createDataFrame(rows, T.StructType([T.StructField("g", T.IntegerType()), T.StructField("d", T.StringType()), *[T.StructField(n, T.DoubleType()) for n in names]]))
    df = df.withColumn("d", F.col("d").cast("date")).repartition(4).cache()
    start = time.perf_counter()
    got = profile.correlations(df, columns=names, digits=9).collect()
    assert len(got) == 300 * 300 and time.perf_counter() - start < 60
    want = pd.DataFrame(x, columns=names).corr(min_periods=2).to_dict()
    for r in got[::37]:
        w = None if "c.7" in (r["x"], r["y"]) else want[r["x"]][r["y"]]
        assert r["r"] == (None if w is None or w != w else pytest.approx(w, abs=1e-6))
    groups = profile.correlations(df, ["g", "d"], columns=names[:5], digits=9)
    assert groups.dtypes[:2] == [("g", "int"), ("d", "date")]
    for g in (None, 1, 2):
        own = pd.DataFrame(x[[i for i in range(400) if (i % 3 or None) == g], :5], columns=names[:5]).corr().to_dict()
        mine = groups.filter(F.col("g").eqNullSafe(F.lit(g))).collect()
        assert len(mine) == 25 and all(r["r"] == pytest.approx(own[r["x"]][r["y"]], abs=1e-6) for r in mine)
    assert profile.correlations(df.limit(0), columns=names[:2]).collect() == []


def test_histogram_edges(spark):
    df = spark.createDataFrame([(-1.0,), (-0.99,), (1.0,), (1.1,), (-2.0,), (None,)], "x double")
    got = {r["bin"]: r["n"] for r in profile.histogram(df, "x", -1, 1, 25).collect()}
    assert got == {1: 2, 25: 1, 26: 1, 0: 1}


def test_full_report(spark):
    df = spark.createDataFrame(
        [(1, 2016, "Y", "x", 1.0, 0), (2, 2016, "N", None, None, 1), (3, 2017, None, "x", 5.0, 1)],
        "person_id int, app_year int, yes string, text string, number double, flag int",
    )
    parts = describe_table(df, "app_year")
    assert set(parts) == {
        "variable_types", "pct_missing", "missing_patterns", "complete_cases", "n_distinct", "category_shares",
        "summaries", "correlations", "correlations_by_group", "binary_shares",
    }
    for part in parts.values():
        assert part.count() > 0
    assert {r["variable"] for r in parts["summaries"].select("variable").collect()} == {"yes", "number", "flag"}


def test_projection_without_history_for_a_band(spark):
    current = spark.createDataFrame([(1, -0.5), (2, 0.0), (3, 0.9), (4, 0.8)], "id int, score double")
    past = spark.createDataFrame(
        [(9, -0.4, False, False, False), (8, 0.1, True, False, False), (7, 0.9, True, True, False)],
        "id int, score double, i boolean, o boolean, e boolean",
    )
    rates = dashboard.historic_rates(past, "i", "o", "e", -0.15, 0.5)
    out = {r["predicted_outcome"]: r for r in dashboard.project_cycle(rates, dashboard.screening_counts(current, -0.15, 0.5)).collect()}
    assert out["Reject"]["n_invites"] == 0 and out["Hold"]["n_invites"] == 1 and out["Invite"]["n_invites"] == 2
    assert out["All"]["n_invites"] == 3 and out["All"]["projected_accepted"] == 2
    assert out["Reject"]["historic_accepted_if_invited"] is None
