import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F

from rollcall.operators import people, relational as rel
from rollcall.plans import cohorts
from rollcall.plans.registry import empty_registry, register, set_production
from rollcall.plans.spec import ModelSpec

KEY = ("a", "b")


def test_null_aware_anti_join_matches_not_in(spark):
    values = [None, 1, 2]
    left = spark.createDataFrame(list(itertools.product(values, values)), "a int, b int")
    rights = [[], [(1, 1)], [(1, None)], [(None, 2), (1, 1)], [(None, None)], [(2, None), (None, 1)]]
    for right in rights:
        done = spark.createDataFrame(right, "a int, b int")
        left.createOrReplaceTempView("mine")
        done.createOrReplaceTempView("done")
        want = spark.sql("SELECT * FROM mine WHERE (a, b) NOT IN (SELECT a, b FROM done)").collect()
        got = rel.not_yet_in(left, done, KEY, null_aware=True).collect()
        assert sorted(got, key=str) == sorted(want, key=str), right


def test_plain_anti_join_ignores_null(spark):
    left = spark.createDataFrame([(1, 1), (2, None)], "a int, b int")
    done = spark.createDataFrame([(None, None), (1, 1)], "a int, b int")
    assert [tuple(r) for r in rel.not_yet_in(left, done, KEY).collect()] == [(2, None)]


def test_null_aware_plan_has_no_nested_loop(spark):
    left = spark.range(100).select(F.col("id").alias("a"), F.col("id").alias("b"))
    plan = rel.not_yet_in(left, left, KEY, null_aware=True)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("columns", [1, 2, 3])
def test_null_aware_keys_without_null_take_one_join(spark, columns):
    key = ["a", "b", "c"][:columns]
    left = spark.range(100).select(*[F.when(F.col("id") >= 0, F.col("id") % 7 + i).alias(c) for i, c in enumerate(key)])
    out = rel.not_yet_in(left, left.limit(3), key, null_aware=True)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 1


def test_null_aware_three_columns_match_not_in(spark):
    values = [None, 1, 2]
    left = spark.createDataFrame(list(itertools.product(values, values, values)), "a int, b int, c int")
    for right in ([(1, None, 2), (2, 2, 2)], [(None, None, 1), (1, 2, None)], [(2, 1, 1)], [(None, None, None)], []):
        done = spark.createDataFrame(right, "a int, b int, c int")
        absent = [r for r in itertools.product(values, values, values) if all(any(x is not None and y is not None and x != y for x, y in zip(r, d)) for d in right)]
        got = rel.not_yet_in(left, done, ["a", "b", "c"], null_aware=True).collect()
        assert sorted(map(tuple, got), key=str) == sorted(absent, key=str), right


def test_star_join_refuses_repeated_keys_and_clashes(spark):
    base = spark.createDataFrame([(1, 1, "x")], "a int, b int, y string")
    block = spark.createDataFrame([(1, 1, 5), (1, 1, 6)], "a int, b int, f int")
    with pytest.raises(ValueError, match="not unique"):
        rel.star_join(base, {"f": block}, KEY)
    with pytest.raises(ValueError, match="already present"):
        rel.star_join(base, {"f": block.select("a", "b", F.col("f").alias("y")).limit(1)}, KEY)
    assert rel.star_join(base, {"f": block.filter("f = 5")}, KEY).first()["f"] == 5


def test_latest_and_ties(spark):
    d = [dt.date(2020, 1, 1), dt.date(2021, 1, 1)]
    rows = [(1, d[0], 10), (1, d[1], 11), (2, d[1], 12), (2, d[1], 13), (3, None, 14), (3, None, 15), (4, d[0], 16), (4, None, 17)]
    df = spark.createDataFrame(rows, "p int, d date, id int")
    first = {r["p"]: (r["id"], r["n"]) for r in people.latest(df, "p", "d", ["id"], count="n").collect()}
    assert first == {1: (11, 2), 2: (12, 2), 3: (14, 2), 4: (16, 2)}
    dropped = {r["p"]: r["id"] for r in people.latest(df, "p", "d", ties="drop").collect()}
    assert dropped == {1: 11, 4: 16}


def test_first_and_last_keep_all_rows_of_the_year(spark):
    df = spark.createDataFrame([(1, 2010, 1), (1, 2012, 2), (1, 2012, 3), (1, 2013, 4), (2, 2009, 5)], "p int, y int, id int")
    assert sorted(r["id"] for r in people.first_rows(df, "p", "y", 2011, 2020).collect()) == [2, 3]
    assert sorted(r["id"] for r in people.last_rows(df, "p", "y", 2009, 2012).collect()) == [2, 3, 5]


def test_hot_person_is_not_gathered(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("p"), (F.col("id") % 7).alias("y"), "id"
    )
    plan = people.first_rows(df, "p", "y", 0, 6)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert people.first_rows(df, "p", "y", 0, 6).filter("p = 0").count() == len([i for i in range(0, 50_000, 3) if i % 7 == 0])
    plan = people.latest(df, "p", "y", ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_only_latest_year_uses_all_records(spark):
    records = spark.createDataFrame([(1, 2016, "x"), (2, 2017, "x"), (3, 2017, None)], "p int, y int, s string")
    flags = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "p int, e int")
    out = cohorts.eligible(records, flags, [F.col("e") == 1, F.col("s") == "SI"], [F.lit(True)], "y", ["p"])
    assert [r["p"] for r in out.collect()] == [3]


def test_cohort_labels_treat_unknown_as_false(spark):
    df = spark.createDataFrame([(1, True, None), (2, None, True), (3, None, None), (4, True, True)], "id int, a boolean, b boolean")
    got = {r["id"]: r["u_d"] for r in cohorts.cohort_labels(df, F.col("a"), F.col("b"), ("u", "d"), ["id"]).collect()}
    assert got == {1: "u not d", 2: "d not u", 3: "neither u nor d", 4: "u + d"}


def test_registry(spark):
    spec = ModelSpec("m", "cohorts", "c", ("x",), "o", "p", {"f": ("b",)})
    blocks = {"f": spark.createDataFrame([(1, 1, 2, 3)], "person_id int, app_year int, a int, b int")}
    registry, one = register(empty_registry(spark), spec, blocks)
    registry, two = register(registry, spec, blocks)
    assert (one, two) == (1, 2)
    assert registry.first()["details"] == ["f.a"]
    with pytest.raises(ValueError):
        register(registry, spec, blocks, algorithm_id=2)
    assert [r["id"] for r in set_production(registry, [2]).filter("is_production").collect()] == [2]


def test_spec_round_trip(tmp_path):
    text = """
cohorts: {tbl: groups, col: kind, included: [one, two]}
features:
  app: []
  person: [secret]
outcomes: decision
predictions: current
algorithm_name: all
"""
    path = tmp_path / "spec.yaml"
    path.write_text(text)
    spec = ModelSpec.from_yaml(path)
    assert spec.features == {"app": (), "person": ("secret",)} and spec.cohort_values == ("one", "two")
    assert ModelSpec.from_dict(spec.to_dict()) == spec
