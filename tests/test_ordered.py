"""Exact order statistics against brute force, with ties, hot values, hot groups and NULL."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.operators import ordered
from rollcall.operators.people import ntile_bucket, rank_bands, top_k_label


def sample(n, seed, hot=True):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        group = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", None])
        value = 5.0 if hot and rng.random() < 0.35 else rng.choice([None, round(rng.gauss(0, 3), 2), rng.uniform(-1e6, 1e6)])
        rows.append((i, group, value))
    return rows


@pytest.mark.parametrize("seed,n", [(1, 1), (2, 2), (3, 37), (4, 3000)])
def test_quantiles_match_numpy(spark, seed, n):
    rows = sample(n, seed)
    df = spark.createDataFrame(rows, "id int, g string, v double")
    probs = {"p0": 0.0, "p10": 0.1, "q": 0.25, "m": 0.5, "p100": 1.0}
    got = {r["g"]: r for r in ordered.quantiles(df, "v", probs, ["g"]).collect()}
    groups = {g for _, g, v in rows if v is not None}
    assert set(got) == groups
    for g in groups:
        values = [v for _, h, v in rows if h == g and v is not None]
        for name, p in probs.items():
            assert got[g][name] == pytest.approx(float(np.quantile(values, p)), rel=1e-9, abs=1e-9)


@pytest.mark.parametrize("kind", ["double", "bigint", "string", "prefixed", "date", "timestamp", "timestamp_ntz"])
def test_slots_never_decrease(spark, kind):
    rng = random.Random(5)
    base = spark.createDataFrame([(rng.randrange(0, 10**6),) for _ in range(2000)], "n int")
    value = {
        "double": F.col("n").cast("double") / 7 - 3,
        "bigint": F.col("n").cast("bigint") * 10**11,
        "string": F.md5(F.col("n").cast("string")),
        "prefixed": F.concat(F.lit("the same long start, it's \\ "), F.col("n").cast("string"), F.lit("é")),
        "timestamp_ntz": F.timestamp_micros(F.col("n").cast("bigint") * 10**3).cast("timestamp_ntz"),
        "date": F.date_from_unix_date(F.col("n") % 40000),
        "timestamp": F.timestamp_micros(F.col("n").cast("bigint") * 10**9),
    }[kind]
    df = ordered.add_slots(base.select(value.alias("v")), {"v": "slot"})
    rows = df.orderBy("v").collect()
    assert all(a["slot"] <= b["slot"] for a, b in zip(rows, rows[1:]))
    assert len({r["slot"] for r in rows}) > 10


def test_running_totals(spark):
    rows = [(i, g, v) for i, g, v in sample(1500, 9) if g]
    df = spark.createDataFrame(rows, "id int, g string, v double")
    got = ordered.running_totals(df, "v", {"n": F.lit(1), "ids": F.col("id")}, ["g"]).collect()
    assert len(got) == len({(g, v) for _, g, v in rows if v is not None})
    for r in got[:200]:
        mine = [(i, v) for i, g, v in rows if g == r["g"] and v is not None]
        assert r["n"] == sum(v == r["v"] for _, v in mine)
        assert r["n_before"] == sum(v < r["v"] for _, v in mine)
        assert r["ids_before"] == sum(i for i, v in mine if v < r["v"])
        assert r["n_total"] == len(mine)


def test_rows_at_ranks_breaks_ties_column_by_column(spark):
    rng = random.Random(3)
    rows = [(rng.choice([0, 0, 1, 2]), rng.choice("xy"), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, id int")
    wanted = [0, 1, 120, 250, 499]
    got = ordered.rows_at_ranks(df, ["a", "b", "id"], {str(r): (lambda n, r=r: F.lit(r)) for r in wanted})
    expected = sorted(rows)
    for row in got:
        assert (row["a"], row["b"], row["id"]) == expected[int(row["rank_name"])]
    assert len(got) == len(wanted)


@pytest.mark.parametrize("n", [0, 4, 15, 16, 100, 101])
def test_ntile_sizes(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([1.0, 1.0, 2.0, 3.5]), i) for i in range(n)]
    df = spark.createDataFrame(rows, "s double, id int")
    got = {r["id"]: r["bucket"] for r in ntile_bucket(df, ["s", "id"], 15).collect()}
    base, extra = divmod(n, 15)
    expected, at = {}, 0
    for bucket in range(15):
        for s, i in sorted(rows)[at : at + base + (bucket < extra)]:
            expected[i] = bucket + 1
        at += base + (bucket < extra)
    assert got == expected


def test_rank_bands_follow_percent_rank(spark):
    rng = random.Random(2)
    values = [rng.choice([1.0, 2.0, 2.0, 2.0, 3.0, 9.0]) for _ in range(200)] + [None] * 5
    df = spark.createDataFrame([(v,) for v in values], "v double")
    known = sorted(v for v in values if v is not None)
    got = rank_bands(df, "v", [0.25, 0.75]).collect()
    assert len(got) == len(known)
    for r in got:
        p = sum(v < r["v"] for v in known) / (len(known) - 1)
        assert r["band"] == (0 if p <= 0.25 else 1 if p <= 0.75 else 2)
    single = spark.createDataFrame([(4.0,)], "v double")
    assert rank_bands(single, "v", [0.25, 0.75]).first()["band"] == 0


@pytest.mark.parametrize("k,expected", [(0.5, 3), (50, 3), (1, 0), (100, 6), (99, 5)])
def test_top_k(spark, k, expected):
    df = spark.createDataFrame([(float(i),) for i in range(6)], "s double")
    assert top_k_label(df, "s", k).filter("label = 1").count() == expected


def test_top_k_ties_at_the_cut_give_fewer(spark):
    df = spark.createDataFrame([(s,) for s in (9.0, 5.0, 5.0, 5.0, 1.0, 0.0)], "s double")
    # position int(6 * 0.5) = 3 of the descending order holds 5, and only 9 is above
    assert top_k_label(df, "s", 50).filter("label = 1").count() == 1


def test_plan_has_no_window_without_partition(spark):
    df = spark.range(1000).select("id", (F.col("id") % 10).cast("double").alias("v"))
    plan = ordered.quantiles(df, "v", {"m": 0.5}, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan
    assert math.isfinite(len(plan))


def slot_sizes(df, target, first):
    """Rows and distinct values of each slot; the slots' order is checked on the way."""
    rows = ordered.add_slots(df, {"v": "slot"}, target, first).filter("v IS NOT NULL").collect()
    rows.sort(key=lambda r: r["v"].encode() if isinstance(r["v"], str) else (r["v"] != r["v"], r["v"]))
    assert all(a["slot"] <= b["slot"] for a, b in zip(rows, rows[1:]))
    sizes = {}
    for r in rows:
        sizes.setdefault(r["slot"], []).append(r["v"])
    return [(len(v), len(set(v))) for v in sizes.values()]


START = "é" * 200
UNEVEN = {
    "texts with a long common beginning and one other": ("string", [START + str(i) for i in range(3000)] + ["z", None]),
    "a hot text between others": ("string", ["m"] * 1500 + [f"{c}{i}" for i in range(700) for c in "amz"] + ["m\0", ""]),
    "numbers close together and far outliers": ("double", [i * 1e-12 for i in range(3000)] + [1e300, -1e300, float("inf"), float("-inf"), float("nan")]),
    "a hot number between others": ("double", [0.5] * 2000 + [i / 1000 for i in range(1000)]),
    "hot infinities": ("double", [float("inf")] * 900 + [float("-inf")] * 900 + [1.0, 2.0]),
    "one number": ("bigint", [7] * 1000),
    "numbers beyond 53 bits": ("bigint", [2**62 + i * 2**40 for i in range(2500)]),
}


@pytest.mark.parametrize("name", UNEVEN)
def test_slots_are_bounded(spark, name):
    kind, values = UNEVEN[name]
    random.Random(1).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}").repartition(3)
    sizes = slot_sizes(df, 100, 2)
    assert max(n for n, distinct in sizes if distinct > 1 or len(sizes) == 1) <= (100 if name != "one number" else 1000)
    assert sum(n for n, _ in sizes) == sum(v is not None for v in values)


def test_slots_of_several_columns_are_bounded(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(rng.gauss(0, 1) ** 9, START + str(rng.random()), rng.randrange(3)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "a double, b string, c int")
    out = ordered.add_slots(df, {"a": "sa", "b": "sb", "c": "sc"}, 150, 2)
    for value, slot in (("a", "sa"), ("b", "sb")):
        assert out.groupBy(slot).count().agg(F.max("count")).first()[0] <= 150
    assert out.select("c", "sc").distinct().count() == out.select("sc").distinct().count() == 3


def test_answers_do_not_depend_on_the_slots(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_SLOT", 40)
    monkeypatch.setattr(ordered, "FIRST_SLOTS", 2)
    rows = [(g, v) for _, g, v in sample(1500, 12) if v is not None]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["m"] for r in ordered.quantiles(df, "v", {"m": 0.5}, ["g"]).collect()}
    assert got == {g: pytest.approx(float(np.median([v for h, v in rows if h == g]))) for g in {g for g, _ in rows}}
    texts = spark.createDataFrame([(START + f"{i:04}",) for i in range(999)], "v string")
    (hit,) = ordered.values_at_ranks(texts, "v", {"x": lambda n: F.lit(500)}).collect()
    assert (hit["v"], hit["n_equal"], hit["group_size"]) == (START + "0500", 1, 999)


def test_cut_rows_of_many_groups(spark):
    rows = [(i % 1500, i % 7, i) for i in range(6000)] + [(None, 1, 1), (None, 1, 0)]
    df = spark.createDataFrame(rows, "g int, a int, id int")
    got = {r["g"]: r for r in ordered.cut_rows(df, ["a", "id"], {"last": lambda n: n - 1}, ["g"]).collect()}
    for g in {r[0] for r in rows}:
        want = max((a, i) for h, a, i in rows if h == g)
        assert got[g]["a"] == want[0] and got[g]["id"] in (want[1], None)
    assert got[None]["id"] == 1 and got[None]["depth__"] == 2
