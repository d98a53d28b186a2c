import math
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from rollcall.modelling import evaluation as measure
from rollcall.modelling.encoder import DummyEncoder, RarePooler
from rollcall.modelling.explain import Background, drawn_level, explain, fills, samples
from rollcall.modelling.fitting import build_grid, fit_forest, forest_pipeline, stage_names
from rollcall.modelling.lasso_path import fit_lasso_path, fold_aucs, solve_path
from rollcall.modelling.matrix import scoring_matrix, training_matrix
from rollcall.modelling.recipe import fit_lasso
from rollcall.modelling.scoring import class_labels, load_model, save_model, score, with_net_score
from rollcall.modelling.split import categorical_columns, stratified_split
from rollcall.modelling.stages import GapFiller, VarianceFilter, typical_values
from rollcall.operators import ordered
from rollcall.modelling.training import train_model
from rollcall.plans.registry import empty_registry
from rollcall.plans.spec import ModelSpec
from rollcall.session import fresh_path
from rollcall.streaming.incremental import daily_run, score_by_cohort, score_stream, stored_predictions

KEY = ("id",)
SMALL = {"randomforestclassifier": {"n_estimators": [5], "max_depth": [3]}}


@pytest.fixture(scope="module")
def people(spark):
    """Outcome follows x and kind; x has gaps."""
    rng = random.Random(1)
    rows = []
    for i in range(300):
        x, kind = rng.uniform(-1, 1), rng.choice(["a", "b", None])
        outcome = "invite" if x > 0.3 else "hold" if x > -0.3 else "reject"
        rows.append((i, None if i % 20 == 0 else x, kind, rng.choice([0, 1]), rng.gauss(0, 1), outcome))
    schema = "id int, x double, kind string, flag int, noise double, outcome string"
    return spark.createDataFrame(rows, schema).cache()


def test_split_is_stratified_and_independent_of_partitions(people):
    one = stratified_split(people, "outcome", KEY).filter("set = 'test'")
    other = stratified_split(people.repartition(7), "outcome", KEY).filter("set = 'test'")
    assert {r["id"] for r in one.collect()} == {r["id"] for r in other.collect()}
    sizes = {r["outcome"]: r["count"] for r in people.groupBy("outcome").count().collect()}
    for r in one.groupBy("outcome").count().collect():
        assert abs(r["count"] - 0.2 * sizes[r["outcome"]]) <= 0.5


def test_categorical_columns(people):
    with_count = people.withColumn("total_A", F.col("flag"))
    assert categorical_columns(with_count, exclude=["id", "outcome"]) == ["kind", "flag"]


def test_encoder_names_unseen_and_missing(spark, people, tmp_path):
    fitted = DummyEncoder(["kind", "flag"]).fit(people)
    assert fitted.output_names() == ["kind_a", "kind_b", "kind_nan", "flag_0", "flag_1", "flag_nan"]
    new = spark.createDataFrame([(1, "zzz", 1), (2, None, None)], "id int, kind string, flag int")
    got = [tuple(r) for r in fitted.transform(new).collect()]
    assert got == [(1, 0.0, 0.0, 0.0, 0.0, 1.0, 0.0), (2, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0)]
    encoder = DummyEncoder(["kind"])
    encoder.set(encoder.maxLevels, 1)
    with pytest.raises(ValueError, match="levels"):
        encoder.fit(people)


def test_vector_of_levels_equals_the_columns(spark, people):
    people = people.select("id", "kind", "flag").union(spark.createDataFrame([(-9, "", 1), (-8, "none", 1), (-7, "=x", 1)], "id int, kind string, flag int"))
    wide, sparse = DummyEncoder(["kind", "flag"]).fit(people), DummyEncoder(["kind", "flag"], "v").fit(people)
    new = people.select("id", "kind", "flag").union(spark.createDataFrame([(-1, "zzz", 1), (-2, None, None), (-3, "", 5)], "id int, kind string, flag int"))
    names = wide.output_names()
    out = sparse.transform(new)
    assert [a["name"] for a in out.schema["v"].metadata["ml_attr"]["attrs"]["binary"]] == names
    got = {r["id"]: list(r["v"].toArray()) for r in out.collect()}
    assert got == {r["id"]: [r[n] for n in names] for r in wide.transform(new).collect()}
    assert out.columns == ["id", "kind", "flag", "v"] and out.first()["v"].numNonzeros() <= 2
    assert DummyEncoder([], "v").fit(people).transform(people).first()["v"].size == 0


def test_many_levels(spark):
    rows = spark.range(20_000).select(
        F.col("id").cast("int").alias("id"), F.concat(F.lit("level "), F.col("id")).alias("many"), (F.col("id") % 3).cast("double").alias("x"),
        F.when(F.col("id") % 3 == 0, "yes").otherwise("no").alias("outcome"),
    )
    start = time.perf_counter()
    fitted = DummyEncoder(["many"], "v").fit(rows)
    vectors = VectorAssembler(inputCols=["x", "v"], outputCol="features").transform(fitted.transform(rows))
    labelled = vectors.select((F.col("outcome") == "yes").cast("double").alias("label"), "features")
    model = LogisticRegression(maxIter=5, regParam=0.01).fit(labelled)
    assert model.numFeatures == 20_002 and model.coefficients[0] < 0
    assert time.perf_counter() - start < 90  # a column per level does not get through planning in that time


@pytest.mark.parametrize("strategy", ["mean", "median", "mode"])
def test_typical_values_are_exact(spark, strategy, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_SLOT", 50)
    rng = random.Random(3)
    rows = [(rng.choice([None, float("nan"), round(rng.gauss(0, 2), 1), 4.0]), rng.randrange(5) or None, None) for _ in range(401)]
    found = typical_values(spark.createDataFrame(rows, "a double, b int, c double").repartition(3), ["a", "b", "c"], strategy)
    for name, values in (("a", [r[0] for r in rows if r[0] is not None and r[0] == r[0]]), ("b", [r[1] for r in rows if r[1] is not None])):
        want = {"mean": np.mean, "median": np.median, "mode": lambda v: min(set(v), key=lambda x: (-v.count(x), x))}[strategy](values)
        assert found[name] == pytest.approx(float(want))
    assert found["c"] is None


def test_variance_filter_takes_the_population(spark):
    rows = spark.createDataFrame([(Vectors.dense([i % 2, 1.0, i]),) for i in range(4)], ["all_features"])
    assert VarianceFilter(0.0).fit(rows).selectedFeatures == [0, 2]
    assert VarianceFilter(0.25).fit(rows).selectedFeatures == [2]  # the sample variance of the first is 1/3
    assert VarianceFilter(0.2499).fit(rows).selectedFeatures == [0, 2]
    with pytest.raises(ValueError, match="no feature"):
        VarianceFilter(9.0).fit(rows)


def test_search_fits_each_stage_once_per_fold(people, monkeypatch):
    fits = Counter()
    for kind in (DummyEncoder, GapFiller, VarianceFilter, RandomForestClassifier):
        def counted(self, data, kind=kind, fit=kind._fit):
            fits[kind.__name__] += 1
            return fit(self, data)

        monkeypatch.setattr(kind, "_fit", counted)
    grid = {
        "imputer": {"strategy": ["mean", "median"]},
        "variancethreshold": {"threshold": [0, 0.01]},
        "randomforestclassifier": {"n_estimators": [2, 3], "max_depth": [1, 2]},
    }
    model = fit_forest(people, "outcome", KEY, grid, folds=2)
    # the last of each is the refit of the best point
    assert fits == {"DummyEncoder": 2 + 1, "GapFiller": 2 * 2 + 1, "VarianceFilter": 2 * 4 + 1, "RandomForestClassifier": 2 * 16 + 1}
    assert len(model.avgMetrics) == len(model.stdMetrics) == 16 and max(model.avgMetrics) > 0.7


def test_rare_levels_are_pooled(spark):
    df = spark.createDataFrame([("a",)] * 97 + [("b",)] * 3 + [(None,)], "k string")
    out = RarePooler(["k"], 0.05).fit(df).transform(df)
    assert {(r["k"], r["count"]) for r in out.groupBy("k").count().collect()} == {("a", 97), ("other", 3), (None, 1)}


def test_grid_maps_options_and_caps_depth(people):
    forest = forest_pipeline(people, "outcome", ["kind"], ["x", "noise"])
    options = {
        "imputer": {"strategy": ["mean", "most_frequent"]},
        "variancethreshold": {"threshold": [0, 0.1]},
        "randomforestclassifier": {"max_depth": [5, 50], "max_features": ["sqrt"], "min_samples_split": [2, 5]},
        "nothing": {"x": [1]},
    }
    with pytest.warns(UserWarning):
        points = build_grid(forest, options, 11)
    assert len(points) == 16
    values = {p.name: {point[p] for point in points} for p in points[0]}
    assert values["maxDepth"] == {5, 30} and values["minInstancesPerNode"] == {1, 3}
    assert max(values["varianceThreshold"]) == pytest.approx(0.11)


def test_forest_end_to_end(spark, people):
    parts = stratified_split(people, "outcome", KEY)
    train, test = (parts.filter(F.col("set") == s).drop("set") for s in ("train", "test"))
    grid = {"randomforestclassifier": {"n_estimators": [5], "max_depth": [1, 4]}}
    model = fit_forest(train, "outcome", KEY, grid, folds=2)
    assert class_labels(model) == ["hold", "invite", "reject"]
    assert "DummyModel" in stage_names(model) and len(model.avgMetrics) == 2
    path = fresh_path(spark, "models")
    save_model(model, path, 5)
    loaded = load_model(path, 5)
    columns = ["predicted_hold", "predicted_invite", "predicted_reject"]
    one = score(model, test, KEY, "outcome").orderBy("id").collect()
    two = score(loaded, test.drop("outcome"), KEY).orderBy("id").collect()
    assert [[r[c] for c in columns] for r in one] == [[r[c] for c in columns] for r in two]
    assert all(abs(sum(r[c] for c in columns) - 1) < 1e-9 for r in one)
    scored = spark.createDataFrame(one).withColumn("hit", (F.col("outcome") == "invite").cast("int"))
    assert measure.auc(scored, "hit", "predicted_invite").first()[0] > 0.9
    ranks = measure.importances(model, spark).collect()
    assert ranks[0]["feature"] == "x" and [r["rank"] for r in ranks] == list(range(1, len(ranks) + 1))
    assert sum(r["importance"] for r in ranks) == pytest.approx(1)
    with pytest.raises(ValueError):
        with_net_score(score(model, test, KEY), "yes", "no")


def test_lasso_finds_the_signal(people):
    rows = people.withColumn("outcome", F.when(F.col("outcome") == "invite", "yes").otherwise("no"))
    model = fit_lasso(rows, "outcome", KEY, penalties=(0.1, 0.01), folds=2)
    scored = score(model, rows, KEY, "outcome").withColumn("hit", (F.col("outcome") == "yes").cast("int"))
    assert scored.columns == ["id", "outcome", "predicted_yes", "hit"]
    assert measure.auc(scored, "hit", "predicted_yes").first()[0] > 0.9


def test_auc_counts_ties_half(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0, 1]), rng.choice([0.1, 0.5, 0.5, 0.9])) for _ in range(60)]
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    want = np.mean([1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg])
    df = spark.createDataFrame(rows, "y int, s double")
    assert measure.auc(df, "y", "s").first()[0] == pytest.approx(want)
    assert measure.auc(df.filter("y = 1"), "y", "s").first()[0] is None


def test_explanations_point_at_the_signal(people):
    rows = people.drop("kind", "flag").withColumn("outcome", F.when(F.col("outcome") == "invite", "yes").otherwise("no"))
    model = fit_forest(rows, "outcome", KEY, SMALL)
    background = Background.of(rows, ["x", "noise"], [])
    found = explain(model, rows, background, n_features=2, n_samples=150, key=KEY).cache()
    assert found.count() == 600
    first = found.filter("place = 1").join(rows, "id").filter("x > 0.5").collect()
    assert all(r["feature"] == "x" and r["weight"] > 0 for r in first)
    assert all(math.isfinite(r["weight"]) for r in found.collect())


def test_explanations_equal_a_direct_regression(spark, people):
    rows = people.drop("flag").withColumn("outcome", F.when(F.col("outcome") == "invite", "yes").otherwise("no"))
    model = fit_forest(rows, "outcome", KEY, SMALL)
    background = Background.of(rows, ["x", "noise"], ["kind"])
    some = rows.filter("id < 12").repartition(3)
    found = explain(model, some, background, n_features=3, n_samples=90, key=KEY).collect()
    drawn = samples(some, background, 90, KEY, 1100, fills(model))
    assert fills(model).keys() == {"x", "noise"} and drawn.filter("x IS NULL").count() == 0  # gaps are filled first
    scored = model.transform(drawn).select("id", "sample__", "kept__", "probability").toPandas()
    for i, own in scored.groupby("id"):
        z, y = np.array(own["kept__"].to_list(), float), np.array([p[1] for p in own.probability])
        assert len(own) == 90 and z[own["sample__"] == 0].all()
        w = np.sqrt(np.exp(-(3 - z.sum(1)) / 9.0))
        centred = z - np.average(z, axis=0, weights=w)
        want = np.linalg.solve((centred * w[:, None]).T @ centred + np.eye(3), (centred * w[:, None]).T @ y)
        got = {r["feature"]: r["weight"] for r in found if r["id"] == i}
        assert [got[c] for c in background.features] == pytest.approx(want)
        assert [r["place"] for r in found if r["id"] == i] == [1, 2, 3]


def test_levels_are_drawn_by_their_shares(spark):
    levels = [(f"level {i}", (i + 1) / 20_000) for i in range(20_000)]
    start = time.perf_counter()
    draws = spark.range(5000).select((F.col("id") / 5000).alias("u")).withColumn("level", drawn_level("u", levels)).collect()
    assert [r["level"] for r in draws] == [f"level {int(r['u'] * 20_000 + 1e-9)}" for r in draws]
    assert time.perf_counter() - start < 60
    assert spark.range(1).select(drawn_level("0.5D", [("only", 1.0)]).alias("x")).first()["x"] == "only"


@pytest.fixture(scope="module")
def world(spark, people):
    keys = people.select("id", F.when(F.col("id") < 200, "fit").otherwise("predict").alias("fit_or_predict"), "flag")
    return {
        "groups": keys.withColumn("group", F.when(F.col("flag") == 1, "one").otherwise("two")),
        "decision": people.filter("id < 200").select("id", "outcome"),
        "current": people.filter("id >= 200").select("id"),
        "app": people.select("id", "x", "noise").filter("id <> 250"),
        "person": people.select("id", "kind", "flag"),
    }


def spec(name, *groups):
    return ModelSpec(name, "groups", "group", groups, "decision", "current", {"app": ("noise",), "person": ("flag",)})


def test_matrices_start_from_keys(spark, world):
    train = training_matrix(spec("m", "one", "two"), world, KEY)
    assert train.columns == ["id", "outcome", "x", "kind"] and train.count() == 200
    done = spark.createDataFrame([(201, 1), (202, 2)], "id int, algorithm_id long")
    new = scoring_matrix(spec("m", "one", "two"), world, done, 1, KEY)
    ids = {r["id"] for r in new.collect()}
    assert ids == set(range(200, 300)) - {201}  # 250 has no app row and is still scored


def test_daily_run_is_idempotent_and_stops_when_nothing_is_new(spark, world):
    s = spec("m", "one", "two")
    model = fit_forest(training_matrix(s, world, KEY), "outcome", KEY, SMALL)
    root = fresh_path(spark, "daily")
    schema = "id int, predicted_hold double, predicted_invite double, predicted_reject double, score double"
    early = {**world, "current": world["current"].filter("id < 260")}
    net = ("invite", "reject")
    assert daily_run(s, model, 3, early, root, "day1", schema, net, KEY)
    assert daily_run(s, model, 3, early, root, "day1", schema, net, KEY)
    assert stored_predictions(spark, root, schema).count() == 60
    assert not daily_run(s, model, 3, early, root, "day2", schema, net, KEY)
    assert daily_run(s, model, 3, world, root, "day2", schema, net, KEY)
    stored = stored_predictions(spark, root, schema)
    assert stored.count() == 100 and stored.select("id").distinct().count() == 100
    assert {r["run"] for r in stored.select("run").distinct().collect()} == {"day1", "day2"}


def test_models_are_matched_by_name(spark, world):
    one = spec("m1", "one")
    model = fit_forest(training_matrix(one, world, KEY), "outcome", KEY, SMALL)
    nothing = spark.createDataFrame([], "id int, algorithm_id long")
    both = {"m1": (one, model, 1), "m2": (spec("m2", "two"), model, 2)}
    scored = score_by_cohort(both, world, nothing, key=KEY).select("id", "algorithm_id")
    groups = {r["id"]: r["group"] for r in world["groups"].collect()}
    assert all((groups[r["id"]] == "one") == (r["algorithm_id"] == 1) for r in scored.collect())
    assert scored.count() == 100
    with pytest.raises(ValueError):
        score_by_cohort({"other": (one, model, 1)}, world, nothing, key=KEY)


def test_stream_scores_each_record_once(spark):
    source, root, state = (fresh_path(spark, n) for n in ("source", "scored", "state"))
    rows = spark.range(10).select(F.col("id"), (F.col("id") / 10).alias("x"))

    def run():
        stream = score_stream(
            spark, source, rows.schema, lambda d: d.select("id", (F.col("x") * 2).alias("s")), root, "id bigint, s double", state, 4, KEY
        )
        stream.awaitTermination()

    rows.filter("id < 6").write.parquet(source)
    run()
    rows.filter("id >= 3").write.mode("append").parquet(source)
    run()
    run()
    stored = stored_predictions(spark, root, "id bigint, s double")
    assert sorted(r["id"] for r in stored.collect()) == list(range(10))


def planted(spark, n=900, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6)) * np.array([1, 10, 1, 0.1, 1, 1]) + np.array([0, 100, 0, 0, 0, 0])
    x[:, 5] = 3.0  # does not vary
    z = 1.6 * x[:, 0] - 0.09 * (x[:, 1] - 100) + 5 * x[:, 3] - 0.3
    y = (rng.random(n) < 1 / (1 + np.exp(-z))).astype(int)
    rows = [(row.tolist(), int(t), int(i % 3)) for i, (row, t) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "x array<double>, y int, fold int").repartition(3).cache()


def test_lasso_path_is_optimal_at_every_penalty(spark):
    x, y, rows = planted(spark)
    path = solve_path(rows, list("abcdef"), folds=3, penalties=8, lowest=0.02)
    sd = np.where(x.std(0) > 1e-12, x.std(0), 1)
    assert path.penalties[0] == pytest.approx(np.abs(((x - x.mean(0)) / sd).T @ (y - y.mean()) / len(y)).max())
    assert not path.coefficients[0, -1].any() and not path.coefficients[:, :, 5].any()
    for at, level in enumerate(path.penalties):
        for m in range(4):
            mine = np.arange(len(y)) % 3 != m
            p = 1 / (1 + np.exp(-(path.intercepts[at, m] + x[mine] @ path.coefficients[at, m])))
            g = ((x[mine] - x.mean(0)) / sd).T @ (y[mine] - p) / mine.sum()
            used = path.coefficients[at, m] != 0
            assert abs((y[mine] - p).mean()) < 1e-6
            assert np.abs(g[used] - level * np.sign(path.coefficients[at, m][used])).max(initial=0) < 1e-5
            assert (np.abs(g[~used]) <= level + 1e-5).all()
    entered = [(name, sign) for _, name, sign, _ in path.entries()]
    assert entered[:3] == [("a", 1), ("b", -1), ("d", 1)]
    aucs = fold_aucs(rows, path, 3)
    assert aucs.shape == (8, 3) and aucs[-1].min() > 0.8
    held = np.arange(len(y)) % 3 == 1
    s = path.intercepts[4, 1] + x[held] @ path.coefficients[4, 1]
    pos, neg = s[y[held] == 1], s[y[held] == 0]
    assert aucs[4, 1] == pytest.approx(np.mean(pos[:, None] > neg[None]), abs=1e-9)


def test_fitted_lasso_path(spark, people):
    rows = people.withColumn("outcome", F.when(F.col("outcome") == "invite", "yes").otherwise("no"))
    fitted = fit_lasso_path(rows, "outcome", KEY, folds=3, penalties=10)
    path = fitted.path
    assert path.entries()[0][1:3] == ("x", 1) and 0 <= path.one_standard_error <= path.best < 10
    scored = fitted.score(rows, KEY, keep=["outcome"])
    assert scored.columns == ["id", "outcome", "predicted_yes"]
    hit = scored.withColumn("hit", (F.col("outcome") == "yes").cast("int"))
    assert measure.auc(hit, "hit", "predicted_yes").first()[0] > 0.9
    flat = fitted.score(rows, KEY, at=0).select("predicted_yes").distinct().collect()
    share = rows.filter("outcome = 'yes'").count() / rows.count()
    assert flat[0][0] == pytest.approx(share, abs=1e-6)


def test_training_run(spark, world):
    root = fresh_path(spark, "training")
    s, registry = spec("m", "one", "two"), empty_registry(spark)
    first = train_model(s, world, registry, f"{root}/models", f"{root}/results", SMALL, key=KEY)
    second = train_model(s, world, first.registry, f"{root}/models", f"{root}/results", SMALL, key=KEY, test=0.5)
    assert (first.algorithm_id, second.algorithm_id) == (1, 2) and second.registry.count() == 2
    stored = spark.read.parquet(second.results_path)
    sizes = {(r["algorithm_id"], r["set"]): r["count"] for r in stored.groupBy("algorithm_id", "set").count().collect()}
    assert sum(n for (i, _), n in sizes.items() if i == 1) == 200 and sizes[2, "test"] == pytest.approx(100, abs=3) and sizes[1, "test"] == pytest.approx(40, abs=3)
    matrix = training_matrix(s, world, KEY)
    again = {r["id"]: r["predicted_invite"] for r in score(load_model(f"{root}/models", 1), matrix, KEY).collect()}
    assert {r["id"]: r["predicted_invite"] for r in stored.filter("algorithm_id = 1").collect()} == again
    with pytest.raises(ValueError, match="exists"):
        train_model(s, world, second.registry, f"{root}/models", f"{root}/results", SMALL, algorithm_id=2, key=KEY)
