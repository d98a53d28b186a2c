"""Splits, encoders, measures, models, explanations and incremental scoring."""

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from rollcall.modelling import evaluation as measure
from rollcall.modelling.encoder import DummyEncoder, RarePooler
from rollcall.modelling.explain import Background, explain
from rollcall.modelling.fitting import best_pipeline, encoder_of, fit_forest
from rollcall.modelling.lasso_path import fit_lasso_path, solve_path
from rollcall.modelling.matrix import scoring_matrix, training_matrix
from rollcall.modelling.recipe import fit_lasso, near_constant_columns
from rollcall.modelling.scoring import class_labels, load_model, save_model, score, with_net_score
from rollcall.modelling.split import categorical_columns, split_stored, stratified_split
from rollcall.modelling.stages import STRATEGIES, GapFiller, VarianceFilter
from rollcall.modelling.training import train_model
from rollcall.operators.people import top_k_label as label_top
from rollcall.operators.profile import category_counts
from rollcall.plans.registry import empty_registry
from rollcall.plans.spec import ModelSpec
from rollcall.session import fresh_path
from rollcall.streaming.incremental import score_by_cohort, score_new, score_stream, stored_predictions
from workload.inputs import APPLICATIONS, KEY, PEOPLE, applications, load, people
from workload.registry import query

DOC_KEY = ("doc_id",)
LABELLED = """labelled AS (SELECT l.doc_id, l.quality, l.toxic, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
  CASE WHEN l.doc_id % 6 <> 0 THEN d.lang END AS gappy FROM labels l JOIN documents d USING (doc_id))"""


def labelled(spark, sf):
    docs = load(spark, sf, "documents").select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"))
    rows = load(spark, sf, "labels").join(docs, "doc_id").select("doc_id", "quality", "toxic", "lang", "source", "n_chars")
    return rows.withColumn("gappy", F.when(F.col("doc_id") % 6 != 0, F.col("lang")))


def split_sql(table: str, label: str, key: str, text: str) -> str:
    return f"""SELECT {key}, {label}, CASE WHEN place <= floor(size * 0.2::DOUBLE + 0.5) THEN 'test' ELSE 'train' END AS "set" FROM (
  SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5({text} || '|1100'), {key}) AS place,
    count(*) OVER (PARTITION BY {label}) AS size FROM {table})"""


@query(
    "stratified_split",
    f"WITH {APPLICATIONS} " + split_sql("apps", "decision", "person_id, app_id", "CAST(person_id AS VARCHAR) || '|' || CAST(app_id AS VARCHAR)"),
)
def stratified(spark, sf):
    return stratified_split(applications(spark, sf).select(*KEY, "decision"), "decision", KEY)


@query(
    "stratified_split_with_missing_label",
    f"WITH {APPLICATIONS} " + split_sql("apps", "priority", "app_id", "CAST(app_id AS VARCHAR)"),
)
def stratified_missing(spark, sf):
    return stratified_split(applications(spark, sf).select("app_id", "priority"), "priority", ["app_id"])


@query(
    "split_stored_results",
    f"""WITH {LABELLED} SELECT doc_id, n_chars, CASE WHEN quality = 0 THEN 'test' ELSE 'train' END AS part FROM labelled
WHERE lang <> 'es'""",
)
def split_stored_results(spark, sf):
    rows = labelled(spark, sf)
    results = rows.filter("lang <> 'es'").select("doc_id", F.when(F.col("quality") == 0, "test").otherwise("train").alias("set"))
    train, test = split_stored(rows.select("doc_id", "n_chars"), results, DOC_KEY)
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


@query(
    "categorical_columns",
    f"""WITH {LABELLED} SELECT 'toxic' AS variable, count(DISTINCT toxic) AS n_values FROM labelled
UNION ALL SELECT 'lang', count(DISTINCT lang) FROM labelled UNION ALL SELECT 'source', count(DISTINCT source) FROM labelled
UNION ALL SELECT 'gappy', count(DISTINCT gappy) FROM labelled""",
)
def categorical(spark, sf):
    rows = labelled(spark, sf).withColumn("count_A", F.col("toxic"))
    found = categorical_columns(rows, exclude=["doc_id", "quality"])
    wide = rows.agg(*[F.count_distinct(F.col(c)).alias(c) for c in found])
    return wide.select(F.inline(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(c).alias("n_values")) for c in found])))


@query(
    "dummy_encode",
    f"""WITH {LABELLED} SELECT doc_id, n_chars,
  {', '.join(f"CAST(coalesce({c} = '{x}', false) AS DOUBLE) AS {c}_{x}" for c in ('lang', 'gappy') for x in ('de', 'en', 'es', 'fr'))},
  CAST(lang IS NULL AS DOUBLE) AS lang_nan, CAST(gappy IS NULL AS DOUBLE) AS gappy_nan FROM labelled""",
)
def dummy_encode(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "n_chars", "lang", "gappy")
    return DummyEncoder(["lang", "gappy"]).fit(rows).transform(rows)


@query(
    "dummy_encode_unseen_level",
    f"""WITH {LABELLED} SELECT doc_id, {', '.join(f"CAST(lang = '{x}' AS DOUBLE) AS lang_{x}" for x in ('de', 'en', 'fr'))},
  0.0::DOUBLE AS lang_nan FROM labelled""",
)
def dummy_encode_unseen(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "lang")
    return DummyEncoder(["lang"]).fit(rows.filter("lang <> 'es'")).transform(rows)


@query(
    "pool_rare_levels",
    f"""WITH {LABELLED}, f AS (SELECT source FROM labelled GROUP BY source HAVING count(*) >= 0.05 * (SELECT count(source) FROM labelled))
SELECT doc_id, CASE WHEN source IN (SELECT source FROM f) THEN source ELSE 'other' END AS source FROM labelled""",
)
def pool_rare_levels(spark, sf):
    rows = labelled(spark, sf).select("doc_id", "source")
    return RarePooler(["source"], 0.05).fit(rows).transform(rows)


@query(
    "near_constant",
    """WITH long AS (
  SELECT 'o_custkey' AS variable, CAST(o_custkey AS VARCHAR) AS value FROM orders
  UNION ALL SELECT 'one', 'x' FROM orders
  UNION ALL SELECT 'rarely', CAST(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END AS VARCHAR) FROM orders
  UNION ALL SELECT 'o_orderstatus', o_orderstatus FROM orders),
g AS (SELECT variable, value, count(*) AS n FROM long GROUP BY variable, value),
c AS (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY n DESC) AS place FROM g),
s AS (SELECT variable, max(n) AS most, max(n) FILTER (place = 2) AS next, count(*) AS k, sum(n) AS total FROM c GROUP BY variable)
SELECT variable, CAST(most AS BIGINT) AS most FROM s WHERE next IS NULL OR (most > 19 * next AND 100.0 * k / total < 10)""",
)
def near_constant(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_custkey",
        F.lit("x").alias("one"),
        (F.col("o_orderkey") % 50 == 0).cast("int").alias("rarely"),
        "o_orderstatus",
    )
    found = near_constant_columns(rows, rows.columns)
    return category_counts(rows, columns=found).groupBy("variable").agg(F.max("n").alias("most"))


@query(
    "top_k_label",
    f"""WITH {APPLICATIONS}, r AS (SELECT score, row_number() OVER (ORDER BY score DESC) - 1 AS place FROM apps),
cut AS (SELECT score AS cut FROM r WHERE place = CAST(trunc((SELECT count(*) FROM apps) * 0.1) AS BIGINT))
SELECT app_id, score, CAST(score > (SELECT cut FROM cut) AS INTEGER) AS label FROM apps""",
)
def top_k_label(spark, sf):
    return label_top(applications(spark, sf).select("app_id", "score"), "score", 10)


def coarse(spark, sf):
    apps = applications(spark, sf)
    return apps.select(
        "app_id", "algorithm_id", F.round("score", 2).alias("score"), (F.col("status") == "P").cast("int").alias("hit")
    )


COARSE = f"""{APPLICATIONS}, scored AS (SELECT app_id, algorithm_id, round(score, 2) AS score, CAST(status = 'P' AS INTEGER) AS hit FROM apps)"""


@query(
    "precision_recall",
    f"""WITH {COARSE}, v AS (SELECT score, sum(hit) AS pos, count(*) AS n FROM scored GROUP BY score),
t AS (SELECT score, sum(pos) OVER w AS hits, sum(n) OVER w AS chosen, sum(pos) OVER () AS p, sum(n) OVER () AS total
  FROM v WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, hits / chosen AS precision, hits / p AS recall, chosen / total AS share_positive FROM t""",
)
def precision_recall(spark, sf):
    return measure.precision_recall(coarse(spark, sf), "hit", "score")


@query(
    "precision_recall_until_full",
    f"""WITH {COARSE}, moved AS (SELECT CASE WHEN hit = 1 THEN score + 1 ELSE score END AS score, hit FROM scored),
v AS (SELECT score, sum(hit) AS pos, count(*) AS n FROM moved GROUP BY score),
t AS (SELECT score, sum(pos) OVER w AS hits, sum(n) OVER w AS chosen, sum(pos) OVER () AS p, sum(n) OVER () AS total
  FROM v WINDOW w AS (ORDER BY score DESC))
SELECT score AS threshold, hits / chosen AS precision, hits / p AS recall, chosen / total AS share_positive FROM t
WHERE score >= (SELECT min(score) FROM moved WHERE hit = 1)""",
)
def precision_recall_until_full(spark, sf):
    rows = coarse(spark, sf).withColumn("score", F.when(F.col("hit") == 1, F.col("score") + 1).otherwise(F.col("score")))
    return measure.precision_recall(rows, "hit", "score", stop_at_full_recall=True)


@query(
    "auc",
    f"""WITH {COARSE}, v AS (SELECT algorithm_id, score, sum(hit) AS pos, count(*) - sum(hit) AS neg FROM scored GROUP BY ALL),
t AS (SELECT algorithm_id, pos, neg, sum(neg) OVER (PARTITION BY algorithm_id ORDER BY score) - neg AS below,
  sum(pos) OVER (PARTITION BY algorithm_id) AS p, sum(neg) OVER (PARTITION BY algorithm_id) AS q FROM v)
SELECT algorithm_id, round(sum(pos * (below + neg / 2)) / max(p * q), 9) AS auc FROM t GROUP BY algorithm_id""",
)
def auc(spark, sf):
    return measure.auc(coarse(spark, sf), "hit", "score", ["algorithm_id"]).withColumn("auc", F.round("auc", 9))


@query(
    "confusion_matrix",
    f"""WITH {APPLICATIONS}, p AS (SELECT decision AS actual, CASE WHEN score > 0.5 THEN 'invite' WHEN score > -0.15 THEN 'hold'
  ELSE 'reject' END AS predicted FROM apps), c(x) AS (VALUES ('invite'), ('hold'), ('reject'), ('never'))
SELECT a.x AS actual, b.x AS predicted, count(p.actual) AS n,
  CASE WHEN sum(count(p.actual)) OVER (PARTITION BY a.x) > 0 THEN count(p.actual) / sum(count(p.actual)) OVER (PARTITION BY a.x) END AS share
FROM c a CROSS JOIN c b LEFT JOIN p ON p.actual = a.x AND p.predicted = b.x GROUP BY a.x, b.x""",
)
def confusion_matrix(spark, sf):
    predicted = F.when(F.col("score") > 0.5, "invite").when(F.col("score") > -0.15, "hold").otherwise("reject")
    rows = applications(spark, sf).withColumn("predicted", predicted)
    return measure.confusion(rows, "decision", "predicted", ["invite", "hold", "reject", "never"], normalize=True)


@query(
    "confusion_matrix_missing_class",
    f"""WITH {APPLICATIONS}, p AS (SELECT nullif(decision, 'hold') AS actual, CASE WHEN score > 0.5 THEN 'invite' WHEN score < 0 THEN 'reject' END AS predicted FROM apps),
c(x) AS (VALUES ('invite'), ('reject')),
n AS (SELECT actual, predicted, count(*) AS n FROM p GROUP BY ALL)
SELECT actual, predicted, n FROM n UNION ALL SELECT a.x, b.x, 0 FROM c a, c b WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.actual = a.x AND n.predicted = b.x)""",
)
def confusion_matrix_missing_class(spark, sf):
    predicted = F.when(F.col("score") > 0.5, "invite").when(F.col("score") < 0, "reject")
    rows = applications(spark, sf).select(F.nullif(F.col("decision"), F.lit("hold")).alias("actual"), predicted.alias("predicted"))
    return measure.confusion(rows, "actual", "predicted", ["invite", "reject"])


@query(
    "hard_labels",
    f"WITH {COARSE} SELECT app_id, CAST(score >= 0.5 AS INTEGER) AS positive FROM scored",
)
def hard_labels(spark, sf):
    return coarse(spark, sf).select("app_id", measure.hard_label("score", 0.5).alias("positive"))


SMALL_GRID = {
    "imputer": {"strategy": ["mean"]},
    "variancethreshold": {"threshold": [0]},
    "randomforestclassifier": {"n_estimators": [5], "max_depth": [4], "max_features": ["sqrt"], "min_samples_split": [2]},
    "not a step": {"ignored": [1]},
}


def quality_rows(spark, sf):
    """Labelled documents with a text outcome, some features missing."""
    rows = labelled(spark, sf).drop("toxic")
    return rows.withColumns(
        {
            "outcome": F.when(F.col("quality") == 1, "good").otherwise("bad"),
            "n_chars": F.when(F.col("doc_id") % 10 != 0, F.col("n_chars")),
        }
    ).drop("quality")


@query(
    "forest_scores",
    f"""WITH {LABELLED} SELECT doc_id, CASE quality WHEN 1 THEN 'good' ELSE 'bad' END AS outcome, true AS is_probability FROM labelled""",
)
def forest_scores(spark, sf):
    rows = quality_rows(spark, sf)
    parts = stratified_split(rows, "outcome", DOC_KEY)
    model = fit_forest(parts.filter("set = 'train'").drop("set"), "outcome", DOC_KEY, SMALL_GRID)
    path = fresh_path(spark, "models")
    save_model(model, path, 1)
    scored = score(load_model(path, 1), rows, DOC_KEY, "outcome")
    return scored.select("doc_id", "outcome", F.col("predicted_good").between(0, 1).alias("is_probability"))


FOLDS = f"""{LABELLED}, folded AS (SELECT doc_id, lang, n_chars, doc_id % 5 AS fold, CASE WHEN doc_id % 10 <> 0 THEN n_chars END AS gappy_chars,
  CAST(doc_id % 7 AS DOUBLE) AS weekday FROM labelled)"""


def folded(spark, sf):
    gappy = F.when(F.col("doc_id") % 10 != 0, F.col("n_chars")).alias("gappy_chars")
    return labelled(spark, sf).select("doc_id", "lang", "n_chars", (F.col("doc_id") % 5).alias("fold"), gappy, (F.col("doc_id") % 7).cast("double").alias("weekday"))


def of_folds(rows, fitted):
    """What ``fitted`` learns from the training rows of each fold, as one table."""
    parts = [fitted(rows.filter(F.col("fold") != k)).withColumn("fold", F.lit(k).cast("long")) for k in range(5)]
    return reduce(DataFrame.unionByName, parts)


@query(
    "imputed_values",
    f"""WITH {FOLDS}, parts AS (SELECT f.fold, v.* FROM folded v, (SELECT DISTINCT fold FROM folded) f WHERE v.fold <> f.fold),
long AS (SELECT fold, 'gappy_chars' AS variable, gappy_chars AS x FROM parts UNION ALL SELECT fold, 'weekday', weekday FROM parts),
counts AS (SELECT fold, variable, x, count(*) AS n FROM long WHERE x IS NOT NULL GROUP BY ALL),
often AS (SELECT fold, variable, x, row_number() OVER (PARTITION BY fold, variable ORDER BY n DESC, x) AS place FROM counts)
SELECT fold, variable, 'mean' AS strategy, round(avg(x), 6) AS value FROM long GROUP BY fold, variable
UNION ALL SELECT fold, variable, 'median', round(quantile_cont(x, 0.5), 6) FROM long GROUP BY fold, variable
UNION ALL SELECT fold, variable, 'mode', round(x, 6) FROM often WHERE place = 1""",
)
def imputed_values(spark, sf):
    columns = ["gappy_chars", "weekday"]

    def fitted(rows):
        found = [(c, s, float(v)) for s in STRATEGIES for c, v in GapFiller(columns, s).fit(rows).known().items()]
        return spark.createDataFrame(found, "variable string, strategy string, value double").withColumn("value", F.round("value", 6))

    return of_folds(folded(spark, sf), fitted)


@query(
    "features_above_variance",
    f"""WITH {FOLDS}, parts AS (SELECT f.fold, v.* FROM folded v, (SELECT DISTINCT fold FROM folded) f WHERE v.fold <> f.fold),
long AS (
  SELECT fold, 'weekday' AS feature, weekday AS x FROM parts
  {"".join(f" UNION ALL SELECT fold, 'lang_{x}', CAST(lang = '{x}' AS DOUBLE) FROM parts" for x in ("de", "en", "es", "fr"))}
  UNION ALL SELECT fold, 'lang_nan', 0 FROM parts),
t(threshold) AS (VALUES (0.0::DOUBLE), (0.1), (0.18), (1.0))
SELECT fold, threshold, feature FROM long, t GROUP BY ALL HAVING var_pop(x) > threshold""",
)
def features_above_variance(spark, sf):
    def fitted(rows):
        encoder = DummyEncoder(["lang"], "levels").fit(rows)
        names = ["weekday", *encoder.output_names()]
        vectors = VectorAssembler(inputCols=["weekday", "levels"], outputCol="all_features").transform(encoder.transform(rows))
        found = [(t, names[i]) for t in (0.0, 0.1, 0.18, 1.0) for i in VarianceFilter(t).fit(vectors).selectedFeatures]
        return spark.createDataFrame(found, "threshold double, feature string")

    return of_folds(folded(spark, sf), fitted)


@query("forest_grid_search")
def forest_grid_search(spark, sf):
    grid = {
        "imputer": {"strategy": ["mean"]},
        "variancethreshold": {"threshold": [0]},
        "randomforestclassifier": {"n_estimators": [10, 50], "max_depth": [1, 5], "max_features": ["sqrt"], "min_samples_split": [2]},
    }
    rows = quality_rows(spark, sf)
    model = fit_forest(rows, "outcome", DOC_KEY, grid, folds=5, parallelism=4)
    return measure.auc(
        score(model, rows, DOC_KEY, "outcome").withColumn("hit", (F.col("outcome") == "good").cast("int")), "hit", "predicted_good"
    ).withColumn("n_points", F.lit(len(model.avgMetrics)))


@query("forest_importances")
def forest_importances(spark, sf):
    model = fit_forest(quality_rows(spark, sf), "outcome", DOC_KEY, SMALL_GRID)
    return measure.importances(model, spark).limit(15)


@query("lasso_scores")
def lasso_scores(spark, sf):
    rows = quality_rows(spark, sf)
    parts = stratified_split(rows, "outcome", DOC_KEY)
    train, test = (parts.filter(F.col("set") == s).drop("set") for s in ("train", "test"))
    model = fit_lasso(train, "outcome", DOC_KEY, penalties=(0.1, 0.01), folds=2, parallelism=4, max_iter=20)
    return score(model, test, DOC_KEY, "outcome")


PLANTED = """planted AS (
  SELECT o_orderkey, CAST(o_orderkey % 2 AS DOUBLE) AS odd, CAST(o_orderkey % 3 = 0 AS DOUBLE) AS third, CAST(o_orderkey % 5 = 0 AS DOUBLE) AS fifth,
    CAST(o_orderkey % 13 AS DOUBLE) AS rest, CAST(4 * (o_orderkey % 2) - 3 * CAST(o_orderkey % 3 = 0 AS INTEGER) + 2 * CAST(o_orderkey % 5 = 0 AS INTEGER)
      + (o_orderkey * 31) % 101 / 20.0 > 4 AS INTEGER) AS y FROM orders)"""


@query(
    "lasso_path_entries",
    f"""WITH {PLANTED}, long AS (
  {" UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS x, y FROM planted" for c in ("odd", "third", "fifth", "rest"))}),
g AS (SELECT feature, covar_pop(x, y) / stddev_pop(x) AS slope FROM long GROUP BY feature)
SELECT CAST(row_number() OVER (ORDER BY abs(slope) DESC) AS INTEGER) AS place, feature, CAST(sign(slope) AS INTEGER) AS sign,
  round(max(abs(slope)) OVER (), 9) AS largest_penalty FROM g ORDER BY place LIMIT 3""",
)
def lasso_path_entries(spark, sf):
    k = F.col("o_orderkey")
    flag = lambda c: c.cast("double")
    noise = (k * 31) % 101 / 20.0
    hit = 4 * (k % 2) - 3 * (k % 3 == 0).cast("int") + 2 * (k % 5 == 0).cast("int") + noise > 4
    x = F.array(flag(k % 2), flag(k % 3 == 0), flag(k % 5 == 0), flag(k % 13))
    rows = load(spark, sf, "orders").select(x.alias("x"), hit.cast("int").alias("y"), F.pmod(F.xxhash64(k), F.lit(5)).cast("int").alias("fold")).persist()
    path = solve_path(rows, ["odd", "third", "fifth", "rest"], folds=5, penalties=25, lowest=0.05)
    rows.unpersist()
    found = [(place, name, sign) for place, name, sign, _ in path.entries() if place <= 3]
    out = spark.createDataFrame(found, "place int, feature string, sign int")
    return out.withColumn("largest_penalty", F.round(F.lit(float(path.penalties[0])), 9))


@query("lasso_path_scores")
def lasso_path_scores(spark, sf):
    rows = quality_rows(spark, sf)
    fitted = fit_lasso_path(rows, "outcome", DOC_KEY, folds=5, penalties=12)
    at = F.lit(fitted.path.one_standard_error).alias("place_of_penalty")
    return fitted.score(rows, DOC_KEY, at=fitted.path.one_standard_error, keep=["outcome"]).select("*", at)


MODEL_CTE = f"""{APPLICATIONS}, {PEOPLE}, waiting AS (
  SELECT a.person_id, a.app_id, p.segment FROM apps a JOIN people p USING (person_id)
  WHERE a.app_year >= 2000 AND NOT coalesce(a.priority = '5-LOW', false))"""


def model_tables(spark, sf):
    apps = applications(spark, sf)
    about = people(spark, sf).select("person_id", "segment", "home", "balance")
    joined = apps.join(about, ["person_id"], "left")
    phase = F.when(F.col("app_year") < 2000, "fit").otherwise("predict").alias("fit_or_predict")
    return {
        "cohort": joined.select(*KEY, F.coalesce("segment", F.lit("none")).alias("segment"), phase),
        "decision": apps.filter("app_year < 2000").select(*KEY, F.col("decision").alias("outcome")),
        "current": apps.filter("app_year >= 2000").select(*KEY),
        "application": apps.select(*KEY, "price", "priority", "app_year"),
        "person": joined.select(*KEY, "home", "balance", "segment"),
    }


def specification(name, segments):
    features = {"application": ("app_year",), "person": ("segment",)}
    return ModelSpec(name, "cohort", "segment", tuple(segments), "decision", "current", features)


def scored_before(spark, sf, algorithm_id):
    apps = applications(spark, sf)
    return apps.filter("priority = '5-LOW'").select(*KEY, F.lit(algorithm_id).cast("long").alias("algorithm_id"))


def trained(spark, sf, spec, tables):
    # the blocks are unique on the order key by construction
    matrix = training_matrix(spec, tables, KEY, unique=False)
    return best_pipeline(fit_forest(matrix, "outcome", KEY, SMALL_GRID))


MATRIX_SQL = f"""{APPLICATIONS}, {PEOPLE}, members AS (
  SELECT a.person_id, a.app_id, a.price, a.priority, p.home, p.balance, a.decision, a.app_year, coalesce(p.segment, 'none') AS segment
  FROM apps a LEFT JOIN people p USING (person_id))"""


@query(
    "training_matrix",
    f"""WITH {MATRIX_SQL} SELECT person_id, app_id, decision AS outcome, price, priority, home, balance FROM members
WHERE app_year < 2000 AND segment IN ('BUILDING', 'HOUSEHOLD')""",
)
def training_rows_of_a_specification(spark, sf):
    return training_matrix(specification("a", ["BUILDING", "HOUSEHOLD"]), model_tables(spark, sf), KEY, unique=False)


@query(
    "scoring_matrix",
    f"""WITH {MATRIX_SQL} SELECT person_id, app_id, price, priority, home, balance FROM members
WHERE app_year >= 2000 AND segment IN ('BUILDING', 'HOUSEHOLD') AND NOT coalesce(priority = '5-LOW', false)""",
)
def scoring_rows_of_a_specification(spark, sf):
    spec = specification("a", ["BUILDING", "HOUSEHOLD"])
    return scoring_matrix(spec, model_tables(spark, sf), scored_before(spark, sf, 7), 7, KEY, unique=False)


@query(
    "training_run",
    f"""WITH {MATRIX_SQL}, cohort AS (SELECT person_id, app_id, decision FROM members WHERE app_year < 2000 AND segment IN ('BUILDING', 'HOUSEHOLD')),
parts AS ({split_sql("cohort", "decision", "person_id, app_id", "CAST(person_id AS VARCHAR) || '|' || CAST(app_id AS VARCHAR)")})
SELECT person_id, app_id, decision AS outcome, "set", CAST(1 AS BIGINT) AS algorithm_id, true AS sums_to_one, 'a' AS model,
  'application.price, application.priority, person.balance, person.home' AS details FROM parts""",
)
def training_run(spark, sf):
    root = fresh_path(spark, "training")
    run = train_model(
        specification("a", ["BUILDING", "HOUSEHOLD"]), model_tables(spark, sf), empty_registry(spark), f"{root}/models", f"{root}/results", SMALL_GRID, key=KEY, unique=False
    )
    stored = spark.read.parquet(run.results_path).withColumn("algorithm_id", F.col("algorithm_id").cast("long"))
    total = sum(F.col(f"predicted_{c}") for c in class_labels(load_model(f"{root}/models", run.algorithm_id)))
    named = run.registry.select(F.col("id").alias("algorithm_id"), F.col("name").alias("model"), F.array_join("details", ", ").alias("details"))
    return stored.join(named, "algorithm_id").select(*KEY, "outcome", "set", "algorithm_id", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), "model", "details")


@query(
    "score_new_rows",
    f"""WITH {MODEL_CTE} SELECT person_id, app_id, CAST(7 AS BIGINT) AS algorithm_id, true AS sums_to_one, true AS is_difference
FROM waiting WHERE segment IN ('BUILDING', 'HOUSEHOLD')""",
)
def score_new_rows(spark, sf):
    tables, spec = model_tables(spark, sf), specification("a", ["BUILDING", "HOUSEHOLD"])
    model = trained(spark, sf, spec, tables)
    scored = score_new(spec, model, 7, tables, scored_before(spark, sf, 7), ("invite", "reject"), KEY, unique=False)
    total = sum(F.col(f"predicted_{c}") for c in class_labels(model))
    return scored.select(
        *KEY,
        "algorithm_id",
        (F.abs(total - 1) < 1e-9).alias("sums_to_one"),
        (F.abs(F.col("score") - (F.col("predicted_invite") - F.col("predicted_reject"))) <= 0.0051).alias("is_difference"),
    )


@query(
    "multi_model_scores",
    f"""WITH {MODEL_CTE} SELECT person_id, app_id, CAST(CASE segment WHEN 'BUILDING' THEN 1 ELSE 2 END AS BIGINT) AS algorithm_id
FROM waiting WHERE segment IN ('BUILDING', 'HOUSEHOLD')""",
)
def multi_model_scores(spark, sf):
    tables = model_tables(spark, sf)
    models = {}
    for algorithm_id, (name, segment) in enumerate((("a", "BUILDING"), ("b", "HOUSEHOLD")), 1):
        spec = specification(name, [segment])
        models[name] = (spec, trained(spark, sf, spec, tables), algorithm_id)
    before = scored_before(spark, sf, 1).unionByName(scored_before(spark, sf, 2))
    return score_by_cohort(models, tables, before, key=KEY, unique=False).select(*KEY, "algorithm_id")


@query(
    "explanations",
    f"""WITH {LABELLED} SELECT doc_id, count(*) AS n_features, true AS weights_known FROM labelled, range(3) GROUP BY doc_id""",
)
def explanations(spark, sf):
    rows = quality_rows(spark, sf).drop("gappy")
    model = fit_forest(rows, "outcome", DOC_KEY, SMALL_GRID)
    background = Background.of(rows, ["n_chars"], list(encoder_of(model).known()))
    found = explain(model, rows, background, n_features=5, n_samples=100, key=DOC_KEY)
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_features"), F.bool_and(F.col("weight").isNotNull()).alias("weights_known")
    )


@query(
    "streamed_scores",
    """SELECT o_custkey AS person_id, o_orderkey AS app_id, o_totalprice / 500000 AS predicted_high, CAST(9 AS BIGINT) AS algorithm_id FROM orders""",
)
def streamed_scores(spark, sf):
    orders = load(spark, sf, "orders")
    root, checkpoint = fresh_path(spark, "stream"), fresh_path(spark, "stream-state")
    stored = "person_id bigint, app_id bigint, predicted_high double"

    def keyed(batch):
        return batch.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("app_id"), "o_totalprice")

    def scorer(rows):
        return rows.select(*KEY, (F.col("o_totalprice") / 500000).alias("predicted_high"))

    for _ in range(2):  # the second pass finds nothing new
        stream = score_stream(
            spark, f"{sf}/orders.parquet*", orders.schema, scorer, root, stored, checkpoint, 9, KEY, prepare=keyed
        )
        stream.awaitTermination()
    return stored_predictions(spark, root, stored).drop("run")
