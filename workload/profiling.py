"""Summaries, categories, missingness, correlations, contingency tables, histograms."""

from pyspark.sql import functions as F

from rollcall.operators import profile, tabulate
from rollcall.plans import reports
from rollcall.plans.describe import describe_table
from workload.inputs import APPLICATIONS, applications, load
from workload.registry import query

STATS = """count(value) AS n, {r}(min(value){d}) AS min, {r}(quantile_cont(value, 0.25){d}) AS q25,
  {r}(quantile_cont(value, 0.5){d}) AS median, {r}(avg(value){d}) AS mean, {r}(quantile_cont(value, 0.75){d}) AS q75,
  {r}(max(value){d}) AS max, {r}(stddev_samp(value){d}) AS sd"""


def stats(digits: int) -> str:
    return STATS.format(r="round", d=f", {digits}")


@query(
    "numeric_summaries",
    f"""WITH long AS (
  SELECT 'l_quantity' AS variable, l_returnflag, CASE WHEN l_linestatus = 'O' THEN l_quantity END AS value FROM lineitem
  UNION ALL SELECT 'l_extendedprice', l_returnflag, l_extendedprice FROM lineitem
  UNION ALL SELECT 'l_discount', l_returnflag, l_discount FROM lineitem)
SELECT variable, l_returnflag, {stats(6)} FROM long GROUP BY ALL""",
)
def numeric_summaries(spark, sf):
    lines = load(spark, sf, "lineitem").withColumn("l_quantity", F.when(F.col("l_linestatus") == "O", F.col("l_quantity")))
    return profile.summaries(lines, "l_returnflag", digits=6, columns=["l_quantity", "l_extendedprice", "l_discount"])


@query("numeric_summaries_approximate")
def numeric_summaries_approximate(spark, sf):
    return profile.summaries(
        load(spark, sf, "lineitem"), "l_returnflag", columns=["l_quantity", "l_extendedprice"], approx=True
    )


@query(
    "date_summaries",
    """WITH m AS (SELECT 'ts' AS variable, event_type, epoch_us(ts) AS us, ts FROM events)
SELECT variable, event_type, count(*) AS n, min(ts) AS min,
  make_timestamp(CAST(trunc(quantile_cont(CAST(us AS DOUBLE), 0.25)) AS BIGINT)) AS q25,
  make_timestamp(CAST(trunc(quantile_cont(CAST(us AS DOUBLE), 0.5)) AS BIGINT)) AS median,
  date_trunc('second', make_timestamp(CAST(trunc(avg(us)) AS BIGINT))) AS mean,
  make_timestamp(CAST(trunc(quantile_cont(CAST(us AS DOUBLE), 0.75)) AS BIGINT)) AS q75, max(ts) AS max,
  round(stddev_samp(us) / 1e6, 0) AS sd FROM m GROUP BY ALL""",
)
def date_summaries(spark, sf):
    found = profile.summaries(load(spark, sf, "events"), "event_type", kind="time", digits=0, columns=["ts"])
    plain = {c: F.col(c).cast("timestamp_ntz") for c in ("min", "q25", "median", "q75", "max")}
    return found.withColumns({**plain, "mean": F.date_trunc("second", "mean").cast("timestamp_ntz")})


@query(
    "custom_summaries",
    """SELECT event_type, round(min(value), 2) AS value_low, round(max(value), 2) AS value_high,
  round(avg(value), 4) AS value_mean, count(value) AS value_n, CAST(min(user_id) AS DOUBLE) AS user_id_low,
  CAST(max(user_id) AS DOUBLE) AS user_id_high, round(avg(user_id), 4) AS user_id_mean, count(user_id) AS user_id_n
FROM events GROUP BY event_type""",
)
def custom_summaries(spark, sf):
    functions = {
        "low": lambda c: F.round(F.min(c).cast("double"), 2),
        "high": lambda c: F.round(F.max(c).cast("double"), 2),
        "mean": lambda c: F.round(F.avg(c), 4),
        "n": F.count,
    }
    return profile.wide_summaries(load(spark, sf, "events"), "event_type", ["value", "user_id"], functions)


@query(
    "score_by_outcome",
    f"""WITH {APPLICATIONS} SELECT decision, round(avg(score), 10) AS mean, round(quantile_cont(score, 0.25), 10) AS q25,
  round(quantile_cont(score, 0.5), 10) AS median, round(quantile_cont(score, 0.75), 10) AS q75 FROM apps GROUP BY decision""",
)
def score_by_outcome(spark, sf):
    found = reports.score_by_outcome(applications(spark, sf), "score", "decision")
    return found.select("decision", *[F.round(c, 10).alias(c) for c in ("mean", "q25", "median", "q75")])


@query(
    "overall_quantiles",
    """SELECT round(avg(value), 6) AS mean, round(quantile_cont(value, 0.0), 6) AS p0, round(quantile_cont(value, 0.5), 6) AS p50,
  round(quantile_cont(value, 0.99), 6) AS p99, round(quantile_cont(value, 1.0), 6) AS p100 FROM events""",
)
def overall_quantiles(spark, sf):
    probs = {"p0": 0.0, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    found = profile.group_quantiles(load(spark, sf, "events"), "value", None, probs)
    return found.select(*[F.round(c, 6).alias(c) for c in ("mean", *probs)])


LONG_TEXT = """long AS (
  SELECT 'status' AS variable, app_year, status AS value FROM apps
  UNION ALL SELECT 'decision', app_year, decision FROM apps
  UNION ALL SELECT 'priority', app_year, priority FROM apps
  UNION ALL SELECT 'set', app_year, "set" FROM apps)"""


@query(
    "n_distinct",
    f"WITH {APPLICATIONS}, {LONG_TEXT} SELECT variable, app_year, count(DISTINCT value) AS n_distinct FROM long GROUP BY ALL",
)
def n_distinct(spark, sf):
    return profile.n_distinct(applications(spark, sf), "app_year")


@query(
    "category_shares",
    f"""WITH {APPLICATIONS}, {LONG_TEXT}, c AS (SELECT variable, app_year, value, count(*) AS n FROM long GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY variable, app_year), 3) AS share FROM c""",
)
def category_shares(spark, sf):
    return profile.category_shares(applications(spark, sf), "app_year")


@query(
    "category_shares_top_n",
    """WITH long AS (
  SELECT 'source' AS variable, lang, nullif(source, 'src3') AS value FROM documents
  UNION ALL SELECT 'half', lang, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END FROM documents),
c AS (SELECT variable, lang, value, count(*) AS n FROM long GROUP BY ALL),
s AS (SELECT *, round(n / sum(n) OVER (PARTITION BY variable, lang), 3) AS share FROM c),
o AS (SELECT variable, value, row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, value) AS place
  FROM long WHERE value IS NOT NULL GROUP BY variable, value),
k AS (SELECT variable, count(DISTINCT value) + max(CASE WHEN value IS NULL THEN 1 ELSE 0 END) AS n_values FROM long GROUP BY 1)
SELECT s.* FROM s JOIN k USING (variable) LEFT JOIN o ON s.variable = o.variable AND s.value = o.value
WHERE n_values <= 5 OR place <= 5""",
)
def category_shares_top_n(spark, sf):
    docs = load(spark, sf, "documents").select(
        "lang",
        F.nullif(F.col("source"), F.lit("src3")).alias("source"),
        F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd").alias("half"),
    )
    return profile.category_shares(docs, "lang", top_n=5)


@query(
    "binary_shares",
    """WITH j AS (SELECT d.lang, l.quality, CASE WHEN l.doc_id % 9 <> 0 THEN l.toxic END AS toxic FROM labels l JOIN documents d USING (doc_id)),
long AS (SELECT 'quality' AS variable, lang, CAST(quality AS VARCHAR) AS value FROM j
  UNION ALL SELECT 'toxic', lang, CAST(toxic AS VARCHAR) FROM j),
c AS (SELECT variable, lang, value, count(*) AS n FROM long GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY variable, lang), 3) AS share FROM c""",
)
def binary_shares(spark, sf):
    rows = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "lang", "n_chars"), "doc_id")
    rows = rows.withColumn("toxic", F.when(F.col("doc_id") % 9 != 0, F.col("toxic")))
    return profile.binary_shares(rows, ["doc_id"], "lang")


GAPS = """gaps AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS y, o_orderkey, nullif(o_orderpriority, '1-URGENT') AS priority,
  CASE WHEN o_custkey % 7 <> 0 THEN o_totalprice END AS price, nullif(o_orderstatus, 'P') AS status FROM orders)"""


def gaps(spark, sf):
    return load(spark, sf, "orders").select(
        F.year("o_orderdate").alias("y"),
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_totalprice")).alias("price"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("status"),
    )


@query(
    "pct_missing",
    f"""WITH {GAPS} SELECT y, 'o_orderkey' AS variable, round(100 * avg(CAST(o_orderkey IS NULL AS INT)), 1) AS pct_missing FROM gaps GROUP BY y
UNION ALL SELECT y, 'priority', round(100 * avg(CAST(priority IS NULL AS INT)), 1) FROM gaps GROUP BY y
UNION ALL SELECT y, 'price', round(100 * avg(CAST(price IS NULL AS INT)), 1) FROM gaps GROUP BY y
UNION ALL SELECT y, 'status', round(100 * avg(CAST(status IS NULL AS INT)), 1) FROM gaps GROUP BY y""",
)
def pct_missing(spark, sf):
    return profile.pct_missing(gaps(spark, sf), "y")


@query(
    "complete_cases",
    f"""WITH {GAPS}, c AS (SELECT y, CAST(priority IS NOT NULL AND price IS NOT NULL AND status IS NOT NULL AS INT) AS ok FROM gaps)
SELECT y, round(100 * avg(ok), 4) AS pct_complete FROM c GROUP BY y UNION ALL SELECT NULL, round(100 * avg(ok), 4) FROM c""",
)
def complete_cases(spark, sf):
    by_year = profile.complete_cases(gaps(spark, sf), "y", 4)
    return by_year.unionByName(profile.complete_cases(gaps(spark, sf), None, 4), allowMissingColumns=True)


@query(
    "missing_patterns",
    f"""WITH {GAPS} SELECT CAST(priority IS NULL AS INT) AS priority, CAST(price IS NULL AS INT) AS price,
  CAST(status IS NULL AS INT) AS status, count(*) AS n FROM gaps GROUP BY ALL""",
)
def missing_patterns(spark, sf):
    return profile.missing_patterns(gaps(spark, sf), ["priority", "price", "status"])


@query(
    "null_counts",
    f"""WITH {GAPS} SELECT 'y' AS variable, count(*) - count(y) AS n_missing FROM gaps
UNION ALL SELECT 'o_orderkey', count(*) - count(o_orderkey) FROM gaps
UNION ALL SELECT 'priority', count(*) - count(priority) FROM gaps
UNION ALL SELECT 'price', count(*) - count(price) FROM gaps
UNION ALL SELECT 'status', count(*) - count(status) FROM gaps""",
)
def null_counts(spark, sf):
    return profile.null_counts(gaps(spark, sf))


MEASURES = ("l_quantity", "l_extendedprice", "price_with_gaps")
MEASURED = """m AS (SELECT l_quantity, l_extendedprice, CAST(year(l_shipdate) AS INTEGER) AS y,
  CASE WHEN l_returnflag <> 'R' THEN l_extendedprice * (1 - l_discount) END AS price_with_gaps FROM lineitem)"""


def measured(spark, sf):
    price = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return load(spark, sf, "lineitem").select(
        "l_quantity",
        "l_extendedprice",
        F.year("l_shipdate").alias("y"),
        F.when(F.col("l_returnflag") != "R", price).alias("price_with_gaps"),
    )


def corr_sql(by: str) -> str:
    keys, group = (f"{by}, ", f" GROUP BY {by}") if by else ("", "")
    parts = [
        f"SELECT {keys}'{x}' AS x, '{y}' AS y_, round(corr({x}, {y}), 3) AS r FROM m{group}" for x in MEASURES for y in MEASURES
    ]
    return f"WITH {MEASURED}, c AS ({' UNION ALL '.join(parts)}) SELECT {keys}x, y_ AS other, CASE WHEN NOT isnan(r) THEN r END AS r FROM c"


@query("corr_matrix", corr_sql(""))
def corr_matrix(spark, sf):
    return profile.correlations(measured(spark, sf), columns=MEASURES).withColumnRenamed("y", "other")


@query("corr_by_year", corr_sql("y").replace("SELECT y, x,", "SELECT y AS ship_year, x,"))
def corr_by_year(spark, sf):
    rows = measured(spark, sf).withColumnRenamed("y", "ship_year")
    return profile.correlations(rows, "ship_year", columns=MEASURES).withColumnRenamed("y", "other")


@query(
    "crosstab_two_way",
    "SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) / (SELECT count(*) FROM lineitem) AS share FROM lineitem GROUP BY ALL",
)
def crosstab_two_way(spark, sf):
    return tabulate.crosstab2(load(spark, sf, "lineitem"), "l_returnflag", "l_linestatus", as_share=True)


@query(
    "crosstab_three_way",
    """SELECT l_returnflag, count(*) FILTER (l_linestatus = 'F') AS F, count(*) FILTER (l_linestatus = 'O') AS O,
  count(*) FILTER (l_linestatus = 'X') AS X FROM lineitem WHERE l_quantity > 25 GROUP BY l_returnflag""",
)
def crosstab_three_way(spark, sf):
    lines = load(spark, sf, "lineitem")
    return reports.decision_slice(lines, "l_returnflag", "l_linestatus", ["F", "O", "X"], F.col("l_quantity") > 25)


@query("value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def value_counts(spark, sf):
    return tabulate.value_counts(load(spark, sf, "events"), "event_type")


@query(
    "histogram",
    f"""WITH {APPLICATIONS}, b AS (SELECT CASE WHEN score < -0.9 THEN 0 WHEN score = 0.9 THEN 25 WHEN score > 0.9 THEN 26
  ELSE floor((score - -0.9) / (0.9 - -0.9) * 25) + 1 END AS bin FROM apps)
SELECT CAST(bin AS BIGINT) AS bin, count(*) AS n FROM b GROUP BY 1""",
)
def histogram(spark, sf):
    return profile.histogram(applications(spark, sf), "score", -0.9, 0.9, 25)


@query(
    "bin2d",
    """SELECT CAST(floor(a.o_totalprice / 25000) AS BIGINT) AS bin_x, CAST(floor(b.total / 25000) AS BIGINT) AS bin_y, count(*) AS n
FROM orders a JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS total FROM lineitem GROUP BY 1) b ON a.o_orderkey = b.l_orderkey
GROUP BY 1, 2""",
)
def bin2d(spark, sf):
    a = load(spark, sf, "orders").select("o_orderkey", F.col("o_totalprice").alias("score_a"))
    b = load(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    b = b.agg(F.round(F.sum("l_extendedprice"), 2).alias("score_b"))
    return reports.compare_scores(a, b, "score_a", "score_b", 25000, ["o_orderkey"])


def report_part(name: str, sql: str | None):
    @query(f"descriptive_report_{name}", sql)
    def run(spark, sf):
        rows = applications(spark, sf).drop("algorithm_id", "score", "decision")
        return describe_table(rows, "app_year", ("person_id", "app_id"), digits=6, only=[name])[name]

    run.__module__ = __name__
    return run


report_part(
    "summaries",
    f"WITH {APPLICATIONS}, long AS (SELECT 'price' AS variable, app_year, price AS value FROM apps) "
    f"SELECT variable, app_year, {stats(6)} FROM long GROUP BY ALL",
)
report_part("time_summaries", None)
report_part(
    "category_shares",
    f"""WITH {APPLICATIONS}, {LONG_TEXT}, c AS (SELECT variable, app_year, value, count(*) AS n FROM long
  WHERE variable <> 'decision' GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY variable, app_year), 6) AS share FROM c""",
)
report_part(
    "missing_patterns",
    f"""WITH {APPLICATIONS} SELECT 0 AS person_id, 0 AS app_id, 0 AS app_year, 0 AS app_date, 0 AS status,
  CAST(priority IS NULL AS INT) AS priority, 0 AS price, 0 AS "set", count(*) AS n FROM apps GROUP BY ALL""",
)


REPORT = f"""{APPLICATIONS}, r AS (SELECT person_id, app_id, app_year, status, priority, price, score, CAST(price > 200000 AS INTEGER) AS is_large,
  CASE WHEN priority IS NOT NULL THEN CAST(status = 'P' AS DOUBLE) END AS is_p FROM apps)"""
REPORT_COLUMNS = ["person_id", "app_id", "app_year", "status", "priority", "price", "score", "is_large", "is_p"]
REPORT_NUMBERS = ["price", "score", "is_large", "is_p"]


def wide_report_part(name: str, sql: str):
    """A part of the report on a table with flags, Y/N texts and several numbers."""

    @query(f"descriptive_report_{name}", f"WITH {REPORT} {sql}")
    def run(spark, sf):
        yes = F.when(F.col("status") == "P", "Y").otherwise("N")
        rows = applications(spark, sf).select(
            "person_id", "app_id", "app_year", "status", "priority", "price", "score",
            (F.col("price") > 200000).cast("int").alias("is_large"), F.when(F.col("priority").isNotNull(), yes).alias("is_p"),
        )
        return describe_table(rows, "app_year", ("person_id", "app_id"), digits=6, only=[name])[name]

    run.__module__ = __name__
    return run


REPORT_TYPES = dict(zip(REPORT_COLUMNS, ["bigint", "bigint", "int", "string", "string", "double", "double", "int", "double"]))
wide_report_part(
    "variable_types",
    " UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{t}' AS type, CAST(count(DISTINCT {c}) + (count(*) > count({c}))::INT <= 2 AS INTEGER) AS is_binary FROM r" for c, t in REPORT_TYPES.items()
    ),
)
wide_report_part(
    "pct_missing",
    " UNION ALL ".join(
        f"SELECT app_year, '{c}' AS variable, round(avg(CAST({c} IS NULL AS INTEGER)) * 100, 1) AS pct_missing FROM r GROUP BY app_year" for c in REPORT_COLUMNS if c != "app_year"
    ),
)
wide_report_part(
    "complete_cases",
    f"SELECT app_year, avg(CAST({' AND '.join(f'{c} IS NOT NULL' for c in REPORT_COLUMNS)} AS INTEGER)) * 100 AS pct_complete FROM r GROUP BY app_year",
)
wide_report_part(
    "n_distinct",
    " UNION ALL ".join(f"SELECT '{c}' AS variable, app_year, count(DISTINCT {c}) AS n_distinct FROM r GROUP BY app_year" for c in ("status", "priority")),
)
wide_report_part(
    "correlations",
    " UNION ALL ".join(f"""SELECT '{x}' AS x, '{y}' AS "y", round(corr({x}, {y}), 6) AS r FROM r""" for x in REPORT_NUMBERS for y in REPORT_NUMBERS),
)
wide_report_part(
    "correlations_by_group",
    " UNION ALL ".join(f"""SELECT app_year, '{x}' AS x, '{y}' AS "y", round(corr({x}, {y}), 6) AS r FROM r GROUP BY app_year""" for x in REPORT_NUMBERS for y in REPORT_NUMBERS),
)
wide_report_part(
    "binary_shares",
    """, long AS (SELECT 'is_large' AS variable, app_year, CAST(is_large AS VARCHAR) AS value FROM r UNION ALL SELECT 'is_p', app_year, CAST(is_p AS VARCHAR) FROM r),
c AS (SELECT variable, app_year, value, count(*) AS n FROM long GROUP BY ALL)
SELECT *, round(n / sum(n) OVER (PARTITION BY variable, app_year), 6) AS share FROM c""",
)
