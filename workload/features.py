"""Feature tables, outcomes and the joined matrix."""

from pyspark.sql import functions as F

from rollcall.functions.rules import not_in_set
from rollcall.operators.features import bucket_counts as count_buckets
from rollcall.operators.features import level_trend as trend
from rollcall.plans import cohorts, feature_sets, outcomes
from rollcall.session import fresh_path
from rollcall.sources.sinks import write_tables
from rollcall.sources.tables import TableName, stack_rows
from workload.inputs import APPLICATIONS, PERSON_YEAR, applications, load
from workload.registry import query

LEVELS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")
PAIRS = {
    "second_higher": (LEVELS[1], LEVELS[0]),
    "third_higher": (LEVELS[2], LEVELS[1]),
    "fourth_higher": (LEVELS[3], LEVELS[2]),
}
AVERAGES = """averages AS (
  SELECT o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS app_year, o_orderpriority AS level,
    min(o_totalprice) AS total_gpa, CAST(count(*) AS DOUBLE) AS total_hours, max(o_totalprice) AS science_gpa
  FROM orders GROUP BY ALL)"""


def averages(spark, sf):
    orders = load(spark, sf, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.year("o_orderdate").alias("app_year"),
        F.col("o_orderpriority").alias("level"),
        "o_totalprice",
    )
    return orders.groupBy(*PERSON_YEAR, "level").agg(
        F.min("o_totalprice").alias("total_gpa"),
        F.count(F.lit(1)).cast("double").alias("total_hours"),
        F.max("o_totalprice").alias("science_gpa"),
    )


def trend_sql(value: str, prefix: str) -> str:
    return f"""SELECT person_id, app_year,
  CAST(max(CASE WHEN level LIKE '2%' THEN {value} END) > max(CASE WHEN level LIKE '1%' THEN {value} END) AS INTEGER) AS {prefix}second_higher,
  CAST(max(CASE WHEN level LIKE '3%' THEN {value} END) > max(CASE WHEN level LIKE '2%' THEN {value} END) AS INTEGER) AS {prefix}third_higher,
  CAST(max(CASE WHEN level LIKE '4%' THEN {value} END) > max(CASE WHEN level LIKE '3%' THEN {value} END) AS INTEGER) AS {prefix}fourth_higher
FROM averages WHERE level <> '5-LOW' GROUP BY person_id, app_year"""


@query("level_trend", f"WITH {AVERAGES} {trend_sql('total_gpa', '')}")
def level_trend(spark, sf):
    return trend(averages(spark, sf), "level", "total_gpa", LEVELS, PAIRS)


@query(
    "grade_point_features",
    f"""WITH {AVERAGES}, kept AS (SELECT * FROM averages WHERE level <> '3-MEDIUM'), trends AS ({trend_sql('total_gpa', 'total_')})
SELECT b.person_id, b.app_year, b.total_gpa AS total_gpa_cumulative, b.science_gpa AS science_gpa_cumulative,
  l.science_gpa AS science_gpa_later, t.total_second_higher,
  coalesce(CAST(l.total_hours >= 2 AS INTEGER), 0) AS did_later, coalesce(CAST(g.total_hours >= 2 AS INTEGER), 0) AS did_further
FROM kept b LEFT JOIN (SELECT * FROM kept WHERE level = '2-HIGH') l USING (person_id, app_year)
LEFT JOIN (SELECT * FROM kept WHERE level = '1-URGENT') g USING (person_id, app_year)
LEFT JOIN trends t USING (person_id, app_year)
WHERE b.level = '5-LOW'""",
)
def grade_point_features(spark, sf):
    return feature_sets.grade_point_features(
        averages(spark, sf),
        "level",
        excluded="3-MEDIUM",
        overall=("5-LOW", ["total_gpa", "science_gpa"]),
        later=("2-HIGH", "total_hours", ["science_gpa"]),
        further=("1-URGENT", "total_hours", "did_further"),
        values={"total_gpa": {"total_second_higher": PAIRS["second_higher"]}},
        levels=LEVELS,
        hours=2,
    )


BUCKETS = {"a_counts": ["A", "A-"], "b_counts": ["N"], "f_counts": ["R"]}


def records(spark, sf):
    lines, parts = load(spark, sf, "lineitem"), load(spark, sf, "part")
    joined = lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(
        F.col("l_suppkey").alias("person_id"),
        F.year("l_shipdate").alias("app_year"),
        F.nullif(F.col("l_linestatus"), F.lit("X")).alias("level"),
        (F.col("p_size") <= 25).cast("int").alias("is_science"),
        F.when(F.col("l_quantity") > 2, F.col("l_returnflag")).alias("grade"),
        F.col("p_type").alias("class"),
    )


RECORDS = """records AS (
  SELECT l_suppkey AS person_id, CAST(year(l_shipdate) AS INTEGER) AS app_year, nullif(l_linestatus, 'X') AS level,
    CAST(p_size <= 25 AS INTEGER) AS is_science, CASE WHEN l_quantity > 2 THEN l_returnflag END AS grade, p_type AS class
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""


def count_sql(condition: str, prefix: str) -> str:
    return ", ".join(
        f"count(*) FILTER ({condition} AND grade IN ({', '.join(repr(c) for c in codes)})) AS {prefix}{name}"
        for name, codes in BUCKETS.items()
    )


@query(
    "bucket_counts",
    f"WITH {RECORDS} SELECT person_id, app_year, {count_sql('true', '')} FROM records GROUP BY ALL",
)
def bucket_counts(spark, sf):
    return count_buckets(records(spark, sf), "grade", BUCKETS)


CLASSES = ("ECONOMY", "SMALL", "PROMO", "NOT THERE")


@query(
    "bucket_counts_by_class",
    f"""WITH {RECORDS} SELECT person_id, app_year, {count_sql('true', 'science_')},
  {', '.join(count_sql(f"class = '{c}'", f'"{c.lower()}_').replace(' AS "', ' AS "').replace('_counts', '_counts"') for c in CLASSES)}
FROM records WHERE NOT coalesce(level IN ('F'), false) AND is_science = 1 GROUP BY person_id, app_year""",
)
def bucket_counts_by_class(spark, sf):
    return feature_sets.grade_count_features(
        records(spark, sf), "level", ["F"], "is_science", "grade", BUCKETS, "class", CLASSES
    )


@query(
    "star_design_matrix",
    f"""WITH {AVERAGES}, {RECORDS}, base AS (
  SELECT DISTINCT o_custkey AS person_id, CAST(year(o_orderdate) AS INTEGER) AS app_year,
    CAST(max(o_orderstatus) OVER (PARTITION BY o_custkey, year(o_orderdate)) AS VARCHAR) AS outcome FROM orders),
counts AS (SELECT person_id, app_year, {count_sql('true', '')} FROM records GROUP BY ALL),
best AS (SELECT person_id, app_year, max(total_gpa) AS best FROM averages GROUP BY ALL)
SELECT * FROM base LEFT JOIN counts USING (person_id, app_year) LEFT JOIN best USING (person_id, app_year)""",
)
def star_design_matrix(spark, sf):
    orders = load(spark, sf, "orders")
    base = orders.groupBy(F.col("o_custkey").alias("person_id"), F.year("o_orderdate").alias("app_year")).agg(
        F.max("o_orderstatus").alias("outcome")
    )
    best = averages(spark, sf).groupBy(*PERSON_YEAR).agg(F.max("total_gpa").alias("best"))
    counts = count_buckets(records(spark, sf), "grade", BUCKETS)
    return feature_sets.design_matrix(base, {"counts": counts, "best": best}, PERSON_YEAR)


APP_KEY = ("app_id", "app_year")


@query(
    "outcome_rank_bands",
    f"""WITH {APPLICATIONS}, r AS (
  SELECT app_id, app_year, percent_rank() OVER (ORDER BY price) AS p FROM apps WHERE app_year BETWEEN 1996 AND 2000)
SELECT app_id, app_year, CASE WHEN p <= 0.25 THEN 0 WHEN p <= 0.75 THEN 1 ELSE 2 END AS outcome FROM r""",
)
def outcome_rank_bands(spark, sf):
    return outcomes.banded(applications(spark, sf), "price", (1996, 2000), [0.25, 0.75], APP_KEY)


@query(
    "outcome_valid_years",
    f"""WITH {APPLICATIONS} SELECT app_id, app_year, coalesce(priority, 'none') AS outcome FROM apps WHERE app_year BETWEEN 1996 AND 1999""",
)
def outcome_valid_years(spark, sf):
    rows = outcomes.within_years(applications(spark, sf), "priority", (1996, 1999), APP_KEY)
    return outcomes.missing_as(rows, "none")


@query(
    "outcome_positive",
    f"""WITH {APPLICATIONS}, s AS (SELECT *, CASE WHEN status <> 'F' THEN score END AS s FROM apps)
SELECT app_id, app_year, CASE WHEN s > 0 THEN 1 WHEN s <= 0 THEN 0 END AS outcome FROM s WHERE app_year BETWEEN 1996 AND 1999""",
)
def outcome_positive(spark, sf):
    apps = applications(spark, sf).withColumn("s", F.when(F.col("status") != "F", F.col("score")))
    return outcomes.positive(apps, "s", (1996, 1999), APP_KEY)


@query(
    "outcome_recode",
    f"""WITH {APPLICATIONS}, c AS (SELECT app_id, app_year, TRY_CAST(left(priority, 1) AS INTEGER) + 1 AS code FROM apps)
SELECT app_id, app_year, CASE code WHEN 3 THEN 0 WHEN 4 THEN 1 WHEN 5 THEN 1 END AS outcome FROM c WHERE code IS NOT NULL""",
)
def outcome_recode(spark, sf):
    apps = applications(spark, sf).withColumn("code", F.substring("priority", 1, 1).try_cast("int") + 1)
    return outcomes.from_codes(apps, "code", {3: 0, 4: 1, 5: 1}, APP_KEY)


@query(
    "outcome_disjunctive",
    f"""WITH {APPLICATIONS}, t AS (
  SELECT app_id, app_year, CASE status WHEN 'P' THEN 1 WHEN 'O' THEN 0 END AS top, CASE WHEN priority IS NOT NULL THEN price / 500000 END AS difficulty FROM apps)
SELECT app_id, app_year, CASE WHEN top = 0 AND difficulty < 0.6 THEN 1 ELSE 0 END AS outcome FROM t
WHERE app_year BETWEEN 1996 AND 2000 AND top IS NOT NULL AND (top = 1 OR difficulty IS NOT NULL)""",
)
def outcome_disjunctive(spark, sf):
    apps = applications(spark, sf).withColumns(
        {
            "top": F.when(F.col("status") == "P", 1).when(F.col("status") == "O", 0),
            "difficulty": F.when(F.col("priority").isNotNull(), F.col("price") / 500000),
        }
    )
    return outcomes.weak_match(apps, "top", "difficulty", (1996, 2000), 0.6, APP_KEY)


@query(
    "outcome_special_class",
    f"""WITH {APPLICATIONS}, t AS (SELECT app_id, app_year, CASE status WHEN 'P' THEN 1 WHEN 'O' THEN 0 END AS top, priority FROM apps)
SELECT app_id, app_year, CASE WHEN priority = '2-HIGH' THEN 2 WHEN priority <> '2-HIGH' THEN top END AS outcome FROM t
WHERE app_year BETWEEN 1996 AND 2000 AND top IS NOT NULL""",
)
def outcome_special_class(spark, sf):
    apps = applications(spark, sf).withColumn("top", F.when(F.col("status") == "P", 1).when(F.col("status") == "O", 0))
    return outcomes.special_class(apps, "top", (1996, 2000), F.col("priority") == "2-HIGH", 2, APP_KEY)


@query(
    "program_population",
    f"""WITH {APPLICATIONS} SELECT app_id, status, priority FROM apps
WHERE coalesce(status IN ('P'), false) AND NOT (priority IN ('5-LOW'))""",
)
def program_population(spark, sf):
    rows = cohorts.program_population(applications(spark, sf), "status", ["P"], "priority", ["5-LOW"])
    return rows.select("app_id", "status", "priority")


@query(
    "records_without_levels",
    f"WITH {RECORDS} SELECT level, count(*) AS n FROM records WHERE NOT coalesce(grade IN ('A', 'R'), false) GROUP BY level",
)
def records_without_levels(spark, sf):
    rows = records(spark, sf).filter(not_in_set("grade", ["A", "R"]))
    return rows.groupBy("level").agg(F.count(F.lit(1)).alias("n"))


@query(
    "outcome_matrices",
    f"""WITH {APPLICATIONS}, base AS (
  SELECT 'large' AS outcome_name, app_id, app_year, CASE WHEN price > 200000 THEN 'yes' ELSE 'no' END AS outcome FROM apps WHERE app_year >= 1995
  UNION ALL SELECT 'priority', app_id, app_year, coalesce(priority, 'none') FROM apps WHERE app_year < 1999),
early AS (SELECT app_id, app_year, price, status FROM apps WHERE app_id % 3 > 0),
late AS (SELECT app_id, app_year, score FROM apps WHERE app_id % 2 = 0)
SELECT outcome_name || '_before' AS matrix, app_id, app_year, outcome, price, status, NULL::DOUBLE AS score FROM base LEFT JOIN early USING (app_id, app_year)
UNION ALL SELECT outcome_name || '_all', app_id, app_year, outcome, price, status, score
FROM base LEFT JOIN early USING (app_id, app_year) LEFT JOIN late USING (app_id, app_year)""",
)
def stored_outcome_matrices(spark, sf):
    apps, root = applications(spark, sf), fresh_path(spark, "stages")
    named = {
        TableName("large", status="outcome"): apps.filter("app_year >= 1995").select(*APP_KEY, F.when(F.col("price") > 200000, "yes").otherwise("no").alias("outcome")),
        TableName("priority", status="outcome"): apps.filter("app_year < 1999").select(*APP_KEY, F.coalesce("priority", F.lit("none")).alias("outcome")),
        TableName("early", status="generated"): apps.filter("app_id % 3 > 0").select(*APP_KEY, "price", "status"),
        TableName("late", status="generated"): apps.filter("app_id % 2 = 0").select(*APP_KEY, "score"),
        TableName("other", status="clean"): apps.select("app_id"),
    }
    write_tables({str(name): df for name, df in named.items()}, root)
    written = feature_sets.outcome_matrices(spark, root, {"before": ["late"], "all": []}, APP_KEY)
    parts = {n: spark.read.parquet(f"{root}/{n}").withColumn("matrix", F.lit(TableName.parse(n).name)) for n in written}
    return stack_rows(*parts.values()).select("matrix", *APP_KEY, "outcome", "price", "status", "score")
