"""Eligibility, cohorts, anti-joins, per-person rows, key checks, set operations."""

from pyspark.sql import functions as F

from rollcall.functions.rules import all_known, differs, matches, not_in_set
from rollcall.operators import people as persons
from rollcall.operators import relational as rel
from rollcall.plans import cohorts as plan
from rollcall.plans.feature_sets import latest_score_features
from workload.inputs import (
    APPLICATIONS,
    KEY,
    PEOPLE,
    PREDICTIONS,
    REGISTRY,
    applications,
    load,
    people,
    predictions,
    registry,
)
from workload.registry import query

ELIGIBLE = f"""{APPLICATIONS}, {PEOPLE}, {REGISTRY}, {PREDICTIONS},
flags AS (SELECT c_custkey AS person_id, CAST(c_acctbal >= 0 AS INTEGER) AS is_eligible,
    CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS is_later FROM customer WHERE c_acctbal < 9000),
eligible AS (
  SELECT a.person_id, a.app_id, a.app_year, a.status, r.r_name AS place, a.priority IS NOT NULL AS is_invited,
    coalesce(CAST(a.price > 400000 AS INTEGER), 0) AS is_large
  FROM apps a JOIN flags f ON a.person_id = f.person_id
  LEFT JOIN region r ON left(a.priority, 1) = CAST(r.r_regionkey AS VARCHAR)
  WHERE a.app_year = (SELECT max(app_year) FROM apps)
    AND (f.is_eligible = 1 OR a.status = 'P' OR f.is_later = 1)
    AND a.decision IN ('invite', 'hold', 'reject') AND NOT regexp_matches(a.status, '^F[[:upper:]]*$')
    AND a.priority IS NOT NULL AND a.app_date IS NOT NULL)"""


def eligible_rows(spark, sf):
    flags = (
        load(spark, sf, "customer")
        .filter("c_acctbal < 9000")
        .select(
            F.col("c_custkey").alias("person_id"),
            (F.col("c_acctbal") >= 0).cast("int").alias("is_eligible"),
            (F.col("c_mktsegment") == "BUILDING").cast("int").alias("is_later"),
        )
    )
    places = load(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("place"))
    rows = plan.eligible(
        applications(spark, sf),
        flags,
        reasons=[F.col("is_eligible") == 1, F.col("status") == "P", F.col("is_later") == 1],
        required=[
            F.col("decision").isin("invite", "hold", "reject"),
            ~matches("status", r"^F\p{Upper}*$"),
            all_known(["priority", "app_date"]),
        ],
        year="app_year",
        key=["person_id"],
        income=places,
        income_on=F.substring("priority", 1, 1) == F.col("code"),
        added={
            "is_invited": F.col("priority").isNotNull(),
            "is_large": F.coalesce((F.col("price") > 400000).cast("int"), F.lit(0)),
        },
    )
    return rows.select(*KEY, "app_year", "status", "place", "is_invited", "is_large")


@query("eligible_population", f"WITH {ELIGIBLE} SELECT * FROM eligible")
def eligible_population(spark, sf):
    return eligible_rows(spark, sf)


@query(
    "unsent_predictions",
    f"""WITH {ELIGIBLE}
SELECT s.person_id, s.app_id, s.algorithm_id, s.score FROM predictions s, registry r, eligible e
WHERE s.algorithm_id = r.id AND r.is_production = 1 AND s.person_id = e.person_id AND s.app_id = e.app_id
  AND (s.person_id, s.app_id) NOT IN (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '3-MEDIUM')""",
)
def unsent_predictions(spark, sf):
    sent = load(spark, sf, "orders").filter("o_orderpriority = '3-MEDIUM'")
    sent = sent.select(F.col("o_custkey").alias("person_id"), F.col("o_orderkey").alias("app_id"))
    rows = plan.unsent(predictions(spark, sf), eligible_rows(spark, sf), registry(spark, sf), sent, KEY)
    return rows.select(*KEY, "algorithm_id", "score")


@query(
    "not_scored_yet",
    f"""WITH {APPLICATIONS}, {PEOPLE}
SELECT DISTINCT a.person_id, a.app_year FROM apps a
WHERE (a.person_id) IN (SELECT person_id FROM people WHERE segment IN ('BUILDING', 'HOUSEHOLD'))
  AND (a.person_id, a.app_year, 3) NOT IN (SELECT person_id, app_year, algorithm_id FROM apps)""",
)
def not_scored_yet(spark, sf):
    apps = applications(spark, sf)
    cohort = rel.in_keys(apps, people(spark, sf).filter(F.col("segment").isin("BUILDING", "HOUSEHOLD")), ["person_id"])
    return plan.not_scored_yet(apps, cohort, apps, 3, ("person_id", "app_year"))


@query(
    "not_in_null_aware",
    """SELECT o_orderkey, o_custkey, flag FROM (
  SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '1-URGENT') AS flag FROM orders) o
WHERE (o_custkey, flag) NOT IN (
  SELECT c_custkey, CASE WHEN c_acctbal <= 9000 THEN '5-LOW' END FROM customer WHERE c_acctbal > 3000)""",
)
def not_in_null_aware(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("flag")
    )
    done = load(spark, sf, "customer").filter("c_acctbal > 3000").select(
        F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_acctbal") <= 9000, "5-LOW").alias("flag")
    )
    return rel.not_yet_in(rows, done, ("o_custkey", "flag"), null_aware=True)


LABELS = """SELECT person_id, app_id,
  CASE WHEN home = 'Y' THEN 'local' ELSE 'not local' END AS local,
  CASE WHEN price > 300000 OR segment = 'BUILDING' THEN 'is large' ELSE 'not large' END AS large,
  CASE WHEN home = 'Y' AND (price > 300000 OR coalesce(segment = 'BUILDING', false)) THEN 'local + large'
    WHEN home = 'Y' THEN 'local not large'
    WHEN price > 300000 OR segment = 'BUILDING' THEN 'large not local'
    ELSE 'neither local nor large' END AS local_large,"""


@query(
    "cohort_labels",
    f"""WITH {APPLICATIONS}, {PEOPLE}, rows_ AS (SELECT a.*, p.home, p.segment FROM apps a LEFT JOIN people p USING (person_id))
{LABELS} 'fit' AS fit_or_predict FROM rows_ WHERE app_year < 2001
UNION
{LABELS} 'predict' AS fit_or_predict FROM rows_ WHERE app_year = 2001""",
)
def cohort_labels(spark, sf):
    rows = applications(spark, sf).join(people(spark, sf), ["person_id"], "left")

    def labels(part):
        large = (F.col("price") > 300000) | (F.col("segment") == "BUILDING")
        return plan.cohort_labels(part, F.col("home") == "Y", large, ("local", "large"), KEY)

    return plan.fit_and_predict(labels(rows.filter("app_year < 2001")), labels(rows.filter("app_year = 2001")))


@query(
    "all_known_ids",
    """SELECT c_nationkey AS nation_id FROM customer UNION SELECT s_nationkey FROM supplier""",
)
def all_known_ids(spark, sf):
    return rel.union_distinct(
        load(spark, sf, "customer").select(F.col("c_nationkey").alias("nation_id")),
        load(spark, sf, "supplier").select(F.col("s_nationkey").alias("nation_id")),
    )


def edge_sql(edge: str) -> str:
    return f"""WITH {APPLICATIONS}, kept AS (
  SELECT * FROM apps WHERE app_year BETWEEN 1996 AND 2000 AND priority IS NOT NULL AND status <> 'F')
SELECT person_id, app_id, app_year, status FROM kept k
WHERE app_year = (SELECT {edge}(app_year) FROM kept x WHERE x.person_id = k.person_id)"""


@query("first_eligible", edge_sql("min"))
def first_eligible(spark, sf):
    rules = [F.col("priority").isNotNull(), F.col("status") != "F"]
    rows = plan.first_eligible(applications(spark, sf), "person_id", "app_year", (1996, 2000), rules)
    return rows.select(*KEY, "app_year", "status")


@query("last_eligible", edge_sql("max"))
def last_eligible(spark, sf):
    kept = applications(spark, sf).filter("priority IS NOT NULL AND status <> 'F'")
    return persons.last_rows(kept, "person_id", "app_year", 1996, 2000).select(*KEY, "app_year", "status")


TESTS = """tests AS (
  SELECT o_custkey AS person_id, o_orderdate AS test_date, o_totalprice AS total, o_orderkey AS test_id, 'old' AS form
  FROM orders WHERE o_orderdate < '1999-01-01'
  UNION ALL
  SELECT o_custkey, o_orderdate, o_totalprice, o_orderkey, 'new' FROM orders WHERE o_orderdate >= '1999-01-01')"""


@query(
    "latest_test",
    f"""WITH {TESTS}
SELECT person_id, total, test_id, form, n_tests FROM (
  SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY test_date DESC, test_id) AS rn,
    count(*) OVER (PARTITION BY person_id) AS n_tests FROM tests) WHERE rn = 1""",
)
def latest_test(spark, sf):
    return latest_features(spark, sf, "first")


@query(
    "latest_test_drop_ties",
    f"""WITH {TESTS}
SELECT person_id, total, test_id, form, n_tests FROM (
  SELECT *, rank() OVER (PARTITION BY person_id ORDER BY test_date DESC) AS r,
    count(*) OVER (PARTITION BY person_id, test_date) AS same_day,
    count(*) OVER (PARTITION BY person_id) AS n_tests FROM tests) WHERE r = 1 AND same_day = 1""",
)
def latest_test_drop_ties(spark, sf):
    return latest_features(spark, sf, "drop")


def latest_features(spark, sf, ties):
    orders = load(spark, sf, "orders")
    names = {"o_custkey": "person_id", "o_orderdate": "test_date", "o_totalprice": "total", "o_orderkey": "test_id"}
    return latest_score_features(
        orders.filter("o_orderdate < timestamp_ntz'1999-01-01'"),
        orders.filter("o_orderdate >= timestamp_ntz'1999-01-01'"),
        names,
        names,
        "person_id",
        "test_date",
        ["test_id"],
        ties,
    )


@query(
    "group_size",
    """SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n_rows FROM orders""",
)
def group_size(spark, sf):
    return persons.with_group_size(load(spark, sf, "orders").select("o_orderkey", "o_custkey"), ["o_custkey"])


@query(
    "group_size_missing_keys",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS person, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders)
SELECT *, count(*) OVER (PARTITION BY person, priority) AS n_rows FROM o""",
)
def group_size_missing_keys(spark, sf):
    person = F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("person")
    rows = load(spark, sf, "orders").select("o_orderkey", person, F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"))
    return persons.with_group_size(rows, ["person", "priority"])


@query(
    "duplicate_rows_missing_keys",
    """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 3 > 0 THEN o_custkey END AS person, nullif(o_orderpriority, '1-URGENT') AS priority FROM orders)
SELECT o_orderkey, person, priority FROM (SELECT *, count(*) OVER (PARTITION BY person, priority) AS n FROM o) WHERE n > 1""",
)
def duplicate_rows_missing_keys(spark, sf):
    person = F.when(F.col("o_custkey") % 3 > 0, F.col("o_custkey")).alias("person")
    rows = load(spark, sf, "orders").select("o_orderkey", person, F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"))
    return rel.duplicate_rows(rows, ["person", "priority"])


@query(
    "duplicate_keys",
    "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_keys(spark, sf):
    return rel.duplicate_keys(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "duplicate_rows",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem WHERE (l_orderkey, l_linenumber) IN (
  SELECT (l_orderkey, l_linenumber) FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)""",
)
def duplicate_rows(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return rel.duplicate_rows(rows, ["l_orderkey", "l_linenumber"])


@query(
    "conflicting_values",
    """SELECT l_orderkey, l_linenumber, count(DISTINCT l_suppkey) AS n_values FROM lineitem
GROUP BY ALL HAVING count(DISTINCT l_suppkey) > 1""",
)
def conflicting_values(spark, sf):
    return rel.conflicting(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], "l_suppkey")


@query(
    "distinct_combinations",
    "SELECT count(*) AS n FROM (SELECT l_orderkey, l_suppkey FROM lineitem GROUP BY ALL)",
)
def distinct_combinations(spark, sf):
    return rel.distinct_combinations(load(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"])


@query(
    "distinct_sorted",
    "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem ORDER BY 1, 2",
)
def distinct_sorted(spark, sf):
    rows = load(spark, sf, "lineitem").select("l_returnflag", "l_linestatus")
    return rows.distinct().orderBy("l_returnflag", "l_linestatus")


@query(
    "first_in_order",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1",
)
def first_in_order(spark, sf):
    rows = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return rel.first_n(rows, 1, [F.desc("o_totalprice"), "o_orderkey"])


@query(
    "lost_between_steps",
    f"""WITH {APPLICATIONS}, lost AS (
  SELECT person_id, app_year FROM apps WHERE status <> 'F'
  EXCEPT SELECT person_id, app_year FROM apps WHERE status = 'P')
SELECT l.person_id, l.app_year, a.app_id, a.status FROM lost l LEFT JOIN apps a USING (person_id, app_year)""",
)
def lost_between_steps(spark, sf):
    apps = applications(spark, sf)
    detail = apps.select("person_id", "app_year", "app_id", "status")
    return rel.lost_rows(apps.filter("status <> 'F'"), apps.filter("status = 'P'"), ["person_id", "app_year"], detail)


@query(
    "join_on_shared_columns",
    """SELECT o_orderkey AS order_id, o_totalprice, l_linenumber, l_quantity FROM orders
LEFT JOIN (SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45) ON o_orderkey = l_orderkey""",
)
def join_on_shared_columns(spark, sf):
    orders = load(spark, sf, "orders").select(F.col("o_orderkey").alias("order_id"), "o_totalprice")
    lines = load(spark, sf, "lineitem").filter("l_quantity > 45")
    return rel.join_shared(orders, lines.select(F.col("l_orderkey").alias("order_id"), "l_linenumber", "l_quantity"))


@query(
    "prefix_lookup",
    """SELECT o_orderkey, o_orderpriority, r_name FROM orders
LEFT JOIN region ON left(o_orderpriority, 1) = CAST(r_regionkey AS VARCHAR)""",
)
def prefix_lookup(spark, sf):
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    on = F.substring("o_orderpriority", 1, 1) == F.col("r_regionkey").cast("string")
    return rel.lookup(orders, load(spark, sf, "region"), on).select("o_orderkey", "o_orderpriority", "r_name")


@query(
    "membership_filters",
    f"""WITH {APPLICATIONS}
SELECT app_id, 'negated, NULL kept' AS rule FROM apps WHERE NOT coalesce(priority IN ('5-LOW', '2-HIGH'), false)
UNION ALL SELECT app_id, 'negated, NULL dropped' FROM apps WHERE priority NOT IN ('5-LOW', '2-HIGH')
UNION ALL SELECT app_id, 'differs' FROM apps WHERE priority <> '5-LOW'""",
)
def membership_filters(spark, sf):
    apps = applications(spark, sf)
    values = ["5-LOW", "2-HIGH"]
    rules = {
        "negated, NULL kept": not_in_set("priority", values),
        "negated, NULL dropped": not_in_set("priority", values, drop_null=True),
        "differs": differs("priority", "5-LOW"),
    }
    labels = F.array_compact(F.array(*[F.when(c, F.lit(name)) for name, c in rules.items()]))
    return apps.select("app_id", F.explode(labels).alias("rule"))
