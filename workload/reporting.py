"""Risk buckets, back-tests, threshold policies, funnels, subgroups."""

from pyspark.sql import functions as F

from rollcall.functions.values import percent_text
from rollcall.operators import tabulate
from rollcall.plans import reports
from workload.inputs import APPLICATIONS, KEY, PEOPLE, applications, people
from workload.registry import query

FLAGS = """flagged AS (SELECT *, priority IS NULL OR priority <= '3' AS is_interviewed, priority IS NULL AS is_offered,
  status = 'P' AS is_matriculated FROM apps)"""


def flagged(spark, sf):
    return applications(spark, sf).withColumns(
        {
            "is_interviewed": F.col("priority").isNull() | (F.col("priority") <= "3"),
            "is_offered": F.col("priority").isNull(),
            "is_matriculated": F.col("status") == "P",
        }
    )


BUCKETED = f"""{APPLICATIONS}, {FLAGS}, bucketed AS (
  SELECT *, price / 500000 AS predicted_0, 1.0::DOUBLE - price / 500000 AS predicted_2,
    CAST(ntile(15) OVER (ORDER BY price / 500000 - (1.0::DOUBLE - price / 500000), app_id) AS INTEGER) AS risk_bucket FROM flagged)"""


def bucketed(spark, sf):
    rows = flagged(spark, sf).withColumns(
        {"predicted_0": F.col("price") / 500000, "predicted_2": F.lit(1.0) - F.col("price") / 500000}
    )
    return reports.risk_buckets(rows, "predicted_0", "predicted_2", 15, ["app_id"])


@query("risk_buckets", f"WITH {BUCKETED} SELECT person_id, app_id, risk_bucket FROM bucketed")
def risk_buckets(spark, sf):
    return bucketed(spark, sf).select(*KEY, "risk_bucket")


@query(
    "risk_buckets_with_ties",
    f"""WITH {APPLICATIONS} SELECT app_id, CAST(ntile(7) OVER (ORDER BY app_year, app_id) AS INTEGER) AS risk_bucket FROM apps""",
)
def risk_buckets_with_ties(spark, sf):
    rows = applications(spark, sf).withColumn("zero", F.lit(0))
    return reports.risk_buckets(rows, "app_year", "zero", 7, ["app_id"]).select("app_id", "risk_bucket")


@query(
    "risk_bucket_report",
    f"""WITH {BUCKETED}
SELECT risk_bucket, count(*) AS total, round(quantile_cont(predicted_0, 0.25), 10) AS p25_predicted_0,
  round(quantile_cont(predicted_0, 0.75), 10) AS p75_predicted_0,
  CAST(sum(CAST(is_interviewed AS INT)) AS BIGINT) AS num_interviewed, avg(CAST(is_interviewed AS INT)) AS pct_interviewed,
  CAST(sum(CAST(is_offered AS INT)) AS BIGINT) AS num_accepted, avg(CAST(is_offered AS INT)) AS pct_accepted
FROM bucketed GROUP BY risk_bucket""",
)
def risk_bucket_report(spark, sf):
    flags = {"interviewed": "is_interviewed", "accepted": "is_offered"}
    return reports.bucket_report(bucketed(spark, sf), "risk_bucket", ["predicted_0"], flags, digits=10)


BACKTEST = f"""{BUCKETED}, moved AS (
  SELECT * REPLACE (CASE WHEN status = 'F' THEN 0 ELSE risk_bucket END AS risk_bucket) FROM bucketed),
m1 AS (SELECT *, CASE WHEN risk_bucket = 0 OR risk_bucket BETWEEN 8 AND 14 THEN 1 ELSE 0 END AS ms FROM moved),
m2 AS (SELECT *, CASE WHEN ms = 1 THEN CAST(is_interviewed AS INT) ELSE CAST(risk_bucket = 15 AS INT) END AS mi FROM m1),
m3 AS (SELECT *, CASE WHEN mi = 1 THEN CAST(is_offered AS INT) ELSE 0 END AS ma FROM m2),
m4 AS (SELECT *, CASE WHEN ma = 1 THEN CAST(is_matriculated AS INT) ELSE 0 END AS mm FROM m3),
per_bucket AS (SELECT risk_bucket, count(*) AS total,
  CAST(sum(CAST(is_interviewed AS INT)) AS BIGINT) AS num_interviewed, avg(CAST(is_interviewed AS INT)) AS pct_interviewed,
  CAST(sum(CAST(is_offered AS INT)) AS BIGINT) AS num_accepted, avg(CAST(is_offered AS INT)) AS pct_accepted,
  CAST(sum(CAST(is_matriculated AS INT)) AS BIGINT) AS num_matriculated, avg(CAST(is_matriculated AS INT)) AS pct_matriculated,
  CAST(sum(ms) AS BIGINT) AS num_screened_model, CAST(sum(mi) AS BIGINT) AS num_interview_model,
  CAST(sum(ma) AS BIGINT) AS num_accepted_model, CAST(sum(mm) AS BIGINT) AS num_matriculated_model
  FROM m4 GROUP BY risk_bucket)"""


def backtest(spark, sf):
    rows = bucketed(spark, sf).withColumn(
        "risk_bucket", F.when(F.col("status") == "F", 0).otherwise(F.col("risk_bucket"))
    )
    screened = [0, *range(8, 15)]
    return reports.backtest(rows, "risk_bucket", screened, 15, "is_interviewed", "is_offered", "is_matriculated")


@query("policy_backtest", f"WITH {BACKTEST} SELECT * FROM per_bucket")
def policy_backtest(spark, sf):
    return backtest(spark, sf)


@query(
    "policy_payoff",
    f"""WITH {BACKTEST} SELECT CAST(sum(total) AS BIGINT) AS n_screened_old, CAST(sum(num_screened_model) AS BIGINT) AS n_screened_model,
  CAST(sum(num_interviewed) AS BIGINT) AS n_interviewed_old, CAST(sum(num_interview_model) AS BIGINT) AS n_interviewed_model,
  CAST(sum(num_accepted) AS BIGINT) AS n_accepted_old, CAST(sum(num_accepted_model) AS BIGINT) AS n_accepted_model,
  CAST(sum(num_matriculated) AS BIGINT) AS n_matriculated_old, CAST(sum(num_matriculated_model) AS BIGINT) AS n_matriculated_model
FROM per_bucket""",
)
def policy_payoff(spark, sf):
    return reports.payoff(backtest(spark, sf))


LOWER, UPPER = -0.20, 0.40


@query(
    "threshold_totals",
    f"""WITH {APPLICATIONS}, {FLAGS}, p AS (SELECT *, score < {LOWER} AS rej, score > {UPPER} AS inv FROM flagged WHERE "set" = 'test'),
q AS (SELECT *, NOT rej AND NOT inv AS scr, inv OR (NOT rej AND NOT inv AND is_interviewed) AS intv FROM p)
SELECT count(*) AS actual_screened, count(*) FILTER (scr) AS model_screened, count(*) FILTER (rej) AS automatic_reject,
  count(*) FILTER (is_interviewed) AS actual_interviewed, count(*) FILTER (intv) AS model_interviewed,
  count(*) FILTER (inv) AS automatic_invited, count(*) FILTER (is_offered) AS actual_offered,
  count(*) FILTER (intv AND is_offered) AS model_offered FROM q""",
)
def threshold_totals(spark, sf):
    held_out = flagged(spark, sf).filter(F.col("set") == "test")
    return reports.threshold_totals(held_out, "score", "is_interviewed", "is_offered", LOWER, UPPER)


@query(
    "threshold_groups",
    f"""WITH {APPLICATIONS}, {FLAGS}, p AS (SELECT *, CASE WHEN score < {LOWER} THEN 'automatic_reject'
  WHEN score > {UPPER} THEN 'automatic_invited' ELSE 'screened' END AS decision_ FROM flagged)
SELECT decision_ AS decision, count(*) AS n, avg(CAST(is_interviewed AS INT)) AS pct_invited,
  avg(CAST(decision = 'invite' AS INT)) AS pct_invite, avg(CAST(decision = 'hold' AS INT)) AS pct_hold,
  avg(CAST(decision = 'reject' AS INT)) AS pct_reject FROM p GROUP BY 1""",
)
def threshold_groups(spark, sf):
    return reports.threshold_groups(
        flagged(spark, sf), "score", "is_interviewed", "decision", ["invite", "hold", "reject"], LOWER, UPPER
    )


@query(
    "funnel_by_year",
    f"""WITH {APPLICATIONS}, {FLAGS} SELECT app_year, count(*) AS n, count(*) FILTER (is_interviewed) AS n_interviewed,
  count(*) FILTER (is_offered) AS n_offered, count(*) FILTER (priority = '5-LOW') AS n_low FROM flagged GROUP BY app_year""",
)
def funnel_by_year(spark, sf):
    flags = {
        "n_interviewed": F.col("is_interviewed"),
        "n_offered": F.col("is_offered"),
        "n_low": F.col("priority") == "5-LOW",
    }
    return tabulate.funnel(flagged(spark, sf), "app_year", flags)


@query(
    "rate_by_pair",
    f"""WITH {APPLICATIONS}, {FLAGS} SELECT status, priority, avg(CAST(is_interviewed AS INT)) AS pct_interviewed,
  avg(CAST(score > 0 AS INT)) AS pct_positive FROM flagged GROUP BY ALL""",
)
def rate_by_pair(spark, sf):
    flags = {"pct_interviewed": F.col("is_interviewed"), "pct_positive": F.col("score") > 0}
    return tabulate.rates_by(flagged(spark, sf), ["status", "priority"], flags)


SUBGROUP = f"""{APPLICATIONS}, {PEOPLE}, {FLAGS}, joined AS (
  SELECT f.*, p.home, CASE WHEN p.balance > 0 THEN p.balance END AS balance, CAST(ceil((score + 1) * 7) AS INTEGER) AS bucket,
    p.segment IS NULL OR p.segment = 'BUILDING' OR p.home = 'Y' AS protected
  FROM flagged f LEFT JOIN people p USING (person_id)),
statused AS (SELECT *, CASE WHEN bucket BETWEEN 1 AND 7 AND NOT protected THEN 'automatic_reject'
  WHEN NOT (bucket BETWEEN 1 AND 7 AND NOT protected) THEN 'further_review' END AS predicted_status FROM joined)"""


def statused(spark, sf):
    joined = flagged(spark, sf).join(people(spark, sf), ["person_id"], "left")
    rows = joined.withColumns(
        {
            "balance": F.when(F.col("balance") > 0, F.col("balance")),
            "bucket": F.ceil((F.col("score") + 1) * 7).cast("int"),
        }
    )
    protected = F.col("segment").isNull() | (F.col("segment") == "BUILDING") | (F.col("home") == "Y")
    return reports.auto_reject(rows, protected, "bucket", (1, 7))


@query("auto_reject_status", f"WITH {SUBGROUP} SELECT app_id, predicted_status FROM statused")
def auto_reject_status(spark, sf):
    return statused(spark, sf).select("app_id", "predicted_status")


@query(
    "subgroup_profile",
    f"""WITH {SUBGROUP} SELECT app_year, count(*) AS total,
  round(count(*) FILTER (home = 'Y') / nullif(count(*) FILTER (home IN ('Y', 'N')), 0), 6) AS fra_y,
  round(count(*) FILTER (home = 'N') / nullif(count(*) FILTER (home IN ('Y', 'N')), 0), 6) AS fra_n,
  round(avg(balance), 6) AS balance_average FROM statused WHERE predicted_status = 'automatic_reject' AND is_interviewed GROUP BY app_year""",
)
def subgroup_profile(spark, sf):
    rows = statused(spark, sf).filter((F.col("predicted_status") == "automatic_reject") & F.col("is_interviewed"))
    return reports.subgroup_profile(rows, "app_year", "home", ("Y", "N"), ["balance"], digits=6)


@query(
    "null_safe_totals",
    f"""WITH {APPLICATIONS}, t AS (SELECT app_year, CASE WHEN app_year <> 1997 THEN app_id END AS a, CASE WHEN priority IS NOT NULL THEN 1 END AS b FROM apps)
SELECT app_year, CAST(coalesce(sum(a), 0) AS BIGINT) AS total_a, CAST(coalesce(sum(b), 0) AS BIGINT) AS total_b FROM t GROUP BY app_year""",
)
def null_safe_totals(spark, sf):
    rows = applications(spark, sf).select(
        "app_year",
        F.when(F.col("app_year") != 1997, F.col("app_id")).alias("a"),
        F.when(F.col("priority").isNotNull(), 1).alias("b"),
    )
    return tabulate.totals(rows, ["app_year"], ["a", "b"])


@query(
    "percent_texts",
    f"""WITH {APPLICATIONS}, s AS (SELECT app_year, avg(CAST(priority = '5-LOW' AS INT)) AS share FROM apps GROUP BY app_year)
SELECT app_year, CAST(round(100 * share, 1) AS VARCHAR) AS shown FROM s""",
)
def percent_texts(spark, sf):
    shares = applications(spark, sf).groupBy("app_year").agg(F.avg((F.col("priority") == "5-LOW").cast("int")).alias("share"))
    text = percent_text("share")
    padded = F.when(text.contains("."), text).otherwise(F.regexp_replace(text, "%", ".0%"))
    return shares.select("app_year", F.regexp_replace(padded, "%", "").alias("shown"))
