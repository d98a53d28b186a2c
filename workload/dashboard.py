"""Scores, enrichment, band table and projection."""

from pyspark.sql import functions as F

from rollcall.functions.values import to_unsigned
from rollcall.operators.tabulate import label_order
from rollcall.plans import dashboard as plan
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

LOWER, UPPER = -0.15, 0.50

BAND = f"CASE WHEN score > {UPPER} THEN 'Invite' WHEN score > {LOWER} THEN 'Hold' ELSE 'Reject' END"

CURRENT = f"""{APPLICATIONS}, {PEOPLE}, {REGISTRY}, {PREDICTIONS},
current_rows AS (
  SELECT s.person_id, s.app_id, s.score, p.segment, coalesce(p.home, 'N') AS home, p.nation, {BAND} AS band
  FROM (SELECT DISTINCT person_id, app_id, algorithm_id, score FROM predictions) s LEFT JOIN people p USING (person_id)
  WHERE s.algorithm_id IN (SELECT id FROM registry WHERE is_production = 1))"""


def current_people(spark, sf):
    # people are unique, so equal rows can leave before the join, while rows are narrow and not yet hashed by person
    scores = plan.current_scores(predictions(spark, sf), registry(spark, sf), KEY).distinct()
    block = people(spark, sf).select("person_id", "segment", "home", "nation")
    # customers are unique on their key, so the uniqueness check is left out
    return plan.enrich(scores, {"people": block}, {"home": "N"}, ["person_id"], unique=False)


@query(
    "dashboard_crosstab",
    f"""WITH {CURRENT}
SELECT CASE WHEN grouping(band) = 1 THEN 'All' ELSE band END AS predicted_outcome,
  count(*) AS n,
  CAST(sum(CASE WHEN segment = 'BUILDING' THEN 1 WHEN segment IS NOT NULL THEN 0 END) AS BIGINT) AS building,
  round(avg(CASE WHEN segment = 'BUILDING' THEN 1 WHEN segment IS NOT NULL THEN 0 END), 3) AS pct_building,
  CAST(sum(CASE WHEN home = 'Y' THEN 1 ELSE 0 END) AS BIGINT) AS home,
  round(avg(CASE WHEN home = 'Y' THEN 1 ELSE 0 END), 3) AS pct_home,
  CAST(sum(CASE WHEN nation = 'NATION_1' THEN 1 ELSE 0 END) AS BIGINT) AS nation_1,
  round(avg(CASE WHEN nation = 'NATION_1' THEN 1 ELSE 0 END), 3) AS pct_nation_1
FROM (SELECT DISTINCT * FROM current_rows)
GROUP BY GROUPING SETS ((band), ())""",
)
def dashboard_crosstab(spark, sf):
    flags = {
        "building": F.col("segment") == "BUILDING",
        "home": F.col("home") == "Y",
        "nation_1": F.col("nation") == "NATION_1",
    }
    table = plan.band_table(current_people(spark, sf), flags, LOWER, UPPER, dedup=False)
    return table.orderBy(label_order("predicted_outcome", plan.BANDS))


@query(
    "production_scores",
    f"""WITH {APPLICATIONS}, {REGISTRY}, {PREDICTIONS}
SELECT person_id, app_id, score, NULL::VARCHAR AS outcome, 'current' AS part FROM predictions
WHERE algorithm_id IN (SELECT id FROM registry WHERE is_production = 1)
UNION ALL
SELECT person_id, app_id, predicted_invite - predicted_reject, outcome, 'historic' FROM predictions
WHERE algorithm_id IN (SELECT id FROM registry WHERE is_production = 1) AND "set" = 'test'""",
)
def production_scores(spark, sf):
    scored, models = predictions(spark, sf), registry(spark, sf)
    now = plan.current_scores(scored, models, KEY).withColumn("part", F.lit("current"))
    past = plan.historic_scores(scored, models, key=KEY).withColumn("part", F.lit("historic"))
    return now.unionByName(past, allowMissingColumns=True)


@query(
    "demographics",
    f"""WITH {CURRENT}
SELECT c.person_id, c.app_id, c.score, c.segment, c.home, c.nation, CAST(floor(p.balance) AS BIGINT) AS balance
FROM current_rows c LEFT JOIN people p ON c.person_id = p.person_id AND p.balance >= 0""",
)
def demographics(spark, sf):
    whole = people(spark, sf).select("person_id", to_unsigned(F.floor("balance")).alias("balance"))
    return plan.enrich(current_people(spark, sf), {"balance": whole}, None, ["person_id"], unique=False)


OUTCOMES = f"""{APPLICATIONS}, {REGISTRY}, {PREDICTIONS},
historic AS (
  SELECT person_id, app_id, predicted_invite - predicted_reject AS score, outcome FROM predictions
  WHERE algorithm_id IN (SELECT id FROM registry WHERE is_production = 1) AND "set" = 'test'),
screened AS (
  SELECT o_custkey AS person_id, o_orderkey AS app_id, o_orderpriority <= '3' AS is_invited,
    o_orderpriority <= '2' AS is_offered, left(o_orderpriority, 1) IN ('1') AS is_matriculated
  FROM orders WHERE o_totalprice > 50000),
outcomes AS (
  SELECT h.person_id, h.app_id, h.score, h.outcome, s.is_invited, s.is_offered, s.is_matriculated
  FROM screened s RIGHT JOIN historic h ON s.person_id = h.person_id AND s.app_id = h.app_id)"""


def outcome_rows(spark, sf):
    past = plan.historic_scores(predictions(spark, sf), registry(spark, sf), key=KEY)
    screened = (
        load(spark, sf, "orders")
        .filter("o_totalprice > 50000")
        .select(
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderkey").alias("app_id"),
            (F.col("o_orderpriority") <= "3").alias("is_invited"),
            (F.col("o_orderpriority") <= "2").alias("is_offered"),
            F.col("o_orderpriority").alias("status"),
        )
    )
    return plan.historic_outcomes(past, screened, ["is_invited", "is_offered"], "status", ["1"], KEY)


@query("historic_outcomes", f"WITH {OUTCOMES} SELECT * FROM outcomes")
def historic_outcomes(spark, sf):
    return outcome_rows(spark, sf)


@query(
    "cycle_projection",
    f"""WITH {OUTCOMES},
counts AS (
  SELECT CASE WHEN grouping(band) = 1 THEN 'All' ELSE band END AS band, count(*) AS total,
    CAST(sum(CASE WHEN score > {LOWER} AND score <= {UPPER} THEN 1 ELSE 0 END) AS BIGINT) AS n_screenings
  FROM (SELECT DISTINCT person_id, app_id, score, {BAND} AS band FROM predictions
        WHERE algorithm_id IN (SELECT id FROM registry WHERE is_production = 1))
  GROUP BY GROUPING SETS ((band), ())),
rates AS (
  SELECT CASE WHEN grouping(band) = 1 THEN 'All' ELSE band END AS band,
    avg(CAST(is_invited AS INT)) AS invited, avg(CAST(is_offered AS INT)) AS accepted,
    avg(CAST(is_matriculated AS INT)) AS matriculated, count(*) AS hist_total,
    sum(CAST(is_offered AS INT)) / sum(CAST(is_invited AS INT)) AS aii,
    sum(CAST(is_matriculated AS INT)) / sum(CAST(is_invited AS INT)) AS mii
  FROM (SELECT DISTINCT *, {BAND} AS band FROM outcomes) GROUP BY GROUPING SETS ((band), ())),
joined AS (
  SELECT r.*, c.total, c.n_screenings,
    CASE r.band WHEN 'Reject' THEN 0.0::DOUBLE WHEN 'Hold' THEN round(r.invited * c.total)
      WHEN 'Invite' THEN c.total::DOUBLE END AS n_invites
  FROM rates r LEFT JOIN counts c ON r.band = c.band),
projected AS (SELECT *, round(aii * n_invites) AS pa, round(mii * n_invites) AS pm FROM joined),
filled AS (
  SELECT * REPLACE (
    CASE WHEN band = 'All' THEN (SELECT sum(n_invites) FROM projected) ELSE n_invites END AS n_invites,
    CASE WHEN band = 'All' THEN (SELECT sum(pa) FROM projected) ELSE pa END AS pa,
    CASE WHEN band = 'All' THEN (SELECT sum(pm) FROM projected) ELSE pm END AS pm)
  FROM projected)
SELECT band AS predicted_outcome, round(n_invites / total, 3) AS pct_applicants_invited, n_screenings, n_invites,
  round(invited, 3) AS historic_invited, round(accepted, 3) AS historic_accepted,
  round(matriculated, 3) AS historic_matriculated, hist_total, round(aii, 3) AS historic_accepted_if_invited,
  round(mii, 3) AS historic_matriculated_if_invited, pa AS projected_accepted, pm AS projected_matriculated
FROM filled""",
)
def cycle_projection(spark, sf):
    current = plan.current_scores(predictions(spark, sf), registry(spark, sf), KEY)
    rates = plan.historic_rates(
        outcome_rows(spark, sf), "is_invited", "is_offered", "is_matriculated", LOWER, UPPER
    )
    return plan.project_cycle(rates, plan.screening_counts(current, LOWER, UPPER))
