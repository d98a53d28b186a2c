"""The given tables under the names of an application process, in Spark and as SQL text.

An order is an application, a customer is a person, the order status is the decision. Missing values do not
occur in the tables, so some columns turn a value into NULL on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

KEY = ("person_id", "app_id")
PERSON_YEAR = ("person_id", "app_year")


def load(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def applications(spark: SparkSession, sf: str) -> DataFrame:
    return load(spark, sf, "orders").select(
        F.col("o_custkey").alias("person_id"),
        F.col("o_orderkey").alias("app_id"),
        F.year("o_orderdate").alias("app_year"),
        F.col("o_orderdate").alias("app_date"),
        F.col("o_orderstatus").alias("status"),
        F.when(F.col("o_orderstatus") == "P", "invite")
        .when(F.col("o_orderstatus") == "O", "hold")
        .otherwise("reject")
        .alias("decision"),
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("priority"),
        F.col("o_totalprice").alias("price"),
        (F.col("o_totalprice") / 250000 - 1).alias("score"),
        (F.col("o_orderkey") % 5).alias("algorithm_id"),
        F.when(F.col("o_orderkey") % 5 == 0, "train").otherwise("test").alias("set"),
    )


APPLICATIONS = """apps AS (
  SELECT o_custkey AS person_id, o_orderkey AS app_id, CAST(year(o_orderdate) AS INTEGER) AS app_year,
    o_orderdate AS app_date, o_orderstatus AS status,
    CASE o_orderstatus WHEN 'P' THEN 'invite' WHEN 'O' THEN 'hold' ELSE 'reject' END AS decision,
    nullif(o_orderpriority, '1-URGENT') AS priority, o_totalprice AS price,
    o_totalprice / 250000 - 1 AS score, o_orderkey % 5 AS algorithm_id,
    CASE WHEN o_orderkey % 5 = 0 THEN 'train' ELSE 'test' END AS "set"
  FROM orders)"""


def people(spark: SparkSession, sf: str) -> DataFrame:
    customer, nation = load(spark, sf, "customer"), load(spark, sf, "nation")
    joined = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select(
        F.col("c_custkey").alias("person_id"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("segment"),
        F.col("n_name").alias("nation"),
        F.when(F.col("n_regionkey") == 1, "Y").when(F.col("n_regionkey") != 4, "N").alias("home"),
        F.col("c_acctbal").alias("balance"),
    )


PEOPLE = """people AS (
  SELECT c_custkey AS person_id, nullif(c_mktsegment, 'MACHINERY') AS segment, n_name AS nation,
    CASE WHEN n_regionkey = 1 THEN 'Y' WHEN n_regionkey <> 4 THEN 'N' END AS home, c_acctbal AS balance
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


def registry(spark: SparkSession, sf: str) -> DataFrame:
    region = load(spark, sf, "region")
    return region.select(
        F.col("r_regionkey").cast("long").alias("id"),
        F.col("r_name").alias("name"),
        (F.col("r_regionkey") % 2).alias("is_production"),
    )


REGISTRY = "registry AS (SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_regionkey % 2 AS is_production FROM region)"


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    apps = applications(spark, sf)
    return apps.select(
        *KEY,
        "app_year",
        "algorithm_id",
        "set",
        F.col("decision").alias("outcome"),
        (F.col("price") / 500000).alias("predicted_invite"),
        (F.lit(1.0) - F.col("price") / 500000).alias("predicted_reject"),
        F.bround("score", 2).alias("score"),
    )


PREDICTIONS = """predictions AS (
  SELECT person_id, app_id, app_year, algorithm_id, "set", decision AS outcome,
    price / 500000 AS predicted_invite, 1.0::DOUBLE - price / 500000 AS predicted_reject,
    round_even(score, 2) AS score
  FROM apps)"""
