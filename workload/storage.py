"""Readers and writers: rows are written to the shared folder and read back."""

import uuid
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from rollcall.functions.values import year_band
from rollcall.plans import registry as models
from rollcall.plans.spec import ModelSpec
from rollcall.session import fresh_path, settle
from rollcall.sources import sinks, sqltext, tables as t
from workload.inputs import APPLICATIONS, applications, load, registry
from workload.registry import query


@query(
    "csv_na_round_trip",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 < 4 THEN NULL ELSE c_mktsegment END AS segment,
  CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS balance FROM customer""",
)
def csv_na_round_trip(spark, sf):
    rows = _csv_rows(load(spark, sf, "customer"))
    root = fresh_path(spark, "csv")
    sinks.write_csv(rows, f"{root}/people.csv")
    schema = "c_custkey bigint, segment string, balance double, contact string"
    return t.read_csv_folder(spark, root, {"people": schema}, drop=["contact"])["people"]


def _csv_rows(customer):
    part = F.col("c_custkey") % 5
    text = F.when(part == 0, "NA").when(part == 1, "N/A").when(part == 2, "null").when(part == 3, "")
    return customer.select(
        "c_custkey",
        text.otherwise(F.col("c_mktsegment")).alias("segment"),
        F.when(F.col("c_custkey") % 7 == 0, "no number").otherwise(F.col("c_acctbal").cast("string")).alias("balance"),
        F.lit('a "quoted", text').alias("contact"),
    )


@query(
    "csv_keep_columns",
    "SELECT s_suppkey, s_acctbal FROM supplier",
)
def csv_keep_columns(spark, sf):
    path = fresh_path(spark, "suppliers")
    sinks.write_csv(load(spark, sf, "supplier"), path)
    schema = "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"
    return t.read_csv_na(spark, path, schema, keep=["s_suppkey", "s_acctbal"])


@query(
    "table_overwrite",
    """SELECT o_orderkey, CAST(o_totalprice > 250000 AS INTEGER) AS is_large, CAST(o_orderstatus = 'P' AS INTEGER) AS is_done FROM orders""",
)
def table_overwrite(spark, sf):
    orders = load(spark, sf, "orders")
    flags = orders.select(
        "o_orderkey", (F.col("o_totalprice") > 250000).alias("is_large"), (F.col("o_orderstatus") == "P").alias("is_done")
    )
    root = fresh_path(spark, "tables")
    sinks.write_tables({str(t.TableName("flags")): orders.select("o_orderkey")}, root)
    sinks.write_tables({str(t.TableName("flags")): flags}, root)
    return t.read_tables(spark, root, r"^DEIDENTIFIED\W")["flags"]


@query(
    "append_tagged",
    f"""WITH {APPLICATIONS} SELECT app_id, decision, score, "set", algorithm_id FROM apps WHERE algorithm_id <= 2""",
)
def append_tagged(spark, sf):
    apps = applications(spark, sf)
    path = fresh_path(spark, "predictions")
    for algorithm in range(5):
        rows = apps.filter(F.col("algorithm_id") == algorithm).select("app_id", "decision", "score", "set")
        train, test = (rows.filter(F.col("set") == s).drop("set") for s in ("train", "test"))
        sinks.append_results(train, test, algorithm, path)
    stored = spark.read.parquet(path).withColumn("algorithm_id", F.col("algorithm_id").cast("long"))
    return sinks.delete_rows(stored, F.col("algorithm_id") > 2)


@query(
    "replace_partitions",
    f"""WITH {APPLICATIONS} SELECT app_id, CASE WHEN app_year = 1999 THEN 'new' ELSE status END AS status, app_year FROM apps""",
)
def replace_partitions(spark, sf):
    apps = applications(spark, sf).select("app_id", "status", "app_year")
    path = fresh_path(spark, "partitions")
    sinks.replace_partitions(apps, path, ["app_year"])
    later = apps.filter("app_year = 1999").withColumn("status", F.lit("new"))
    sinks.replace_partitions(later, path, ["app_year"])
    return spark.read.parquet(path)


BANDS = [(1996, "_1995_1996"), (1998, "_1997_1998")]


@query(
    "year_band_split",
    f"""WITH {APPLICATIONS}, b AS (SELECT app_id, app_year, CASE WHEN app_year <= 1998 THEN priority END AS priority,
  CASE WHEN app_year <= 1996 THEN '_1995_1996' WHEN app_year <= 1998 THEN '_1997_1998' ELSE '' END AS band FROM apps)
SELECT app_id, app_year, priority, CASE WHEN band = '' THEN 'rest' ELSE band END AS band,
  CASE WHEN band = '' THEN 'app_id app_year' ELSE 'app_id app_year priority' END AS columns_written FROM b""",
)
def year_band_split(spark, sf):
    rows = applications(spark, sf).select(
        F.col("app_id").alias("App ID"),
        "app_year",
        F.when(F.col("app_year") <= 1998, F.col("priority")).alias("Priority"),
        year_band("app_year", BANDS).alias("band"),
    )
    root = fresh_path(spark, "bands")
    written = sinks.write_split(rows, "band", root, "app_year", ["app_id"])
    schema = {"app_id": "bigint", "app_year": "int", "priority": "string"}
    parts = [
        t.read_csv_na(spark, f"{root}/{band}", ", ".join(f"{c} {schema[c]}" for c in columns)).withColumns(
            {"band": F.lit(band), "columns_written": F.lit(" ".join(columns))}
        )
        for band, columns in written.items()
    ]
    return t.stack_rows(*parts)


def counted(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), F.lit(len(df.columns)).alias("n_columns"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, rows)


@query(
    "tables_by_pattern",
    """SELECT 'orders' AS name, 6 AS n_columns, count(*) AS n FROM orders
UNION ALL SELECT 'customer', 5, count(*) FROM customer UNION ALL SELECT 'conversations', 4, count(*) FROM conversations""",
)
def tables_by_pattern(spark, sf):
    return counted(t.read_tables(spark, sf, "^(ORDERS|c.*r(s|$)|conv)"))


@query(
    "tables_with_column",
    """SELECT 'documents' AS name, 5 AS n_columns, count(*) AS n FROM documents UNION ALL SELECT 'labels', 3, count(*) FROM labels""",
)
def tables_with_column(spark, sf):
    every = t.read_tables(spark, sf)
    return counted({name: every[name] for name in t.tables_with_column(every, "doc_id")})


@query(
    "tables_by_stage",
    """SELECT 'hashed$raw$orders' AS name, 6 AS n_columns, count(*) AS n FROM orders""",
)
def tables_by_stage(spark, sf):
    every = {
        str(t.TableName("orders", "hashed", "raw")): load(spark, sf, "orders"),
        str(t.TableName("part", "hashed", "clean")): load(spark, sf, "part"),
        str(t.TableName("nation")): load(spark, sf, "nation"),
    }
    return counted({n: every[n] for n in t.names_in_stage(list(every), "hashed", "raw")})


@query(
    "catalog_tables",
    "SELECT 'orders' AS name, 6 AS n_columns, count(*) AS n FROM orders",
)
def catalog_tables(spark, sf):
    sqltext.as_view(load(spark, sf, "orders"), "rollcall$raw$orders")
    return counted(t.read_catalog_tables(spark, r"^Rollcall\W"))


@query(
    "stack_tables",
    """SELECT o_orderkey AS id, o_totalprice AS amount, o_orderstatus AS status, NULL::VARCHAR AS flag FROM orders
UNION ALL SELECT l_orderkey, l_extendedprice, NULL, l_returnflag FROM lineitem""",
)
def stack_tables(spark, sf):
    family = {
        "orders": load(spark, sf, "orders").toDF("id", "person", "status", "amount", "date", "priority"),
        "lines": load(spark, sf, "lineitem").withColumnsRenamed(
            {"l_orderkey": "id", "l_extendedprice": "amount", "l_returnflag": "flag"}
        ),
    }
    return t.stack_columns(family, ["id", "amount", "status", "flag"])


@query(
    "parameterised_sql",
    """SELECT o_orderstatus, count(*) AS n, count(*) / (SELECT count(*) FROM orders) AS share FROM orders
WHERE o_totalprice > 100000 AND o_orderpriority <> '1-URGENT' GROUP BY o_orderstatus""",
)
def parameterised_sql(spark, sf):
    orders = load(spark, sf, "orders")
    counts = sqltext.run_sql(
        spark,
        "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE IDENTIFIER(:amount) > :least AND o_orderpriority <> :not_this "
        "GROUP BY o_orderstatus",
        {"amount": "o_totalprice", "least": 100000, "not_this": "1-URGENT"},
        orders=orders,
    )
    return counts.withColumn("share", F.col("n") / sqltext.scalar(orders.agg(F.count(F.lit(1)))))


@query(
    "model_registry",
    """SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, r_regionkey IN (2, 5) AS is_production, 0 AS n_features FROM region
UNION ALL SELECT 5, 'all features', true, 6""",
)
def model_registry(spark, sf):
    known = registry(spark, sf).select(
        "id",
        "name",
        F.lit("{}").alias("description"),
        F.array().cast("array<string>").alias("details"),
        (F.col("is_production") == 1).alias("is_production"),
    )
    spec = ModelSpec("all features", "cohort", "segment", ("BUILDING",), "orders", "orders", {"part": ("p_name",), "region": ()})
    blocks = {n: load(spark, sf, n) for n in ("part", "region")}
    grown, algorithm_id = models.register(known, spec, blocks, key=("p_partkey",))
    live = models.set_production(grown, [2, algorithm_id])
    return live.select("id", "name", "is_production", F.size("details").alias("n_features"))


@query(
    "cut_lineage",
    """SELECT l_orderkey, count(*) AS n, sum(l_quantity) AS quantity FROM lineitem GROUP BY l_orderkey""",
)
def cut_lineage(spark, sf):
    lines = load(spark, sf, "lineitem")
    return settle(lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("quantity")))


@query(
    "csv_folder_undeclared",
    """SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CASE WHEN s_suppkey % 3 > 0 THEN CAST(s_nationkey AS VARCHAR) END AS nation FROM supplier""",
)
def csv_folder_undeclared(spark, sf):
    supplier = load(spark, sf, "supplier")
    root = fresh_path(spark, "csv")
    sinks.write_csv(supplier.select("s_suppkey"), f"{root}/declared.csv")
    nation = F.when(F.col("s_suppkey") % 3 > 0, F.col("s_nationkey").cast("string")).otherwise("N/A").alias("nation")
    sinks.write_csv(supplier.select("s_suppkey", "s_name", nation), f"{root}/other.csv")
    return t.read_csv_folder(spark, root, {"declared": "s_suppkey bigint"})["other"]


@query(
    "rename_stored_table",
    "SELECT n_nationkey, n_name FROM nation",
)
def rename_stored_table(spark, sf):
    old, new = (f"{name}_{uuid.uuid4().hex}" for name in ("before", "after"))
    load(spark, sf, "nation").select("n_nationkey", "n_name").write.saveAsTable(old)
    sinks.rename_table(spark, old, new)
    out = settle(spark.table(new))
    spark.sql(f"DROP TABLE `{new}`")
    return out


STORED = "app_id bigint, price double, priority string, status string, app_year int"


def stored_applications(spark, sf):
    path = fresh_path(spark, "stored")
    applications(spark, sf).select("app_id", "price", "priority", "status", "app_year").write.partitionBy("app_year").parquet(path)
    return path


@query(
    "update_stored_table",
    f"""WITH {APPLICATIONS} SELECT app_id, app_year, status, CASE WHEN app_year = 1996 AND price > 200000 THEN price / 2 ELSE price END AS price,
  CASE WHEN app_year = 1996 AND price > 200000 THEN NULL ELSE priority END AS priority FROM apps""",
)
def update_stored_table(spark, sf):
    path = stored_applications(spark, sf)
    condition = (F.col("app_year") == 1996) & (F.col("price") > 200000)
    values = {"price": F.col("price") / 2, "priority": F.lit(None).cast("string")}
    sinks.update_table(spark, path, STORED, condition, values, ["app_year"])
    return spark.read.schema(STORED).parquet(path)


@query(
    "delete_from_stored_table",
    f"""WITH {APPLICATIONS} SELECT app_id, price, priority, status, app_year FROM apps
WHERE NOT coalesce(app_year = 1995 OR (app_year > 1996 AND priority = '5-LOW'), false)""",
)
def delete_from_stored_table(spark, sf):
    path = stored_applications(spark, sf)
    condition = (F.col("app_year") == 1995) | ((F.col("app_year") > 1996) & (F.col("priority") == "5-LOW"))
    sinks.delete_from_table(spark, path, STORED, condition, ["app_year"])
    return spark.read.schema(STORED).parquet(path)
