"""Cleaning, renaming, recoding, identifiers, dates and types."""

from pyspark.sql import functions as F

from rollcall.functions import values as v
from rollcall.functions.rules import if_known
from rollcall.operators import columns as cols
from rollcall.operators import types as kinds
from rollcall.plans import staging
from rollcall.sources.sinks import alter_columns, delete_rows, update_rows
from workload.inputs import APPLICATIONS, PEOPLE, applications, load, people
from workload.registry import query


@query(
    "clean_stage",
    f"""WITH {APPLICATIONS}, kept AS (
  SELECT person_id, app_id, app_year, priority, price FROM apps
  WHERE decision IN ('invite', 'hold') AND NOT coalesce(priority IN ('2-HIGH'), false) AND app_year BETWEEN 1996 AND 2000)
SELECT person_id, app_id, app_year, priority, price,
  priority IS NOT NULL AS has_priority, price IS NOT NULL AS has_price FROM kept k
WHERE app_year = (SELECT min(app_year) FROM kept x WHERE x.person_id = k.person_id)""",
)
def clean_stage(spark, sf):
    apps = applications(spark, sf).withColumn("unused", F.lit(None).cast("string"))
    yearly = {
        f"{part}_applications": apps.filter(rule).select(
            "person_id", "app_id", "app_year", "decision", "priority", "price", *extra
        )
        for part, rule, extra in (("early", "app_year <= 1998", []), ("late", "app_year > 1998", ["unused"]))
    }
    rules = [F.col("decision").isin("invite", "hold"), ~F.coalesce(F.col("priority").isin("2-HIGH"), F.lit(False))]
    return staging.clean_applications(
        yearly,
        "person_id",
        "app_year",
        (1996, 2000),
        rules,
        {"has_priority": "priority", "has_price": "price"},
        drop=["decision"],
    )


@query(
    "drop_empty",
    "SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS partly, NULL::BIGINT AS rare FROM orders WHERE false "
    "UNION ALL SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT'), CASE WHEN o_orderkey % 500 = 0 THEN o_custkey END FROM orders",
)
def drop_empty(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_orderkey",
        F.nullif(F.col("o_orderpriority"), F.lit("1-URGENT")).alias("partly"),
        F.when(F.col("o_orderkey") % 500 == 0, F.col("o_custkey")).alias("rare"),
        F.when(F.col("o_totalprice") < 0, 1).alias("never"),
    )
    return cols.drop_empty_cols(rows)


@query("fix_names", 'SELECT p_partkey AS part_key, p_name AS part_name, p_size AS size_in_cm FROM part')
def fix_names(spark, sf):
    part = load(spark, sf, "part")
    return cols.fix_colnames(
        part.select(
            F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("PART NAME"), F.col("p_size").alias("Size in CM")
        )
    )


@query(
    "regex_rename",
    "SELECT l_orderkey AS order_id, l_quantity AS total_percentile, l_tax AS low_percentile, l_discount AS quantity FROM lineitem",
)
def regex_rename(spark, sf):
    rows = load(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_quantity").alias("total_high_p"),
        F.col("l_tax").alias("low_p"),
        F.col("l_discount").alias("quantitty"),
    )
    return cols.rename_regex(
        rows, {"(?<=low)_p$|_high_p$": "_percentile", "quantitty": "quantity"}
    )


@query("keep_drop", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def keep_drop(spark, sf):
    rules = {"people": {"keep": ["c_custkey", "c_mktsegment", "c_acctbal"]}, "parts": {"drop": ["p_name"]}}
    tables = {"2014_people": load(spark, sf, "customer"), "raw$x$parts": load(spark, sf, "part")}
    return cols.select_by_rules(tables, rules)["2014_people"]


@query(
    "select_by_pattern",
    """SELECT l_orderkey, l_quantity, l_extendedprice, l_discount, l_returnflag, l_linestatus, l_partkey, l_suppkey FROM lineitem""",
)
def select_by_pattern(spark, sf):
    return cols.select_like(
        load(spark, sf, "lineitem"),
        first=["l_orderkey"],
        starts=["l_return", "l_linestatus"],
        ends=["partkey", "suppkey"],
        between=("l_quantity", "l_discount"),
    )


@query(
    "names_by_type",
    """SELECT p_partkey, p_size AS n_p_size, p_retailprice AS p_retailprice_listed, upper(p_name) AS p_name,
  upper(p_brand) AS p_brand, upper(p_type) AS p_type, 'old' AS form FROM part""",
)
def names_by_type(spark, sf):
    part = load(spark, sf, "part")
    named = cols.prefix_by_type(part, "n", types=["int"], skip=["p_partkey"])
    shouted = cols.transform_by_type(named, "text", F.upper)
    return cols.tag(cols.suffix_columns(shouted, ["p_retailprice"], "listed"), form="old")


CODES = """codes AS (SELECT o_orderkey, CAST(left(o_orderpriority, 1) AS INTEGER) + 1 AS code,
  CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS spread FROM orders)"""


@query(
    "code_split",
    f"""WITH {CODES}, parts AS (
  SELECT o_orderkey, code,
    CASE code WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN CASE WHEN spread = 0 THEN 2 WHEN spread <> 0 THEN 1 END
      WHEN 5 THEN 2 WHEN 6 THEN 3 END AS a,
    CASE code WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN CASE WHEN spread = 0 THEN 2 WHEN spread <> 0 THEN 3 END
      WHEN 5 THEN 3 WHEN 6 THEN 3 END AS b FROM codes)
SELECT o_orderkey, code, a, b, a + b AS total FROM parts""",
)
def code_split(spark, sf):
    rows = load(spark, sf, "orders").select(
        "o_orderkey",
        (F.substring("o_orderpriority", 1, 1).cast("int") + 1).alias("code"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).alias("spread"),
    )
    pairs = {2: (1, 1), 3: (1, 2), 5: (2, 3), 6: (3, 3)}
    return cols.split_code(rows, "code", "spread", pairs, {4: ((2, 2), (1, 3))}, ("a", "b", "total")).drop("spread")


PARTS = """parts AS (SELECT l_orderkey, l_linenumber, l_partkey,
  CASE WHEN l_returnflag <> 'N' THEN l_quantity END AS first_hrs,
  CASE WHEN l_linestatus = 'O' THEN l_quantity * 2 END AS second_hrs FROM lineitem)"""


def part_hours(spark, sf):
    return load(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.when(F.col("l_returnflag") != "N", F.col("l_quantity")).alias("first_hrs"),
        F.when(F.col("l_linestatus") == "O", F.col("l_quantity") * 2).alias("second_hrs"),
    )


@query(
    "row_totals",
    f"""WITH {PARTS} SELECT *, 0 + coalesce(first_hrs, 0) + coalesce(second_hrs, 0) AS total_hrs,
  0 + first_hrs + second_hrs AS strict_hrs FROM parts""",
)
def row_totals(spark, sf):
    hours = ["first_hrs", "second_hrs"]
    return part_hours(spark, sf).withColumns(
        {"total_hrs": cols.row_total(hours, missing_as_zero=True), "strict_hrs": cols.row_total(hours)}
    )


@query(
    "fill_missing",
    f"""WITH {PARTS}
SELECT l_orderkey, l_linenumber, l_partkey, coalesce(first_hrs, 0) AS first_hrs, coalesce(second_hrs, -1) AS second_hrs FROM parts""",
)
def fill_missing(spark, sf):
    return cols.fill_values(part_hours(spark, sf), {"first_hrs": 0.0, "second_hrs": -1.0})


@query(
    "mask_years",
    f"""WITH {APPLICATIONS} SELECT app_id, app_year,
  CASE WHEN app_year BETWEEN 1996 AND 1999 THEN price END AS price,
  CASE WHEN app_year BETWEEN 1998 AND 2001 THEN status END AS status FROM apps""",
)
def mask_years(spark, sf):
    apps = applications(spark, sf).select("app_id", "app_year", "price", "status")
    return cols.mask_outside_years(apps, {"price": (1996, 1999), "status": (1998, 2001)})


@query("hash_key", "SELECT md5(CAST(c_custkey AS VARCHAR)) AS subject, c_custkey, c_mktsegment, c_acctbal FROM customer")
def hash_key(spark, sf):
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    return staging.hash_key(rows, "c_custkey", "subject", salt=None)


@query(
    "hash_key_salted",
    "SELECT sha256('pepper' || CAST(c_custkey AS VARCHAR)) AS subject, c_mktsegment, c_acctbal FROM customer",
)
def hash_key_salted(spark, sf):
    rules = {"people": {"drop": ["c_name", "c_nationkey"]}}
    tables = {"people": load(spark, sf, "customer"), "regions": load(spark, sf, "region")}
    return staging.deidentify(tables, "c_custkey", "subject", "pepper", rules)["people"]


@query(
    "promote_dates",
    """SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) AS dashes, CAST(o_orderdate AS TIMESTAMP) AS slashes,
  strftime(o_orderdate, '%d.%m.%Y') AS other_order,
  CASE WHEN o_orderkey = 7 THEN 'unknown' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS one_bad FROM orders""",
)
def promote_dates(spark, sf):
    date = F.col("o_orderdate")
    rows = load(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(date, "yyyy-MM-dd HH:mm:ss").alias("dashes"),
        F.date_format(date, "yyyy/MM/dd").alias("slashes"),
        F.date_format(date, "dd.MM.yyyy").alias("other_order"),
        F.when(F.col("o_orderkey") == 7, "unknown").otherwise(F.date_format(date, "yyyy-MM-dd")).alias("one_bad"),
    )
    found = kinds.promote_dates(rows)
    stamps = {c: F.col(c).cast("timestamp_ntz") for c, t in found.dtypes if t == "timestamp"}
    return found.withColumns(stamps)


@query(
    "parse_two_formats",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_orderdate AS TIMESTAMP) END AS parsed FROM orders""",
)
def parse_two_formats(spark, sf):
    date, kind = F.col("o_orderdate"), F.col("o_orderkey") % 3
    text = (
        F.when(kind == 0, F.date_format(date, "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format(date, "dd-MMM-yyyy"))
        .otherwise("no date")
    )
    parsed = kinds.parse_dates(text, ["yyyy-MM-dd HH:mm:ss", "dd-MMM-yyyy"])
    return load(spark, sf, "orders").select("o_orderkey", parsed.cast("timestamp_ntz").alias("parsed"))


@query(
    "yes_no_recode",
    f"""WITH {PEOPLE} SELECT person_id, segment, nation, balance,
  CASE home WHEN 'Y' THEN 1.0::DOUBLE WHEN 'N' THEN 0.0::DOUBLE END AS home, NULL::DOUBLE AS empty FROM people""",
)
def yes_no_recode(spark, sf):
    return kinds.recode_yes_no(people(spark, sf).withColumn("empty", F.lit(None).cast("string")))


BINARY = """SELECT doc_id, quality, toxic, CASE WHEN toxic = 1 THEN quality END AS quality_of_toxic FROM labels"""


def label_rows(spark, sf):
    rows = load(spark, sf, "labels").join(load(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    return rows.withColumn("quality_of_toxic", F.when(F.col("toxic") == 1, F.col("quality")))


@query("binary_columns", BINARY)
def binary_columns(spark, sf):
    return kinds.select_binary(label_rows(spark, sf), ["doc_id"], numeric=True)


@query(
    "variable_types",
    """SELECT 'doc_id' AS variable, 'bigint' AS "type", CAST(count(DISTINCT doc_id) <= 2 AS INTEGER) AS is_binary FROM labels
UNION ALL SELECT 'quality', 'int', CAST(count(DISTINCT quality) <= 2 AS INTEGER) FROM labels
UNION ALL SELECT 'toxic', 'int', CAST(count(DISTINCT toxic) <= 2 AS INTEGER) FROM labels
UNION ALL SELECT 'lang', 'string', CAST(count(DISTINCT lang) <= 2 AS INTEGER) FROM documents JOIN labels USING (doc_id)
UNION ALL SELECT 'quality_of_toxic', 'int', CAST(count(DISTINCT coalesce(CASE WHEN toxic = 1 THEN quality END, -1)) <= 2 AS INTEGER) FROM labels""",
)
def variable_types(spark, sf):
    return kinds.variable_types(label_rows(spark, sf))


@query("date_display", "SELECT o_orderkey, strftime(o_orderdate, '%m-%d-%y') AS o_orderdate FROM orders")
def date_display(spark, sf):
    return kinds.display_dates(load(spark, sf, "orders").select("o_orderkey", "o_orderdate"))


@query(
    "schema_agreement",
    """SELECT 'years and priorities' AS tables, true AS names_agree, true AS types_agree,
  (SELECT bool_and(CAST(o_orderkey AS VARCHAR) = CAST(o_orderkey AS VARCHAR)) FROM orders) AS rows_agree
UNION ALL SELECT 'status and flag', true, true, (SELECT bool_and(l_returnflag = l_linestatus) FROM lineitem)
UNION ALL SELECT 'orders and customers', false, false, (SELECT bool_and(o_orderkey = o_custkey) FROM orders)""",
)
def schema_agreement(spark, sf):
    orders, lines = load(spark, sf, "orders"), load(spark, sf, "lineitem")
    families = {
        "years and priorities": (
            {"a": orders.filter("year(o_orderdate) < 1998"), "b": orders.filter("year(o_orderdate) >= 1998")},
            orders.select("o_orderkey", F.col("o_orderkey").alias("again")),
        ),
        "status and flag": ({"a": lines, "b": lines}, lines.select("l_returnflag", "l_linestatus")),
        "orders and customers": (
            {"a": orders, "b": load(spark, sf, "customer")},
            orders.select("o_orderkey", "o_custkey"),
        ),
    }
    out = None
    for name, (tables, pairs) in families.items():
        names, types = kinds.schemas_agree(tables)
        row = kinds.same_across_row(pairs).select(
            F.lit(name).alias("tables"),
            F.lit(names).alias("names_agree"),
            F.lit(types).alias("types_agree"),
            F.col("all_equal").alias("rows_agree"),
        )
        out = row if out is None else out.unionByName(row)
    return out


@query(
    "scalar_functions",
    f"""WITH {APPLICATIONS}
SELECT app_id, CASE WHEN score > 0.4 THEN 'yes' WHEN score > -0.2 THEN 'maybe' ELSE 'no' END AS band,
  round(score, 1) AS away, round_even(score, 1) AS even, left(priority, 3) AS start,
  TRY_CAST(regexp_replace(priority, '-.*', '') AS INTEGER) AS code, regexp_replace(priority, '[0-9]-', '') AS word,
  CASE decision WHEN 'invite' THEN 2 WHEN 'hold' THEN 1 WHEN 'reject' THEN 0 END AS class,
  CASE WHEN app_year <= 1997 THEN '_1995_1997' WHEN app_year <= 1999 THEN '_1998_1999' ELSE '' END AS year_band,
  CASE WHEN priority = '5-LOW' THEN 'low' WHEN priority <> '5-LOW' THEN 'other' END AS strict_if,
  coalesce(CAST(priority = '5-LOW' AS INTEGER), 0) AS low_or_zero, coalesce(priority, 'N/A') AS priority,
  lower(decision) || '/' || status AS pasted FROM apps""",
)
def scalar_functions(spark, sf):
    apps = applications(spark, sf)
    low = F.col("priority") == "5-LOW"
    picked = apps.select(
        "app_id",
        v.band("score", -0.2, 0.4, ("no", "maybe", "yes")).alias("band"),
        v.round_away("score", 1).alias("away"),
        v.round_even("score", 1).alias("even"),
        v.first_letters("priority", 3).alias("start"),
        v.to_number(v.strip_text("priority", "-.*"), "int").alias("code"),
        v.strip_text("priority", "[0-9]-").alias("word"),
        v.recode("decision", {"invite": 2, "hold": 1, "reject": 0}).alias("class"),
        v.year_band("app_year", [(1997, "_1995_1997"), (1999, "_1998_1999")]).alias("year_band"),
        if_known(low, F.lit("low"), F.lit("other")).alias("strict_if"),
        v.flag_or_zero(low).alias("low_or_zero"),
        "priority",
        F.concat_ws("/", F.lower("decision"), "status").alias("pasted"),
    )
    return v.explicit_missing(picked, ["priority"])


@query(
    "update_delete",
    f"""WITH {APPLICATIONS}
SELECT app_id AS id, CASE WHEN priority = '5-LOW' THEN 'none' ELSE status END AS status,
  CAST(floor(price) AS BIGINT) AS price, priority FROM apps WHERE NOT coalesce(priority = '2-HIGH', false)""",
)
def update_delete(spark, sf):
    apps = applications(spark, sf).select("app_id", "app_year", "status", F.floor("price").cast("double").alias("price"), "priority")
    changed = update_rows(apps, F.col("priority") == "5-LOW", {"status": "none"})
    left = delete_rows(changed, F.col("priority") == "2-HIGH")
    return alter_columns(left, rename={"app_id": "id"}, retype={"price": "bigint"}, drop=["app_year"])


FIXES = {
    "applications": staging.Fixes(
        rename={"_high$": ""},
        numbers={"screener": "Screener "},
        fill={"first_hrs": 0.0, "second_hrs": 0.0},
        totals={"hrs": ["first_hrs", "second_hrs"], "price_and_first": ["price", "first_hrs"]},
        split=staging.SplitCode("code", "spread", {2: (1, 1), 3: (1, 2), 5: (2, 3), 6: (3, 3)}, {4: ((2, 2), (1, 3))}, ("part_a", "part_b", "part_total")),
        flags={"is_screened": "screener", "is_never": "never"},
        drop=["spread", "code", "never"],
    )
}


@query(
    "clean_stage_fixes",
    """WITH a AS (
  SELECT o_orderkey AS app_id, CASE WHEN o_orderkey % 4 > 0 THEN o_orderkey % 4 END AS screener, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END AS price,
    coalesce(CASE WHEN o_orderkey % 3 = 0 THEN 2.5 END, 0) AS first_hrs, coalesce(CASE WHEN o_orderkey % 5 = 0 THEN 4.0 END, 0) AS second_hrs,
    CAST(substr(o_orderpriority, 1, 1) AS INTEGER) + 1 AS code, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 END AS spread FROM orders),
p AS (
  SELECT *, CASE code WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN CASE spread WHEN 0 THEN 2 WHEN 1 THEN 1 END WHEN 5 THEN 2 WHEN 6 THEN 3 END AS part_a,
    CASE code WHEN 2 THEN 1 WHEN 3 THEN 2 WHEN 4 THEN CASE spread WHEN 0 THEN 2 WHEN 1 THEN 3 END WHEN 5 THEN 3 WHEN 6 THEN 3 END AS part_b FROM a)
SELECT app_id, CAST(screener AS INTEGER) AS screener, price, CAST(first_hrs AS DOUBLE) AS first_hrs, CAST(second_hrs AS DOUBLE) AS second_hrs,
  CAST(first_hrs + second_hrs AS DOUBLE) AS hrs, price + first_hrs AS price_and_first, part_a, part_b, part_a + part_b AS part_total,
  screener IS NOT NULL AS is_screened, false AS is_never FROM p""",
)
def clean_stage_fixes(spark, sf):
    k = F.col("o_orderkey")
    rows = load(spark, sf, "orders").select(
        k.alias("app_id"),
        F.when(k % 4 > 0, F.concat(F.lit("Screener "), (k % 4).cast("string"))).alias("screener"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("price_high"),
        F.when(k % 3 == 0, 2.5).alias("first_hrs"),
        F.when(k % 5 == 0, 4.0).alias("second_hrs"),
        (F.substring("o_orderpriority", 1, 1).cast("int") + 1).alias("code"),
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).alias("spread"),
        F.lit(None).cast("string").alias("never"),
        F.lit(None).cast("string").alias("unused"),
    )
    return staging.clean_tables({"applications": rows, "other": rows}, FIXES)["applications"]
