import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.operators import columns as cols
from rollcall.operators import types as kinds


def test_dates_are_promoted_only_if_every_value_parses(spark):
    df = spark.createDataFrame(
        [
            ("once", "a text", "2017-07-24", "2018-06-24 12:03:51", "2018/6/24 12:03:51"),
            ("twice", "more", "2016-01-02", "2017-01-02 01:02:03", "2017/1/2 1:02:03"),
        ],
        "a string, b string, c string, d string, e string",
    )
    out = kinds.promote_dates(df)
    assert [t for _, t in out.dtypes] == ["string", "string", "timestamp", "timestamp", "timestamp"]
    row = out.filter("a = 'once'").first()
    assert row["c"] == dt.datetime(2017, 7, 24) and row["e"] == dt.datetime(2018, 6, 24, 12, 3, 51)


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2018.06.24", dt.datetime(2018, 6, 24)),
        ("2018-06-24 7", dt.datetime(2018, 6, 24, 7)),
        ("2018-06-24T07:08", dt.datetime(2018, 6, 24, 7, 8)),
        ("2018-13-24", None),
        ("24-06-2018", None),
        ("2018", None),
        ("12:30", None),
        ("20180624", None),
        ("", None),
    ],
)
def test_year_first_layouts(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(kinds.year_first_timestamp(F.col("t"))).first()[0] == expected


def test_one_bad_date_keeps_text_and_null_is_ignored(spark):
    df = spark.createDataFrame([("2018-01-02", None, None), ("soon", "2018-01-02", None)], "a string, b string, c string")
    assert [t for _, t in kinds.promote_dates(df).dtypes] == ["string", "timestamp", "string"]


def test_zone_of_the_text(spark):
    df = spark.createDataFrame([("2018-07-01 12:00:00",)], "a string")
    out = kinds.promote_dates(df, zone="America/New_York").select(F.col("a").cast("string")).first()[0]
    assert out == "2018-07-01 16:00:00"


def test_two_layouts(spark):
    df = spark.createDataFrame([("2017-07-24 01:02:03",), ("24-Jul-17",), ("?",)], "t string")
    got = [r[0] for r in df.select(kinds.parse_dates(F.col("t"), ["yyyy-MM-dd HH:mm:ss", "dd-MMM-yy"])).collect()]
    assert got == [dt.datetime(2017, 7, 24, 1, 2, 3), dt.datetime(2017, 7, 24), None]


def test_empty_columns_leave(spark):
    rows = [("x", None, 1.0, 7.0, None), (None, "y", None, 7.0, None), ("z", "y", 2.0, 7.0, None)]
    df = spark.createDataFrame(rows, "a string, b string, c double, d double, e int")
    assert cols.drop_empty_cols(df).columns == ["a", "b", "c", "d"]
    assert cols.drop_empty_cols(df.limit(0)).columns == df.columns


def test_schema_agreement(spark):
    one = spark.createDataFrame([("a", "b", 1.0, 2.0, 3.0)] * 2, "a string, b string, c double, d double, e double")
    other = one.drop("b").withColumn("b2", F.lit(1.0)).select("a", "b2", "c", "d", "e")
    assert kinds.schemas_agree({"x": one, "y": one, "z": one}) == (True, True)
    assert kinds.schemas_agree({"x": one, "y": other, "z": one}) == (False, False)
    same = spark.createDataFrame([("a", "a"), (None, None)], "x string, y string")
    assert kinds.same_across_row(same).first()[0] is True
    assert kinds.same_across_row(same.union(spark.createDataFrame([("a", "b")], same.schema))).first()[0] is False


def test_keep_and_drop(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    with pytest.warns(UserWarning):
        assert cols.select_by_rule(df, keep=["c", "zzz", "a"]).columns == ["c", "a"]
    assert cols.select_by_rule(df, drop=["b"]).columns == ["a", "c"]
    with pytest.raises(ValueError):
        cols.select_by_rule(df)
    assert cols.rule_name("2014_old_test") == "old_test" and cols.rule_name("grades") == "grades"
    with pytest.raises(KeyError):
        cols.select_by_rules({"x": df}, {})


def test_names(spark):
    df = spark.createDataFrame([(1, 2)], ["First Name", "LAST"])
    assert cols.fix_colnames(df).columns == ["first_name", "last"]
    with pytest.raises(ValueError):
        cols.fix_colnames(spark.createDataFrame([(1, 2)], ["A b", "a_B"]))


def test_code_split_needs_the_spread(spark):
    df = spark.createDataFrame([(4, 0.0), (4, 0.7), (4, None), (2, None), (9, 0.0), (None, 0.0)], "code int, sd double")
    out = cols.split_code(df, "code", "sd", {2: (1, 1)}, {4: ((2, 2), (1, 3))}, ("a", "b", "t"))
    assert [(r["a"], r["b"], r["t"]) for r in out.collect()] == [
        (2, 2, 4), (1, 3, 4), (None, None, None), (1, 1, 2), (None, None, None), (None, None, None),
    ]


def test_yes_no_and_binary(spark):
    df = spark.createDataFrame(
        [("Y", "Y", None, 1.0, 5), ("N", "maybe", None, None, 5), (None, "N", None, 0.0, 7)],
        "a string, b string, c string, d double, e int",
    )
    assert kinds.yes_no_columns(df) == ["a", "c"]
    assert kinds.recode_yes_no(df).columns == ["b", "d", "e", "a", "c"]
    assert kinds.binary_columns(df) == ["a", "c", "d", "e"]
    assert kinds.binary_columns(df, exact=True) == ["a", "d", "e"]
    assert kinds.binary_columns(df, exact=True, count_null=True) == ["e"]
    assert kinds.binary_columns(df.limit(0), exact=True) == []
    types = {r["variable"]: (r["type"], r["is_binary"]) for r in kinds.variable_types(df).collect()}
    assert types == {"a": ("string", 0), "b": ("string", 0), "c": ("string", 1), "d": ("double", 0), "e": ("int", 1)}


def test_binary_times(spark):
    stamps = [dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1), dt.datetime(2020, 1, 1)]
    df = spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], "t timestamp, n int")
    assert kinds.binary_columns(df) == ["t"]


@pytest.mark.parametrize(
    "text,want",
    [
        ("20170724", "2017-07-24 00:00:00"),
        ("20170724 093005", "2017-07-24 09:30:05"),
        ("20170724093005", "2017-07-24 09:30:05"),
        ("2018-06-24 12-03-51", "2018-06-24 12:03:51"),
        ("2018/6/24 12.03.51", "2018-06-24 12:03:51"),
        ("2018.06.24T7:03", "2018-06-24 07:03:00"),
        ("2018-06-24 12-03", "2018-06-24 12:03:00"),
        ("2018-06-24 12:03:51.25", "2018-06-24 12:03:51.25"),
        ("20171324", None),
        ("2017072", None),
        ("201707241", None),
    ],
)
def test_year_first_layouts(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(kinds.year_first_timestamp(F.col("t")).cast("string").alias("t")).first()["t"]
    assert got == want
