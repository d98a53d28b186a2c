"""Rows with NULL, blank, NaN or unlisted values are kept."""

import pytest
from pyspark.sql import functions as F

from rollcall.modelling import evaluation, fitting
from rollcall.operators import ordered, people, relational, types
from rollcall.session import fresh_path
from rollcall.sources import sinks, tables


def test_null_persons_and_groups(spark):
    df = spark.createDataFrame([(None, 2011), (None, 2012), (1, 2011), (1, 2013)], "p int, y int")
    assert sorted(r["y"] for r in people.first_rows(df, "p", "y", 2000, 2020).collect()) == [2011, 2011]
    assert sorted(r["y"] for r in people.last_rows(df, "p", "y", 2000, 2020).collect()) == [2012, 2013]
    assert [r["n_rows"] for r in people.with_group_size(df, ["p"]).collect()] == [2, 2, 2, 2]
    assert relational.duplicate_rows(df, ["p"]).count() == 4


def test_bands_of_null_blank_and_zero(spark):
    df = spark.createDataFrame([(None, 1, "a"), ("", 2, "b"), ("0", 3, None)], "band string, year int, v string")
    root = fresh_path(spark, "bands")
    written = sinks.write_split(df, "band", root, "year")
    assert written == {"unknown": ["year", "v"], "rest": ["year", "v"], "0": ["year"]}
    assert sum(tables.read_csv_na(spark, f"{root}/{b}", "year int").count() for b in written) == 3
    with pytest.raises(ValueError):
        sinks.write_split(df.replace("0", "rest"), "band", fresh_path(spark, "bands"), "year")


def test_confusion_with_unlisted_and_missing_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "z"), ("a", None), (None, "a")], "actual string, predicted string")
    rows = {(r.actual, r.predicted): (r.n, r.share) for r in evaluation.confusion(df, "actual", "predicted", ["a", "b"], True).collect()}
    assert rows[("a", "a")] == (1, pytest.approx(1 / 3)) and rows[("a", "z")][0] == 1 and rows[(None, "a")] == (1, 1.0)
    assert rows[("b", "b")] == (0, None) and sum(n for n, _ in rows.values()) == 4


def test_only_nan_is_one_value(spark):
    df = spark.createDataFrame([(float("nan"),), (float("nan"),)], "x double")
    assert types.binary_columns(df, ["x"]) == []


def test_texts_with_a_long_common_beginning_are_dealt_out(spark):
    df = spark.range(20_000).select(F.concat(F.lit("/very/long/" * 20), F.format_string("%08d", "id")).alias("t"))
    slots = ordered._text_slots(df, {"t": "slot"}).groupBy("slot").count()
    assert slots.count() > 20 and slots.agg(F.max("count")).first()[0] < 4000


def test_unknown_grid_options_are_errors(spark):
    with pytest.raises(ValueError, match="criterion"):
        fitting.build_grid(None, {"randomforestclassifier": {"criterion": ["gini"]}}, 10)
