import pytest
from pyspark.sql import functions as F

from rollcall.session import fresh_path, settle, shared_folder
from rollcall.sources import sinks, sqltext, tables as t


def test_names():
    name = t.TableName("grades", "hashed", "raw")
    assert str(name) == "hashed$raw$grades" and t.TableName.parse(str(name)) == name and name.path == "hashed/raw/grades"
    assert t.suffix("a$b$c$d") == "c$d" and t.suffix("plain") == "plain"
    names = ["hashed$raw$x", "hashed$raw$2014_x", "hashed$rawer$x", "hashed$clean$x", "my$hashed$raw$x"]
    assert t.names_in_stage(names, "hashed", "raw") == names[:2]


def test_tables_on_disk(spark):
    root = fresh_path(spark, "tables")
    frames = {"a$b$one": spark.range(3), "a$c$two": spark.range(2).select(F.col("id").alias("x"), (F.col("id") > 0).alias("f"))}
    sinks.write_tables(frames, root)
    assert set(t.list_tables(spark, root)) == set(frames)
    found = t.read_tables(spark, root, r"^A\WC")
    assert list(found) == ["two"] and found["two"].dtypes == [("x", "bigint"), ("f", "int")]
    assert t.tables_with_column(t.read_tables(spark, root), "id") == ["one"]
    assert t.feature_catalog({"b": found["two"]}, {"b": ["f"]}, ["id"]) == ["b.x"]


def test_csv_tokens_quotes_and_bad_numbers(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "people.csv").write_text('id,name,n,extra\n1,"a ""b"", c",1.5,x\n2,NA,N/A,x\n3,null,oops,x\n4,,7,x\n')
    out = t.read_csv_folder(spark, str(folder), {"people": "id int, name string, n double, extra string"}, drop=["extra"])
    assert [tuple(r) for r in out["people"].orderBy("id").collect()] == [(1, 'a "b", c', 1.5), (2, None, None), (3, None, None), (4, None, 7.0)]


def test_split_writes_bands_without_their_empty_columns(spark):
    rows = spark.range(100).select(
        "id", (F.col("id") % 5 + 2010).cast("int").alias("year"), F.when(F.col("id") % 5 < 2, "x").alias("Old Only")
    )
    rows = rows.withColumn("band", F.when(F.col("year") < 2012, "_old").otherwise(""))
    root = fresh_path(spark, "bands")
    written = sinks.write_split(rows, "band", root, "year", ["id"])
    assert written == {"_old": ["id", "year", "old_only"], "rest": ["id", "year"]}
    old = t.read_csv_na(spark, f"{root}/_old", "id bigint, year int, old_only string")
    assert old.count() == 40


def test_update_and_delete_leave_unknown_rows(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "id int, s string")
    changed = sinks.update_rows(df, F.col("s") == "a", {"s": "z", "id": F.col("id") * 10})
    assert [tuple(r) for r in changed.collect()] == [(10, "z"), (2, None), (3, "b")]
    assert [r["id"] for r in sinks.delete_rows(df, F.col("s") == "a").collect()] == [2, 3]


def test_parameters_are_values_and_names(spark):
    df = spark.createDataFrame([("x' OR '1'='1", 1), ("y", 2)], "s string, n int")
    text = "SELECT IDENTIFIER(:c) AS v FROM {rows} WHERE s = :s"
    assert [r["v"] for r in sqltext.run_sql(spark, text, {"c": "n", "s": "x' OR '1'='1"}, rows=df).collect()] == [1]


def test_settle_and_shared_folder(spark):
    folder = shared_folder(spark)
    assert folder and settle(spark.range(5)).count() == 5
    assert fresh_path(spark, "a") != fresh_path(spark, "a")


def test_renaming_a_catalog_table_and_appending_columns(spark):
    stacked = t.stack_columns({"a": spark.range(1), "b": spark.range(2).withColumn("x", F.lit(1))}, ["id", "x"])
    assert sorted((r["id"], r["x"]) for r in stacked.collect() if r["x"]) == [(0, 1), (1, 1)]
    with pytest.raises(ValueError):
        sinks.fix_colnames(spark.createDataFrame([(1, 2)], ["A", "a "[:1]]))


STORED = "id int, v double, part int"


def stored(spark, rows):
    path = fresh_path(spark, "stored")
    spark.createDataFrame(rows, STORED).write.partitionBy("part").parquet(path)
    return path


def rows_at(spark, path):
    return sorted((tuple(r) for r in spark.read.schema(STORED).parquet(path).collect()), key=str)


def test_update_rewrites_only_touched_partitions(spark):
    path = stored(spark, [(1, 1.0, 1), (2, 2.0, 1), (3, None, 2), (4, 4.0, None)])
    before = {f for f in spark.read.parquet(path).inputFiles() if "part=2" in f}
    assert sinks.update_table(spark, path, STORED, (F.col("v") > 1.5) & F.coalesce(F.col("part") != 2, F.lit(True)), {"v": F.col("v") * 10}, ["part"]) == 2
    assert rows_at(spark, path) == [(1, 1.0, 1), (2, 20.0, 1), (3, None, 2), (4, 40.0, None)]
    assert {f for f in spark.read.parquet(path).inputFiles() if "part=2" in f} == before
    assert sinks.update_table(spark, path, STORED, F.col("v") < 0, {"v": 0.0}, ["part"]) == 0
    with pytest.raises(ValueError, match="partition columns"):
        sinks.update_table(spark, path, STORED, F.col("id") == 1, {"part": 7}, ["part"])


def test_delete_can_empty_a_partition_or_a_table(spark):
    path = stored(spark, [(1, 1.0, 1), (2, 2.0, 1), (3, None, 2), (4, 4.0, None)])
    assert sinks.delete_from_table(spark, path, STORED, F.col("part").isNull() | (F.col("id") == 3), ["part"]) == 2
    assert rows_at(spark, path) == [(1, 1.0, 1), (2, 2.0, 1)]
    assert sinks.delete_from_table(spark, path, STORED, F.col("v") > 1, ["part"]) == 1
    assert rows_at(spark, path) == [(1, 1.0, 1)]
    plain = fresh_path(spark, "plain")
    spark.createDataFrame([(1, 1.0, 1), (2, None, 1)], STORED).write.parquet(plain)
    assert sinks.delete_from_table(spark, plain, STORED, F.col("v") > 0) == 1 and rows_at(spark, plain) == [(2, None, 1)]
    assert sinks.delete_from_table(spark, plain, STORED, F.lit(True)) == 1 and rows_at(spark, plain) == []


def test_csv_files_without_a_schema(spark):
    root = fresh_path(spark, "csv")
    for name in ("a", "b"):
        sinks.write_csv(spark.createDataFrame([(1, "NA")], "n int, t string"), f"{root}/{name}.csv")
    found = t.read_csv_folder(spark, root, {"a": "n int, t string"})
    assert found["b"].dtypes == [("n", "string"), ("t", "string")] and found["b"].first()["t"] is None
    assert set(t.read_csv_folder(spark, root, {"a": "n int"}, undeclared="skip")) == {"a"}
    with pytest.raises(ValueError, match="no schemas for b"):
        t.read_csv_folder(spark, root, {"a": "n int"}, undeclared="error")
    with pytest.raises(FileNotFoundError, match="other"):
        t.read_csv_folder(spark, root, {"other": "n int"})
