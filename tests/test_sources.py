import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelcast.config import RunConfig
from panelcast.sources import sinks
from panelcast.sources import (
    SCHEMAS, content_state, input_state, materialize, narrow_types, parameter_key, parse_dates, publish, read_csv_quarantined,
    read_csv_table, read_or_build, read_published, read_tables, shared_folder, write_dataset, write_report,
)


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "train.csv").write_text(
        "id,date,store_nbr,family,sales,onpromotion\n0,2013-01-01,1,AUTOMOTIVE,0.0,0\n1,2013-01-02,2,BABY CARE,3.5,4\n"
    )
    (tmp_path / "bad.csv").write_text("id,date,store_nbr,family,sales,onpromotion\n0,2013-01-01,one,AUTOMOTIVE,0.0,0\n")
    return tmp_path


def test_csv_with_declared_schema(spark, folder):
    df = read_csv_table(spark, str(folder / "train.csv"), SCHEMAS["train"])
    assert df.schema == SCHEMAS["train"] and df.agg(F.sum("sales")).first()[0] == 3.5
    assert df.first().date == dt.date(2013, 1, 1)


def test_bad_value_fails_the_read(spark, folder):
    with pytest.raises(Exception, match="(?i)malformed"):
        read_csv_table(spark, str(folder / "bad.csv"), SCHEMAS["train"]).collect()


def test_wrong_header_fails_the_read(spark, folder):
    with pytest.raises(Exception, match="(?i)header"):
        read_csv_table(spark, str(folder / "train.csv"), SCHEMAS["test"]).collect()


def test_inferred_read_and_date_parsing(spark, folder):
    tables = {"t": read_csv_table(spark, str(folder / "train.csv"))}
    assert dict(parse_dates(tables)["t"].dtypes)["date"] == "date"


def test_registry(spark, folder):
    files = {"train": "train.csv"}
    tables = read_tables(spark, str(folder), files, views=True)
    assert list(tables) == ["train"] and spark.table("train").count() == 2


def test_nan_becomes_null(spark, tmp_path):
    spark.sql("SELECT double('NaN') AS v UNION ALL SELECT 1.0").write.parquet(str(tmp_path / "x.parquet"))
    table = read_tables(spark, str(tmp_path), {"x": "x.parquet"})["x"]
    assert sorted((r.v is None) for r in table.collect()) == [False, True]


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 5), (300, 40000)], "store_nbr int, onpromotion int")
    assert dict(narrow_types(df).dtypes) == {"store_nbr": "smallint", "onpromotion": "smallint"}
    with pytest.raises(Exception, match="CAST_OVERFLOW"):
        narrow_types(df).collect()
    assert narrow_types(df, strict=False).orderBy("store_nbr").collect()[1].onpromotion is None


def test_write_partitioned(spark, tmp_path):
    path = str(tmp_path / "out")
    write_dataset(spark.range(100).selectExpr("id", "id % 3 AS horizon"), path, ["horizon"])
    assert spark.read.parquet(path).where("horizon = 1").count() == 33
    write_dataset(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_read_or_build(spark, tmp_path):
    path, calls = str(tmp_path / "set"), []

    def build():
        calls.append(1)
        return spark.range(len(calls) * 10)

    key = parameter_key("v1", {"a": 1})
    assert read_or_build(spark, path, key, build).count() == 10
    assert read_or_build(spark, path, key, build).count() == 10 and len(calls) == 1
    assert parameter_key("v2", {"a": 1}) != key
    assert read_or_build(spark, path, parameter_key("v2", {"a": 1}), build).count() == 20
    # data without the marker is an unfinished write
    spark.range(3).write.parquet(f"{path}/half")
    assert read_or_build(spark, path, "half", build).count() == 30


def test_input_state_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "rows/day=1")
    state = lambda: input_state({"a": spark.read.parquet(path), "b": spark.range(3)})
    spark.range(5).write.parquet(path)
    before = state()
    assert state() == before != input_state({"b": spark.range(3)})
    spark.range(5, 9).write.mode("append").parquet(path)
    assert state() != before


def test_materialize_uses_the_shared_folder(spark):
    table = materialize(spark.range(10).withColumn("v", F.col("id") * 2), "numbers")
    assert table.count() == 10
    assert shared_folder(spark) in table.inputFiles()[0]


def test_report(spark, tmp_path):
    path = str(tmp_path / "report")
    table = spark.sql("SELECT * FROM VALUES (1.23456D, 'x'), (-7.0D, 'y'), (NULL, 'z') AS t(mae, name)")
    write_report(table, path, {"mae": 2}, ["-abs(mae)"])
    rows = spark.read.option("header", True).csv(path).collect()
    assert [(r.mae, r.name) for r in rows] == [("-7.0", "y"), ("1.23", "x"), (None, "z")]


def test_run_paths(monkeypatch):
    monkeypatch.setenv("PANELCAST_OUTPUT_DIR", "s3a://bucket/out/")
    assert RunConfig(run_tag="t").dataset("train") == "s3a://bucket/out/t/datasets/train"
    monkeypatch.delenv("PANELCAST_OUTPUT_DIR")
    assert RunConfig().model("m") == "outputs/1yr_h15/models/m"


def test_content_state(spark, tmp_path):
    """Changed rows of a table that no file holds rebuild an artifact; their order does not."""
    make = lambda rows: spark.createDataFrame(rows, "a int, b string, c map<string,int>")
    rows = [(1, "x", {"k": 1}), (2, None, None), (2, None, None)]
    before = content_state(make(rows))
    assert content_state(make(rows[::-1]).repartition(3)) == before
    others = [rows[:2], [*rows, rows[0]], [(1, "x", {"k": 2}), *rows[1:]], [(1, "y", {"k": 1}), *rows[1:]], []]
    assert len({before, *map(content_state, map(make, others))}) == 6
    calls = []
    for table in (rows, rows[::-1], others[0], rows):
        key = parameter_key(input_state({"t": make(table)}))
        read_or_build(spark, str(tmp_path), key, lambda: calls.append(1) or make(table).drop("c"))
    assert len(calls) == 2


def test_publishing_is_whole_or_not_at_all(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(FileNotFoundError):
        read_published(spark, path)
    publish(spark.range(10).withColumn("p", F.col("id") % 2), path, ["p"])
    reader = read_published(spark, path)
    failing = spark.range(5).select(F.raise_error(F.lit("broken")).cast("long").alias("id"), F.lit(0).alias("p"))
    with pytest.raises(Exception, match="broken"):
        publish(failing, path)
    assert read_published(spark, path).count() == 10
    publish(spark.range(3), path)
    # a reader opened before the rebuild still reads whole data
    assert reader.count() == 10 and reader.where("p = 1").count() == 5
    assert read_published(spark, path).count() == 3


def test_two_builders_of_one_key(spark, tmp_path):
    path = str(tmp_path / "set")

    def build():
        # another run finishes the same key meanwhile
        publish(spark.range(7), f"{path}/k")
        return spark.range(7).repartition(3)

    own = read_or_build(spark, path, "k", build)
    later = read_or_build(spark, path, "k", lambda: pytest.fail("built again"))
    assert own.count() == later.count() == 7 and own.inputFiles() != later.inputFiles()
    assert read_or_build(spark, path, "k", build).inputFiles() == later.inputFiles()


def test_quarantine(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,date,sales\n1,2020-01-01,2.5\n2,soon,1\nx,2020-01-03,much\n4,2020-01-04\n5,2020-01-05,1,9\n6,,\n")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("date", T.DateType()), T.StructField("sales", T.DoubleType())])
    good, bad = read_csv_quarantined(spark, str(tmp_path), schema)
    assert good.columns == ["id", "date", "sales"] and sorted(r.id for r in good.collect()) == [1, 6]
    found = {r.line: r.reason for r in bad.collect()}
    assert found == {
        "2,soon,1": "date", "x,2020-01-03,much": "id, sales", "4,2020-01-04": "number of fields", "5,2020-01-05,1,9": "number of fields",
    }
    assert all(r.file.endswith("a.csv") for r in bad.collect())


def test_a_cluster_needs_a_shared_folder():
    assert sinks._shared_folder("hdfs://n/c/", "file:/w", "yarn") == "hdfs://n/c"
    assert sinks._shared_folder(None, "hdfs://n/w/", "yarn") == "hdfs://n/w/_intermediate"
    assert sinks._shared_folder(None, "file:/w", "local[8]") == "file:/w/_intermediate"
    for warehouse in ("file:/w", "/w"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            sinks._shared_folder(None, warehouse, "spark://h:7077")
