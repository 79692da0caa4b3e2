import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plan_text import plan_of
from parcelry.functions.columns import nan_to_null
from parcelry.sources import tables

SCHEMA = "id long, price double, note string, day date"


def schema(spark):
    return spark.createDataFrame([], SCHEMA).schema


def test_csv_round_trip_of_awkward_text(spark, tmp_path):
    rows = [
        (1, 0.1 + 0.2, 'says "hi", twice', datetime.date(2026, 1, 2)),
        (2, None, None, None),
        (3, 1e-300, " padded ; back\\slash ", datetime.date(1999, 12, 31)),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    path = tables.write_csv(df, str(tmp_path / "csv"))
    assert tables.read_csv(spark, path, df.schema).orderBy("id").collect() == df.orderBy("id").collect()
    broken = df.withColumn("note", F.lit("two\nlines"))
    path = tables.write_csv(broken, str(tmp_path / "lines"))
    assert tables.read_csv(spark, path, df.schema, multi_line=True).orderBy("id").collect() == broken.orderBy("id").collect()


def test_csv_missing_texts_become_null_and_bad_numbers_fail(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.csv").write_text('id,price,note,day\n1,NaN,"",2026-01-01\n2,NA,n/a,\n3,4.5,ok,2026-01-02\n')
    found = tables.read_csv(spark, str(folder), schema(spark)).orderBy("id").collect()
    assert [(r["price"], r["note"]) for r in found] == [(None, None), (None, None), (4.5, "ok")]
    (folder / "b.csv").write_text("id,price,note,day\n4,cheap,x,\n")
    with pytest.raises(PySparkException):
        tables.read_csv(spark, str(folder), schema(spark)).collect()


def test_priced_scans_and_nan(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, float("nan")), (4, -1.0), (5, 0.0)], "id long, price double")
    assert [r["id"] for r in tables.scan_priced(df).collect()] == [1, 4, 5]
    assert [r["id"] for r in tables.scan_positive_priced(df).collect()] == [1]
    assert [r["price"] for r in nan_to_null(df).filter("id = 3").collect()] == [None]
    assert nan_to_null(spark.range(1)).columns == ["id"]


def test_price_filter_reaches_the_file_scan(spark, tmp_path):
    spark.range(10).select((F.col("id") * 1.0).alias("price"), F.lit(1).alias("wide")).write.parquet(str(tmp_path / "p"))
    df = spark.read.parquet(str(tmp_path / "p"))
    plan = plan_of(tables.scan_positive_priced(df).select("price"))
    assert "IsNotNull(price)" in plan and "GreaterThan(price,0.0)" in plan
    assert "ReadSchema: struct<price:double>" in plan


def test_sql_values_are_bound(spark):
    df = spark.createDataFrame([("x' OR '1'='1",), ("x",)], "name string")
    found = tables.run_sql(spark, "SELECT name FROM {t} WHERE name = :n", {"n": "x' OR '1'='1"}, t=df)
    assert [r[0] for r in found.collect()] == ["x' OR '1'='1"]


def test_jdbc_options_partition_the_read():
    found = tables.jdbc_options("jdbc:x:y", "t", "a.Driver", {"user": "u"}, "property_id", (0, 900), 16)
    assert found == {
        "url": "jdbc:x:y", "dbtable": "t", "fetchsize": "10000", "user": "u", "driver": "a.Driver",
        "partitionColumn": "property_id", "lowerBound": "0", "upperBound": "900", "numPartitions": "16",
    }
    with pytest.raises(ValueError, match="bounds"):
        tables.jdbc_options("jdbc:x:y", "t", partition_column="property_id")


def test_a_jdbc_read_in_one_task_is_asked_for(spark):
    with pytest.raises(ValueError, match="partition_column"):
        tables.read_jdbc(spark, url="jdbc:x:y", table="t")


def test_a_csv_extract_keeps_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "12 Main\nApt 4"), (2, 'a "b", c')], "id long, note string")
    found = tables.store_extract(df, str(tmp_path / "extract"), "csv")
    assert sorted(found.collect()) == sorted(df.collect())
