import math

import pytest
from pyspark.sql import functions as F

from plan_text import plan_of
from parcelry.operators import joins, location, splitting


def test_each_coordinate_is_filled_on_its_own(spark):
    rows = [
        (1, "Summerlin", None, None), (2, "Anthem", None, -1.0), (3, "Nowhere", None, None),
        (4, None, None, 5.0), (5, "Summerlin", 1.0, 2.0), (6, "Anthem", float("nan"), 3.0),
    ]
    df = spark.createDataFrame(rows, "id long, vegas_district string, latitude double, longitude double")
    found = location.backfill_location(df, location.district_centroids(spark))
    assert found.columns == df.columns
    assert {r["id"]: (r["latitude"], r["longitude"]) for r in found.collect()} == {
        1: (36.1699, -115.3378), 2: (35.9853, -1.0), 3: (None, None), 4: (None, 5.0), 5: (1.0, 2.0), 6: (35.9853, 3.0),
    }
    placed, lacking = location.split_missing_location(found)
    assert sorted(r["id"] for r in lacking.collect()) == [3, 4]
    assert placed.count() == 4


def test_backfill_adds_absent_columns_and_needs_a_district(spark):
    df = spark.createDataFrame([("Paradise",)], "vegas_district string")
    assert tuple(location.backfill_location(df, location.district_centroids(spark)).first()) == ("Paradise", 36.0972, -115.1467)
    assert location.backfill_location(spark.range(1), location.district_centroids(spark)).columns == ["id"]


def test_repeated_lookup_keys_are_refused(spark):
    twice = location.district_centroids(spark).unionAll(location.district_centroids(spark))
    df = spark.createDataFrame([("Paradise",)], "vegas_district string")
    with pytest.raises(Exception, match="more than once"):
        location.backfill_location(df, twice).collect()
    with pytest.raises(Exception, match="more than once"):
        joins.lookup_join(df, twice, "vegas_district").select("vegas_district").count()


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_large_lookup_with_a_hot_key_keeps_every_row(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id"))
        df = spark.range(6000).select("id", hot.cast("long").alias("k"))
        lookup = spark.range(0, 9000, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v")).unionAll(
            spark.createDataFrame([(7, 70)], "k long, v long")
        )
        plain = df.join(lookup, "k", "left").select("k", "id", "v")
        found = joins.lookup_join(df, lookup, "k")
        assert found.count() == 6000
        assert found.exceptAll(plain).isEmpty() and plain.exceptAll(found).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_lookup_join_reads_each_side_once(spark, tmp_path):
    spark.range(100).select((F.col("id") % 9).alias("k"), "id").write.parquet(f"{tmp_path}/left")
    spark.range(9).select(F.col("id").alias("k"), F.lit(1).alias("v")).write.parquet(f"{tmp_path}/right")
    left, right = spark.read.parquet(f"{tmp_path}/left"), spark.read.parquet(f"{tmp_path}/right")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookup", "lookup")
    found = joins.lookup_join(left, right, "k")
    assert not tracker.getJobIdsForGroup("lookup")
    assert plan_of(found).count("FileScan parquet") == 2


@pytest.mark.parametrize("split", [splitting.hash_split, splitting.exact_split])
def test_splits_cover_every_row_once_whatever_the_partitioning(spark, split):
    df = spark.range(2003)
    train, test = split(df, "id")
    assert train.union(test).distinct().count() == train.count() + test.count() == 2003
    again = split(df.repartition(7).orderBy(F.desc("id")), "id")[1]
    assert {r[0] for r in again.collect()} == {r[0] for r in test.collect()}
    other = split(df, "id", seed=1)[1]
    assert {r[0] for r in other.collect()} != {r[0] for r in test.collect()}


@pytest.mark.parametrize("n, share", [(45, 0.2), (1, 0.2), (1000, 0.25), (999, 1 / 3)])
def test_exact_split_size(spark, n, share):
    train, test = splitting.exact_split(spark.range(n), "id", share)
    assert test.count() == math.ceil(n * share)
    assert train.count() == n - math.ceil(n * share)


def test_rows_that_share_a_key_share_a_side(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("id"))
    train, test = splitting.exact_split(df, "id", 0.5)
    assert not {r[0] for r in train.distinct().collect()} & {r[0] for r in test.distinct().collect()}
    assert train.count() + test.count() == 300


def test_small_shares_and_missing_keys(spark):
    df = spark.range(20_000)
    assert 1 <= splitting.hash_split(df, "id", test_size=0.0004)[1].count() <= 25
    keyed = spark.range(10).select("id").unionAll(spark.range(10).select(F.lit(None).cast("long")))
    with pytest.raises(ValueError, match="10 rows have none"):
        splitting.exact_split(keyed, "id")
