"""Property-shaped views of the order tables that the checks and the benchmark run on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.contract import TrainingOptions

# Bounds that suit these tables; all else keeps the shipped settings.
OPTIONS = TrainingOptions(
    min_price=100_000.0, min_living_area=20.0, exclude_property_types=("4-NOT SPECIFIED",)
)
UNPLACED_NATION = 7


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def priced_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The listing columns that orders alone provide."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("property_id"),
        F.to_date("o_orderdate").alias("snapshot_date"),
        F.col("o_totalprice").alias("price"),
        F.when(key % 17 != 0, F.col("o_orderpriority")).alias("property_type"),
        F.col("o_orderstatus").alias("listing_status"),
    )


def nation_centroids(spark: SparkSession, folder: str) -> DataFrame:
    """A position per nation, one of them under a name that no listing has."""
    key = F.col("n_nationkey")
    name = F.when(key == UNPLACED_NATION, F.concat(F.lit("Old "), "n_name")).otherwise(F.col("n_name"))
    return table(spark, folder, "nation").select(
        name.alias("vegas_district"),
        (F.lit(35.5) + key * F.lit(0.25)).alias("latitude"),
        (F.lit(-115.5) + key * F.lit(0.25)).alias("longitude"),
    )


def listings(spark: SparkSession, folder: str) -> DataFrame:
    """One listing per order: customer and nation give the place, its lines the features.

    Lines collapse to one row per order, and places to one row per customer, before orders
    meet them. Spark broadcasts what its own size estimate allows and splits hot customers at
    run time.
    """
    key = F.col("o_orderkey")
    lines = table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.count(F.lit(1)).cast("double").alias("bedrooms"),
        (F.max("l_quantity") / 10).alias("bathrooms"),
        F.sum("l_quantity").alias("living_area"),
        F.max("l_extendedprice").alias("normalized_lot_area_value"),
    )
    shift = (key % 100) / F.lit(1000.0)
    placed = key % 5 != 0
    nation = F.col("n_nationkey")
    places = table(spark, folder, "customer").join(
        table(spark, folder, "nation"), F.col("c_nationkey") == nation
    )
    return (
        table(spark, folder, "orders")
        .join(lines, key == F.col("l_orderkey"), "left")
        .join(places, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            key.alias("property_id"),
            F.to_date("o_orderdate").alias("snapshot_date"),
            F.col("c_mktsegment").alias("city"),
            F.col("n_name").alias("vegas_district"),
            F.when(placed, F.lit(35.5) + nation * F.lit(0.25) + shift).alias("latitude"),
            F.when(placed, F.lit(-115.5) + nation * F.lit(0.25) + shift).alias("longitude"),
            F.when(key % 17 != 0, F.col("o_orderpriority")).alias("property_type"),
            F.col("o_totalprice").alias("price"),
            "bedrooms",
            "bathrooms",
            "living_area",
            "normalized_lot_area_value",
            F.col("o_orderstatus").alias("listing_status"),
        )
    )


def fixed_predictions(spark: SparkSession, folder: str) -> DataFrame:
    """Actual and predicted prices by a row-wise rule whose error grows with the price."""
    key, y = F.col("o_orderkey"), F.col("o_totalprice")
    off = ((key % 613) - 306) / F.lit(1000.0) * (F.lit(0.25) + y / F.lit(400000.0))
    p = F.when(key % 97 == 0, F.lit(-1000.0)).otherwise(y * (F.lit(1.0) + off))
    return table(spark, folder, "orders").select(
        key.alias("property_id"), y.alias("actual"), p.alias("prediction")
    )


def model_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every order is a version of its customer's model."""
    stage = (
        F.when(F.col("o_orderstatus") == "F", "Production").when(F.col("o_orderstatus") == "O", "Staging").otherwise("Archived")
    )
    return table(spark, folder, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("model_name"),
        F.col("o_orderkey").alias("version"),
        F.concat(F.lit("run_"), F.col("o_orderkey").cast("string")).alias("run_id"),
        stage.alias("stage"),
    )


def model_runs(spark: SparkSession, folder: str) -> DataFrame:
    """A test_r2 for most version runs and for every candidate run, missing for some, and an rmse besides."""
    key = F.col("o_orderkey")
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("run_"), key.cast("string")).alias("run_id"),
        F.when(key % 11 == 0, F.lit("test_rmse")).otherwise(F.lit("test_r2")).alias("metric_name"),
        ((key % 64) / F.lit(64.0)).alias("metric_value"),
    )
    customer = F.col("c_custkey")
    candidates = table(spark, folder, "customer").select(
        F.concat(F.lit("candidate_"), customer.cast("string")).alias("run_id"),
        F.lit("test_r2").alias("metric_name"),
        F.when(customer % 13 != 0, (customer % 32) / F.lit(32.0)).alias("metric_value"),
    )
    return orders.unionByName(candidates)


def candidate_runs(spark: SparkSession, folder: str) -> DataFrame:
    """One candidate per customer's model."""
    customer = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        F.concat(F.lit("model_"), customer).alias("model_name"),
        F.concat(F.lit("candidate_"), customer).alias("run_id"),
    )


def second_candidates(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A further candidate per customer's model, offered after the first, and the metrics of their runs."""
    customer = F.col("c_custkey")
    rows = table(spark, folder, "customer").select(
        F.concat(F.lit("model_"), customer.cast("string")).alias("model_name"),
        F.concat(F.lit("second_"), customer.cast("string")).alias("run_id"),
        F.when(customer % 17 != 0, (customer * 7 % 32) / F.lit(32.0)).alias("metric_value"),
    )
    runs = rows.select("run_id", F.lit("test_r2").alias("metric_name"), "metric_value")
    return rows.select("model_name", "run_id"), runs


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Listings under the older request field names, some of them faulty."""
    key = F.col("property_id")
    faulty = F.when(key % 23 == 0, F.lit(-1.0)).when(key % 29 == 0, F.lit(2.5)).otherwise(F.col("bedrooms"))
    return listings(spark, folder).select(
        "property_id",
        faulty.alias("bedrooms"),
        "bathrooms",
        F.when(key % 31 != 0, F.col("living_area")).alias("livingarea"),
        F.when(key % 3 == 0, F.lit(5.0)).alias("living_area"),
        "latitude",
        "longitude",
        F.when(key % 7 != 0, F.col("normalized_lot_area_value")).alias("normalized_lot_area_value"),
        F.when(key % 37 == 0, F.lit("")).otherwise(F.col("property_type")).alias("propertytype"),
        "vegas_district",
    )
