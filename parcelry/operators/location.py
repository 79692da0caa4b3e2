"""Coordinates for rows that name a district but lack a position."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.contract import DISTRICT_CENTROIDS
from parcelry.operators.joins import lookup_join


def district_centroids(spark: SparkSession) -> DataFrame:
    rows = [(name, lat, lon) for name, (lat, lon) in DISTRICT_CENTROIDS.items()]
    return spark.createDataFrame(rows, "vegas_district string, latitude double, longitude double")


def backfill_location(df: DataFrame, centroids: DataFrame) -> DataFrame:
    """Fill a missing latitude or longitude, each on its own, from the district centroid.

    A row whose district is missing or unknown stays as it is. Without a district column
    the table is returned unchanged.
    """
    if "vegas_district" not in df.columns:
        return df
    absent = {c: F.lit(None).cast("double") for c in ("latitude", "longitude") if c not in df.columns}
    df = df.withColumns(absent) if absent else df
    columns = df.columns
    side = centroids.select(
        "vegas_district", F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon")
    )
    joined = lookup_join(df, side, "vegas_district")
    filled = {}
    for name, default in (("latitude", "__lat"), ("longitude", "__lon")):
        x = F.col(name).cast("double")
        filled[name] = F.when(F.isnan(x) | x.isNull(), F.col(default)).otherwise(x)
    return joined.withColumns(filled).select(*columns)


def split_missing_location(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a full position, and rows still lacking a coordinate."""
    lat, lon = F.col("latitude").cast("double"), F.col("longitude").cast("double")
    lacking = lat.isNull() | lon.isNull() | F.isnan(lat) | F.isnan(lon)
    return df.filter(~lacking), df.filter(lacking)
