import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from parcelry.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(8, "parcelry-tests", partitions=4)
    session.sparkContext.setLogLevel("ERROR")
    if not session.sparkContext.getCheckpointDir():
        session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_housing(spark):
    rows = [
        (2.0, 1.5, 950.0, 36.1021, -115.2450, 1800.0, "CONDO", "Spring Valley", 225000.0),
        (3.0, 2.0, 1400.0, 36.1699, -115.3378, 2500.0, "SINGLE_FAMILY", "Summerlin", 420000.0),
        (3.0, 2.5, 1650.0, 36.1147, -115.1728, 2200.0, "TOWNHOUSE", "The Strip", 355000.0),
        (4.0, 3.0, 2200.0, 36.2839, -115.2710, 4200.0, "SINGLE_FAMILY", "Centennial", 610000.0),
        (5.0, 4.0, 3100.0, 36.1699, -115.3378, 6100.0, "SINGLE_FAMILY", "Summerlin", 980000.0),
        (3.0, 2.0, 1500.0, 36.1420, -115.0987, 2600.0, "CONDO", "Winchester", 295000.0),
    ]
    return spark.createDataFrame(
        rows,
        "bedrooms double, bathrooms double, living_area double, latitude double, longitude double, "
        "normalized_lot_area_value double, property_type string, vegas_district string, price double",
    )


@pytest.fixture(scope="session")
def raw_training(spark):
    """48 warehouse-style rows by formula."""
    i = F.col("id")
    area, rooms, lot = 1100 + i * 35, 2 + i % 4, 2200 + i * 60

    def by_district(*values):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (i % 4 + 1).cast("int"))

    kind = F.element_at(F.array(*[F.lit(v) for v in ("SINGLE_FAMILY", "TOWNHOUSE", "CONDO")]), (i % 3 + 1).cast("int"))
    price = (area * 235 + rooms * 12000 + lot * 4).cast("double")
    nothing = F.lit(None).cast("double")
    return spark.range(48).select(
        (10000 + i).alias("property_id"),
        F.lit("2026-04-01").cast("date").alias("snapshot_date"),
        F.concat(i.cast("string"), F.lit(" Test Ave")).alias("street_address"),
        F.lit("Las Vegas").alias("city"),
        F.lit("NV").alias("state"),
        F.lit("89101").alias("zip_code"),
        by_district("Summerlin", "Centennial", "Spring Valley", "Paradise").alias("vegas_district"),
        by_district(36.1699, 36.2839, 36.1021, 36.0972).alias("latitude"),
        by_district(-115.3378, -115.2710, -115.2450, -115.1467).alias("longitude"),
        F.when(i % 17 == 0, "MOBILE").otherwise(kind).alias("property_type"),
        price.alias("price"),
        nothing.alias("zestimate"),
        nothing.alias("rentzestimate"),
        rooms.cast("int").alias("bedrooms"),
        (1.5 + (i % 4) * 0.5).alias("bathrooms"),
        area.cast("double").alias("living_area"),
        lot.cast("double").alias("normalized_lot_area_value"),
        F.lit("sqft").alias("normalized_lot_area_unit"),
        (5 + i % 30).cast("double").alias("days_on_zillow"),
        F.lit("FOR_SALE").alias("listing_status"),
        (price / area).alias("price_per_sqft"),
    )
