import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation
from pyspark.sql import functions as F

from parcelry.contract import MODEL_FEATURES, NUMERIC_FEATURES, TrainingOptions
from parcelry.operators import cleaning

OPTIONS = TrainingOptions()


def test_clean_applies_the_rules_and_casts(raw_training):
    twice = raw_training.unionAll(raw_training.filter("property_id = 10000"))
    assert twice.count() == 49
    assert cleaning.drop_duplicate_rows(twice).count() == 48
    cleaned = cleaning.clean(twice, OPTIONS)
    assert cleaned.count() == 45
    assert "property_id" not in cleaned.columns and "price_per_sqft" not in cleaned.columns
    assert cleaned.filter("property_type = 'MOBILE'").isEmpty()
    assert {cleaned.schema[c].dataType.simpleString() for c in NUMERIC_FEATURES} == {"double"}
    assert cleaning.remove_outliers(cleaned, OPTIONS).count() == 45


def test_identity_columns_take_part_in_deduplication(raw_training):
    """Equal rows under different ids are different rows."""
    other = raw_training.withColumn("property_id", F.col("property_id") + 1000)
    assert cleaning.clean(raw_training.unionAll(other), OPTIONS).count() == 90


def test_training_columns_in_contract_order(raw_training):
    cleaned = cleaning.clean(raw_training, OPTIONS)
    assert cleaning.select_training_columns(cleaned).columns == MODEL_FEATURES + ["price"]
    with pytest.raises(ValueError, match="Missing training columns.*living_area"):
        cleaning.select_training_columns(cleaned.drop("living_area"))


def test_missing_type_survives_exclusion(spark):
    df = spark.createDataFrame([("MOBILE",), ("CONDO",), (None,)], "property_type string")
    assert {r[0] for r in cleaning.exclude_types(df, ["MOBILE"]).collect()} == {"CONDO", None}
    assert cleaning.exclude_types(df, []).count() == 3
    assert cleaning.exclude_types(spark.range(2), ["MOBILE"]).count() == 2


def test_outlier_bounds_are_inclusive_and_missing_values_fall_out(spark):
    nan = float("nan")
    rows = [
        (100000.0, 500.0), (5000000.0, 500.0), (99999.99, 900.0), (5000000.01, 900.0), (200000.0, 499.9),
        (None, 900.0), (nan, 900.0), (200000.0, nan), (200000.0, None),
    ]
    df = spark.createDataFrame(rows, "price double, living_area double")
    assert sorted(r[0] for r in cleaning.remove_outliers(df, OPTIONS).collect()) == [100000.0, 5000000.0]
    assert cleaning.remove_outliers(df, TrainingOptions(handle_outliers=False)).count() == 9
    assert cleaning.remove_outliers(df.drop("living_area"), OPTIONS).count() == 9
    with pytest.raises(ValueError, match="price"):
        cleaning.remove_outliers(df.drop("price"), OPTIONS)
    seen = Observation("bounds")
    cleaning.remove_outliers(df, OPTIONS, seen).collect()
    assert seen.get == {"rows_in": 9, "rows_kept": 2}


def test_bad_text_fails_the_cast(spark):
    df = spark.createDataFrame([("abc",)], "bedrooms string")
    for c in NUMERIC_FEATURES[1:]:
        df = df.withColumn(c, F.lit("1.5"))
    with pytest.raises(PySparkException):
        cleaning.cast_numeric(df).collect()
    with pytest.raises(ValueError, match="bathrooms"):
        cleaning.cast_numeric(df.drop("bathrooms"))


def test_latest_per_key_breaks_ties(spark):
    day = datetime.date
    rows = [(1, day(2026, 1, 1), 10, 5.0), (1, day(2026, 2, 1), 11, 6.0), (1, day(2026, 2, 1), 12, 7.0), (2, None, 1, 8.0)]
    df = spark.createDataFrame(rows, "property_id long, snapshot_date date, seq long, price double")
    assert sorted(r["price"] for r in cleaning.latest_per_key(df, tiebreak=["seq"]).collect()) == [7.0, 8.0]


def test_older_field_name_wins(spark):
    df = spark.createDataFrame([(1.0, 2.0, "A"), (None, 3.0, "B")], "livingarea double, living_area double, propertytype string")
    found = cleaning.rename_aliases(df)
    assert [tuple(r) for r in found.select("living_area", "property_type").collect()] == [(1.0, "A"), (3.0, "B")]
    assert set(found.columns) == {"living_area", "property_type"}


def test_optional_default_when_absent_or_missing(spark):
    column = "normalized_lot_area_value"
    assert cleaning.fill_optional(spark.range(1)).first()[column] == 5000.0
    df = spark.createDataFrame([(None,), (float("nan"),), (12.0,)], f"{column} double")
    assert [r[0] for r in cleaning.fill_optional(df).collect()] == [5000.0, 5000.0, 12.0]


REQUEST = "bedrooms double, bathrooms double, livingarea double, latitude double, longitude double, propertytype string"


@pytest.mark.parametrize(
    "row, expected",
    [
        ((3.0, 2.0, 1600.0, 36.12, -115.17, "SINGLE_FAMILY"), []),
        ((3.0, 2.0, 1600.0, None, None, "SINGLE_FAMILY"), []),
        ((-1.0, 2.0, 1600.0, 36.12, -115.17, "CONDO"), ["bedrooms: must be >= 0"]),
        ((2.5, 21.0, 0.0, 91.0, -181.0, ""), [
            "bedrooms: must be a whole number", "bathrooms: must be <= 20", "livingarea: must be > 0",
            "latitude: must be <= 90", "longitude: must be >= -180", "propertytype: required",
        ]),
        ((None, float("nan"), 1.0, 0.0, 0.0, None), ["bedrooms: required", "bathrooms: required", "propertytype: required"]),
    ],
)
def test_request_rules(spark, row, expected):
    df = spark.createDataFrame([row], REQUEST)
    assert cleaning.with_errors(df).first()["errors"] == expected
    valid, rejected = cleaning.split_valid(df)
    assert (valid.count(), rejected.count()) == ((0, 1) if expected else (1, 0))


def test_absent_required_field_rejects_every_row(spark):
    df = spark.createDataFrame([(3.0, 2.0)], "bedrooms double, bathrooms double")
    assert cleaning.with_errors(df).first()["errors"] == ["livingarea: required", "propertytype: required"]


def test_form_rules_bound_only_required_fields(spark):
    df = spark.createDataFrame([(30.0, 35.0, 50.0)], "bedrooms double, latitude double, living_area double")
    found = cleaning.with_errors(df, cleaning.form_rules(["latitude", "living_area"])).first()["errors"]
    assert found == ["latitude: must be >= 35.5"]


def test_unseen_categories_counts_values_outside_the_options(spark):
    df = spark.createDataFrame(
        [("CONDO", "Henderson"), ("MULTI_FAMILY", "Anthem"), ("MULTI_FAMILY", None)],
        "property_type string, vegas_district string",
    )
    found = {tuple(r) for r in cleaning.unseen_categories(df).collect()}
    assert found == {("property_type", "MULTI_FAMILY", 2), ("vegas_district", "Henderson", 1)}


def test_text_fields_are_validated_as_numbers(spark):
    rows = [("abc", "99", "-5"), ("3", "2.5", "1600"), ("", None, "NaN"), ("2.5", " 2 ", "10")]
    df = spark.createDataFrame(rows, "bedrooms string, bathrooms string, livingarea string").withColumn("propertytype", F.lit("CONDO"))
    found = [r["errors"] for r in cleaning.with_errors(df).collect()]
    assert found == [
        ["bedrooms: must be a number", "bathrooms: must be <= 20", "livingarea: must be > 0"],
        [],
        ["bedrooms: required", "bathrooms: required", "livingarea: must be a number"],
        ["bedrooms: must be a whole number"],
    ]


def test_nan_is_missing_and_nothing_else(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, 100.0, "CONDO")], "bedrooms double, bathrooms double, livingarea double, propertytype string")
    assert cleaning.with_errors(df).first()["errors"] == ["bedrooms: required"]


def test_equal_dates_give_the_same_row_whatever_the_partitioning(spark):
    rows = [(1, "2026-01-01", v) for v in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "property_id long, snapshot_date string, note string")
    assert len({cleaning.latest_per_key(df.repartition(n)).first()["note"] for n in (1, 2, 3, 5)}) == 1
