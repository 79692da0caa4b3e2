import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from parcelry.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from parcelry.operators import features


def test_fit_gives_the_expected_width_and_names(sample_housing):
    fitted = features.Preprocessor().fit(sample_housing)
    assert fitted.input_columns == NUMERIC_FEATURES + CATEGORICAL_FEATURES
    assert len(fitted.feature_names) == 14
    assert fitted.feature_names[:8] == NUMERIC_FEATURES + ["property_type_CONDO", "property_type_SINGLE_FAMILY"]
    assert fitted.feature_names[-1] == "vegas_district_Winchester"
    made = fitted.transform(sample_housing.withColumn("unexpected", F.lit(123)))
    assert made.columns == fitted.feature_names and made.count() == 6


def test_missing_column_and_use_before_fit_are_errors(sample_housing):
    with pytest.raises(ValueError, match="vegas_district"):
        features.Preprocessor().fit(sample_housing.drop("vegas_district"))
    with pytest.raises(RuntimeError, match="fitted"):
        features.Preprocessor().transform(sample_housing)
    with pytest.raises(RuntimeError, match="fitted"):
        features.Preprocessor().get_feature_names()
    fitted = features.Preprocessor()
    fitted.fit(sample_housing)
    with pytest.raises(ValueError, match="bedrooms"):
        fitted.transform(sample_housing.drop("bedrooms"))


def test_scaling_uses_the_filled_column_and_the_population_deviation(spark):
    values = [1.0, 2.0, 3.0, 10.0, None, float("nan")]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    fit = features.fit_numeric(df, ["x"])[0]
    filled = np.array([1.0, 2.0, 3.0, 10.0, 2.5, 2.5])
    assert fit.median == 2.5
    assert fit.mean == pytest.approx(filled.mean(), rel=1e-14)
    assert fit.scale == pytest.approx(filled.std(), rel=1e-14)
    scaled = [r[0] for r in features.scale_numeric(df, [fit]).collect()]
    assert scaled == pytest.approx(list((filled - filled.mean()) / filled.std()))


def test_constant_column_scales_by_one_and_empty_column_is_named(spark):
    df = spark.createDataFrame([(4.0, None), (4.0, None)], "x double, y double")
    assert features.fit_numeric(df, ["x"])[0].scale == 1.0
    with pytest.raises(ValueError, match="'y'"):
        features.fit_numeric(df, ["x", "y"])
    with pytest.raises(ValueError, match="'z'"):
        features.fit_categorical(df.withColumn("z", F.lit(None).cast("string")), ["z"])


def test_most_frequent_category_takes_the_smallest_of_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "k string")
    fit = features.fit_categorical(df, ["k"])[0]
    assert (fit.fill, fit.categories) == ("a", ("a", "b", "c"))


def test_one_hot_gives_zeros_for_unseen_and_missing(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    found = df.select(*features.one_hot(F.col("k"), ["a", "b", "c"])).collect()
    assert [tuple(r) for r in found] == [(1.0, 0.0, 0.0), (0.0, 0.0, 0.0), (0.0, 0.0, 0.0)]


def test_projection_and_ml_stages_agree_even_for_awkward_names(spark):
    rows = [(1.0, "it's \\ odd"), (None, "plain"), (3.0, None), (7.0, "plain")]
    df = spark.createDataFrame(rows, "`a.b c` double, kind string")
    fitted = features.Preprocessor(["a.b c"], ["kind"]).fit(df)
    assert features.FittedPreprocessor.from_json(fitted.to_json()) == fitted
    plain = [tuple(r) for r in fitted.transform(df).collect()]
    staged = PipelineModel(fitted.stages(spark)).transform(df).select(features.ASSEMBLED).collect()
    assert [tuple(r[0].toArray()) for r in staged] == plain
    assert plain[2][1:] == (0.0, 1.0)


@pytest.mark.parametrize("value, rows, gaps", [(36.1699, 100, 37), (0.1, 3, 4)])
def test_constant_column_with_gaps_scales_by_one(spark, value, rows, gaps):
    df = spark.createDataFrame([(value,)] * rows + [(None,)] * gaps, "x double")
    assert features.fit_numeric(df, ["x"])[0] == features.NumericFit("x", value, value, 1.0)


def test_many_categories_become_sparse_places(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 10_000).cast("string").alias("k"))
    fitted = features.Preprocessor([], ["k"]).fit(df)
    rows = df.unionAll(spark.createDataFrame([(-1, "unseen"), (-2, None)], "id long, k string"))
    made = PipelineModel(fitted.stages(spark)).transform(rows).select("id", "k", features.ASSEMBLED)
    found = {r["id"]: (r["k"], r[2].indices.tolist(), r[2].size) for r in made.where("id < 50").collect()}
    order = fitted.categorical[0].categories
    assert found[-1][1:] == ([], 10_000) and order[found[-2][1][0]] == fitted.categorical[0].fill
    assert all(order[found[i][1][0]] == str(i) for i in range(50))


def test_index_is_the_place_among_sorted_values(spark):
    values = ["b", "a", "abc", "abcd", "abd", "", "é", "a", None, "ab"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, k string")
    index = features.category_index(df, ["k"])
    order = sorted(set(v for v in values if v is not None))
    assert {r["value"]: r["index"] for r in index.collect()} == {v: i for i, v in enumerate(order)}
    found = {r["id"]: r["index"] for r in features.encode_index(df, "k", index).collect()}
    assert found == {i: None if v is None else order.index(v) for i, v in enumerate(values)}


def test_numbering_is_spread_over_partitions_whatever_the_values_share(spark):
    values = [f"Customer#{i:06d}" for i in range(5000)]
    rows = spark.createDataFrame([(v, v[-1] if i % 7 else None) for i, v in enumerate(values)] * 2, "a string, b string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = features.placed_values(rows, ["a", "b"]).groupBy("part").count().collect()
        found = features.category_index(rows, ["a", "b"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) > 2 and max(r["count"] for r in sizes) < 2500
    by = {}
    for r in found.collect():
        by.setdefault(r["feature"], []).append((r["index"], r["value"]))
    assert sorted(by["a"]) == list(enumerate(values))
    assert sorted(by["b"]) == list(enumerate("0123456789"))
    assert features.category_index(rows.limit(0), ["a"]).isEmpty()
