import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators import intervals, metrics

# A stored calibration and bounds worked out from it.
STORED = {
    "method": "segmented_relative_error_quantile",
    "alpha": 0.05,
    "coverage": 0.95,
    "num_segments": 5,
    "segment_edges": [376396.84762496233, 451704.94425660407, 563068.8811042374, 765686.6680534559],
    "relative_error_quantiles_by_segment": [
        0.24518378008285518, 0.3511801512715619, 0.2500635958018682, 0.312822831332614, 0.5556286263780003,
    ],
    "relative_error_quantiles": {"global": 0.42545754415059117},
    "calibration_size": 476,
}
BOUNDS = [
    (300000.0, 226444.86597514348, 373555.13402485655),
    (376396.84762496233, 244213.74573788902, 508579.9495120356),
    (400000.0, 259527.93949137526, 540472.0605086247),
    (765686.6680534559, 340249.23644696636, 1191124.0996599454),
    (1000000.0, 444371.37362199975, 1555628.6263780002),
    (-5.0, 0.0, 0.0),
]


def predictions(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "prediction double")


@pytest.fixture(scope="module")
def pairs(spark):
    rows = [(1000.0 * i, -50.0 if i == 10 else 1000.0 * i * (0.7 + (i % 7) / 10)) for i in range(1, 61)]
    return spark.createDataFrame(rows, "y double, p double").repartition(4)


def test_bounds_of_a_stored_calibration(spark):
    found = intervals.add_interval(predictions(spark, [b[0] for b in BOUNDS]), STORED)
    assert [tuple(r) for r in found.collect()] == BOUNDS


def test_calibration_vectors(spark, pairs):
    for gap_rows in (3, 250_000):
        found = intervals.calibrate_interval(pairs, "y", "p", gap_rows=gap_rows)
        assert found["relative_error_quantiles"]["global"] == 0.3000000000000001
        assert found["segment_edges"] == pytest.approx([12080.000000000002, 23680, 34680, 46320], rel=1e-15)
        assert found["relative_error_quantiles_by_segment"] == [
            1.0, 0.3000000000000001, 0.3000000000000001, 0.3, 0.2999999999999998,
        ]
        assert found["calibration_size"] == 60
    row = intervals.interval_frame(spark, found).first()
    assert row["relative_error_quantiles"]["global"] == 0.3000000000000001
    assert row["coverage"] == 0.95 and row["num_segments"] == 5


def test_small_and_empty_segments_use_the_overall_quantile(spark):
    few = spark.createDataFrame([(float(i), i * 1.1) for i in range(1, 10)], "y double, p double")
    found = intervals.calibrate_interval(few, "y", "p")
    assert set(found["relative_error_quantiles_by_segment"]) == {found["relative_error_quantiles"]["global"]}
    same = spark.createDataFrame([(float(i), 5.0) for i in range(1, 40)], "y double, p double")
    found = intervals.calibrate_interval(same, "y", "p")
    assert found["segment_edges"] == [5.0] * 4
    assert len(found["relative_error_quantiles_by_segment"]) == 5
    with pytest.raises(ValueError, match="calibrate"):
        intervals.calibrate_interval(same.limit(0), "y", "p")


def test_three_band_form_and_its_defaults(spark):
    legacy = {
        "method": intervals.METHOD, "segment_edges": [100.0, 200.0],
        "relative_error_quantiles": {"low": 0.5, "high": 0.25},
    }
    found = intervals.add_interval(predictions(spark, [50, 100, 200]), legacy).collect()
    assert [(r["lower_bound"], r["upper_bound"]) for r in found] == [(25.0, 75.0), (100.0, 100.0), (150.0, 250.0)]
    short = {**legacy, "relative_error_quantiles_by_segment": [0.1, 0.2]}
    assert intervals.add_interval(predictions(spark, [50]), short).first()["lower_bound"] == 25.0
    both = {**legacy, "relative_error_quantiles_by_segment": [0.1, 0.2, 0.3]}
    assert intervals.add_interval(predictions(spark, [50]), both).first()["lower_bound"] == 45.0


@pytest.mark.parametrize("interval", [None, {}, {"method": "other"}, {"method": intervals.METHOD, "segment_edges": [1.0]}])
def test_without_a_calibration_the_bounds_equal_the_prediction(spark, interval):
    assert tuple(intervals.add_interval(predictions(spark, [-5.0]), interval).first()) == (-5.0, -5.0, -5.0)


def test_margin_guards_a_zero_prediction(spark):
    df = spark.createDataFrame([(100.0, 80.0, 130.0), (0.0, 0.0, 0.0)], "prediction double, lower_bound double, upper_bound double")
    found = intervals.interval_margin(df).collect()
    assert (found[0]["margin"], found[0]["margin_pct"], found[0]["confidence_level"]) == (25.0, 25.0, 95.0)
    assert found[1]["margin_pct"] is None


def test_metric_vectors(pairs):
    found = metrics.evaluation_metrics(pairs, "y", "p").first()
    assert found["r2"] == pytest.approx(0.8405800222283968, rel=1e-12)
    assert found["rmse"] == pytest.approx(6914.673407568381, rel=1e-12)
    assert found["mae"] == pytest.approx(5234.166666666667, rel=1e-12)
    assert found["mse"] == pytest.approx(47812708.33333332, rel=1e-12)
    assert (found["cheap_segment_cutoff_p25"], found["cheap_segment_mae"]) == (15750.0, pytest.approx(2190.0))


def test_metric_names_and_perfect_fit(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 3.0)], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first().asDict() == {"r2": 1.0, "rmse": 0.0, "mae": 0.0, "mse": 0.0}


@pytest.mark.parametrize("predicted, r2", [((4.0, 4.0), 1.0), ((4.0, 5.0), 0.0)])
def test_r2_of_constant_actuals(spark, predicted, r2):
    df = spark.createDataFrame([(4.0, p) for p in predicted], "y double, p double")
    assert metrics.regression_metrics(df, "y", "p").first()["r2"] == r2


def test_r2_is_not_squared_correlation(spark):
    y = np.arange(20.0)
    df = spark.createDataFrame([(float(a), float(2 * a + 1)) for a in y], "y double, p double")
    expected = 1 - ((y + 1) ** 2).sum() / ((y - y.mean()) ** 2).sum()
    assert metrics.regression_metrics(df, "y", "p").first()["r2"] == pytest.approx(expected)


def test_metrics_and_interval_of_one_search_equal_those_apart(spark):
    df = spark.range(1, 200).select(
        F.when(F.col("id") % 17 != 0, F.col("id") * 1000.0).alias("y"), (F.col("id") * (700.0 + F.col("id") % 7 * 100)).alias("p")
    )
    together, interval = intervals.evaluate_and_calibrate(df, "y", "p")
    apart = metrics.evaluation_metrics(df, "y", "p").first().asDict()
    assert {k: pytest.approx(v, rel=1e-12) for k, v in apart.items()} == together
    assert interval == intervals.calibrate_interval(df, "y", "p")
