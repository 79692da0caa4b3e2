import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators.order_stats import Wanted, linear_grid, order_statistics, quantiles

rng = np.random.default_rng(7)
SHAPES = {
    "smooth": rng.normal(size=4000),
    "heavy tail": np.exp(rng.normal(scale=4, size=4000)),
    "few values": rng.integers(0, 3, size=4000).astype(float),
    "hot value": np.where(rng.random(4000) < 0.4, 5.0, rng.normal(5, 1, 4000)),
    "constant": np.full(500, 2.5),
    "single": np.array([3.25]),
    "twenty": np.arange(1.0, 21.0),
}


def frame(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "x double").repartition(5)


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("gap_rows", [1, 60, 250_000])
def test_matches_numpy_whatever_the_path(spark, shape, gap_rows):
    values = SHAPES[shape]
    steps = linear_grid(10)
    found = order_statistics(
        frame(spark, values),
        {
            "linear": Wanted(F.col("x"), steps),
            "higher": Wanted(F.col("x"), (0.05, 0.5, 0.95), "higher"),
            "count": Wanted(F.col("x"), (0.2,), "count"),
        },
        gap_rows=gap_rows,
    )
    assert found.values["linear"] == list(np.quantile(values, steps))
    assert found.values["higher"] == list(np.quantile(values, (0.05, 0.5, 0.95), method="higher"))
    assert found.values["count"] == [np.sort(values)[int(np.ceil(len(values) * 0.2)) - 1]]


def test_higher_of_twenty_is_the_last(spark):
    df = frame(spark, SHAPES["twenty"])
    assert order_statistics(df, {"x": Wanted(F.col("x"), (0.95,), "higher")}).values["x"] == [20.0]


def test_median_of_an_even_count(spark):
    assert quantiles(frame(spark, [1, 2, 3, 10]), F.col("x"), 2)[1] == 2.5


def test_missing_values_are_skipped_and_extras_share_the_pass(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "x double")
    found = order_statistics(
        df,
        {"x": Wanted(F.col("x"), (0.5,)), "none": Wanted(F.lit(None).cast("double"), (0.5,))},
        {"rows": F.count(F.lit(1))},
    )
    assert found.values == {"x": [2.0], "none": None}
    assert found.counts == {"x": 2, "none": 0}
    assert found.also == {"rows": 4}


def test_infinite_values_are_refused(spark):
    with pytest.raises(ValueError, match="infinite"):
        quantiles(frame(spark, [1.0, float("inf")]), F.col("x"), 2)


def test_neighbouring_doubles_are_told_apart(spark):
    values = [np.nextafter(1.0, 2.0) if i % 2 else 1.0 for i in range(600)] + [np.nextafter(1.0, 0.0)] * 100
    found = order_statistics(frame(spark, values), {"x": Wanted(F.col("x"), linear_grid(20), "higher")}, gap_rows=1)
    assert found.values["x"] == list(np.quantile(values, linear_grid(20), method="higher"))


def test_many_quantiles_of_several_columns_leave_many_gaps(spark):
    """More open gaps than a nested expression can hold: 6 columns of 254 inner quantiles."""
    values = np.random.default_rng(3).normal(size=(8000, 6))
    df = spark.createDataFrame([tuple(map(float, v)) for v in values], ", ".join(f"x{i} double" for i in range(6))).repartition(4)
    parts = tuple(i / 255 for i in range(1, 255))
    found = order_statistics(df, {f"x{i}": Wanted(F.col(f"x{i}"), parts) for i in range(6)}, gap_rows=100)
    for i in range(6):
        assert found.values[f"x{i}"] == list(np.quantile(values[:, i], parts))
