import math

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from parcelry.operators.grouped_stats import grouped_order_statistics
from parcelry.operators.order_stats import Wanted

QUANTILES = (0.0, 0.05, 0.5, 0.9, 1.0)


def groups():
    rng = np.random.default_rng(11)
    made = {("a", i): rng.normal(size=i + 1) for i in range(30)}
    made["hot", 0] = np.where(rng.random(3000) < 0.4, 5.0, rng.normal(5, 1, 3000))
    made["hot", 1] = rng.integers(0, 3, 900).astype(float)
    made["constant", 0] = np.full(700, 2.5)
    made[None, 7] = np.exp(rng.normal(scale=4, size=800))
    return made


def frame(spark, made):
    rows = [(a, b, float(v)) for (a, b), values in made.items() for v in values]
    rows += [("none", 0, None), ("none", 0, math.nan), ("a", 3, None), ("hot", 0, math.nan)]
    return spark.createDataFrame(rows, "`k 1` string, g int, x double").repartition(6)


@pytest.mark.parametrize(
    "rule, method, gap_rows",
    [("linear", "linear", 1), ("linear", "linear", 250_000), ("higher", "higher", 100), ("count", "inverted_cdf", 100)],
)
def test_matches_numpy_per_group(spark, rule, method, gap_rows):
    made = groups()
    found = grouped_order_statistics(frame(spark, made), ["k 1", "g"], Wanted(F.col("x"), QUANTILES, rule), gap_rows)
    assert found.columns == ["k 1", "g", "rows", "values"]
    found = {(r["k 1"], r["g"]): (r["rows"], r["values"]) for r in found.collect()}
    assert found.pop(("none", 0)) == (0, None)
    assert set(found) == set(made)
    for key, values in made.items():
        assert found[key][0] == len(values)
        expected = np.quantile(values, QUANTILES, method=method)
        assert np.array_equal(found[key][1], expected) if rule != "linear" else np.allclose(found[key][1], expected, rtol=1e-13)


def test_empty_table_and_infinite_values(spark):
    schema = "g string, x double"
    wanted = Wanted(F.col("x"), (0.5,))
    assert grouped_order_statistics(spark.createDataFrame([], schema), ["g"], wanted).isEmpty()
    with pytest.raises(PySparkException, match="infinite"):
        grouped_order_statistics(spark.createDataFrame([("a", math.inf)], schema), ["g"], wanted).collect()
