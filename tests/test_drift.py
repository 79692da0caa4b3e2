import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.operators import drift
from parcelry.plans import jobs
from parcelry.sources import snapshots


def prices(spark, values, date="2026-03-01"):
    df = spark.createDataFrame([(float(v) if v is not None else None,) for v in values], "price double")
    return df.withColumn("snapshot_date", F.lit(date).cast("date"))


@pytest.fixture(scope="module")
def shifted(spark):
    return prices(spark, range(1, 21)), prices(spark, range(6, 26))


def test_psi_leaves_out_values_beyond_the_edges(shifted):
    found = drift.psi(*shifted, F.col("price"), 4).first()
    assert found["psi"] == pytest.approx(3.1792121381078444, rel=1e-14)
    assert (found["reference_rows"], found["current_rows"]) == (20, 20)


def test_snapshot_psi_counts_them_in_the_outer_buckets(spark, shifted):
    log = np.log1p
    edges = log(np.quantile(np.arange(1, 21), np.linspace(0, 1, 5)))
    snapshot = {"price_log_bin_edges": list(edges), "price_log_ref_pct": [0.25] * 4}
    assert drift.psi_vs_snapshot(shifted[1], snapshot).first()["psi"] == pytest.approx(3.2805784151348854, rel=1e-9)


@pytest.mark.parametrize(
    "reference, current",
    [(range(9), range(20)), (range(20), range(9)), ([5] * 20, range(20)), ([], range(20)), ([None] * 20, range(20))],
)
def test_psi_is_null_without_enough_to_compare(spark, reference, current):
    assert drift.psi(prices(spark, reference), prices(spark, current), F.col("price"), 4).first()["psi"] is None


def test_psi_with_nothing_in_range_uses_the_stand_in_share(spark):
    found = drift.psi(prices(spark, range(20)), prices(spark, range(100, 120)), F.col("price"), 2).first()["psi"]
    assert found == pytest.approx(2 * (0.5 - 1e-6) * np.log(0.5 / 1e-6))


def test_histogram_closes_the_last_bucket_and_shows_empty_ones(spark):
    df = prices(spark, [0, 1, 1.5, 2, 3, 9, 10, 10.5, None])
    found = drift.histogram(df, F.col("price"), [1.0, 2.0, 4.0, 8.0, 10.0]).orderBy("bucket").collect()
    assert [tuple(r) for r in found] == [(0, 2), (1, 2), (2, 0), (3, 2)]


def test_repeated_quantiles_merge_into_one_edge(spark):
    snapshot = drift.take_snapshot(prices(spark, [1] * 50 + list(range(1, 51))), 10)
    edges = snapshot["price_log_bin_edges"]
    assert edges == sorted(set(edges)) and len(edges) < 11
    assert sum(snapshot["price_log_ref_pct"]) == pytest.approx(1)
    assert len(snapshot["price_raw_quantiles"]) == 11


def test_constant_prices_give_one_edge(spark):
    snapshot = drift.take_snapshot(prices(spark, [5] * 12))
    assert len(snapshot["price_log_bin_edges"]) == 1 and snapshot["price_log_ref_pct"] == []
    assert drift.drift_verdict(prices(spark, [5] * 12), snapshot).first()["drift_level"] == "unknown"


def test_snapshot_matches_numpy(spark):
    values = np.exp(np.random.default_rng(3).normal(13, 1, 500))
    snapshot = drift.take_snapshot(prices(spark, [*values, None]))
    assert snapshot["row_count"] == 501 and snapshot["snapshot_date"] == "2026-03-01"
    assert snapshot["price_median"] == np.median(values)
    assert snapshot["price_std"] == pytest.approx(np.std(values, ddof=1))
    assert snapshot["price_raw_quantiles"] == list(np.quantile(values, np.linspace(0, 1, 11)))
    assert snapshot["price_log_bin_edges"] == pytest.approx(list(np.quantile(np.log1p(values), np.linspace(0, 1, 11))))
    counts, _ = np.histogram(np.log1p(values), bins=snapshot["price_log_bin_edges"])
    assert snapshot["price_log_ref_pct"] == pytest.approx(list(counts / 500), abs=2e-3)


SNAPSHOT = {
    "snapshot_date": "2026-02-01", "row_count": 100, "price_median": 50.0,
    "price_log_bin_edges": [0.0, 1.0, 2.0, 3.0], "price_log_ref_pct": [0.2, 0.5, 0.3],
}


def at_level(spark, shares):
    rows = [np.expm1(x) for x, n in zip((0.5, 1.5, 2.5), shares) for _ in range(n)]
    return prices(spark, rows)


@pytest.mark.parametrize(
    "shares, threshold, level, retrain",
    [
        ((200, 500, 300), 0.01, "none", False),
        ((200, 500, 300), 0.0, "none", False),
        ((240, 480, 280), 0.01, "moderate", None),
        ((400, 400, 200), 0.01, "high", True),
        ((400, 400, 200), 5.0, "high", False),
    ],
)
def test_verdict_levels(spark, shares, threshold, level, retrain):
    found = drift.drift_verdict(at_level(spark, shares), SNAPSHOT, threshold).first()
    if level == "moderate":
        expected = found["psi"] >= threshold and found["psi"] >= 0.01
        assert found["should_retrain"] == expected
        return
    assert (found["drift_level"], found["should_retrain"]) == (level, retrain)
    assert found["current_row_count"] == 1000 and found["reference_row_count"] == 100
    assert found["current_snapshot_date"] == "2026-03-01"
    assert f"PSI={found['psi']:.4f}" in found["reason"]


def test_verdict_without_usable_edges_is_unknown(spark):
    found = drift.drift_verdict(prices(spark, range(20)), {"row_count": 3, "price_log_bin_edges": [1.0, 2.0]}).first()
    assert (found["drift_level"], found["should_retrain"], found["psi"]) == ("unknown", False, None)


def test_verdict_needs_a_price_column(spark):
    with pytest.raises(ValueError, match="price"):
        drift.drift_verdict(spark.range(3), None)


def test_date_is_unknown_without_the_column(spark):
    assert drift.price_summary(prices(spark, [1, 2]).drop("snapshot_date")).first()["snapshot_date"] == "unknown"
    assert drift.price_summary(prices(spark, [1])).first()["price_std"] is None


def test_store_returns_the_newest_version(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    assert snapshots.load_snapshot(spark, path) is None
    first, second = drift.take_snapshot(prices(spark, range(1, 40))), drift.take_snapshot(prices(spark, range(1, 60)))
    assert snapshots.save_snapshot(spark, path, first) == 1
    assert snapshots.load_snapshot(spark, path) == first
    assert snapshots.save_snapshot(spark, path, second) == 2
    assert snapshots.load_snapshot(spark, path) == second


def test_snapshot_document_of_its_own(spark, tmp_path):
    document = {"snapshot_date": "2026-03-01", "row_count": 3, "bins": 2, "price_log_bin_edges": [1.0, 2.0, 3.0]}
    (tmp_path / "one.json").write_text(json.dumps(document, indent=2))
    found = snapshots.read_snapshot_document(spark, str(tmp_path / "one.json"))
    assert {k: found[k] for k in document} == document and found["price_median"] is None
    assert snapshots.read_snapshot_document(spark, str(tmp_path / "two.json")) is None


def test_refresh_replaces_the_snapshot_only_on_retraining(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    steady, moved = prices(spark, range(1000, 2000)), prices(spark, range(3000, 4000), "2026-04-01")
    first = jobs.refresh_job(spark, steady, path, str(tmp_path / "extract")).first()
    assert first["drift_level"] == "no_reference" and first["reference_row_count"] is None
    assert spark.read.option("header", "true").csv(str(tmp_path / "extract")).count() == 1000
    same = jobs.refresh_job(spark, steady, path).first()
    assert same["drift_level"] == "none" and same["psi"] == 0.0
    assert snapshots.load_snapshot(spark, path)["price_median"] == 1499.5
    drifted = jobs.refresh_job(spark, moved, path, str(tmp_path / "parquet"), "parquet").first()
    assert drifted["should_retrain"] and drifted["reference_price_median"] == 1499.5
    assert snapshots.load_snapshot(spark, path)["price_median"] == 3499.5
    with pytest.raises(Exception, match="price"):
        jobs.refresh_job(spark, steady.withColumnRenamed("price", "cost"), path)


def test_counts_of_batches_add_up_to_a_scan_of_all(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    prices = spark.range(3000).select((F.col("id") * 37 % 1009 + 100.0).alias("price"))
    current = spark.range(900).select(
        F.when(F.col("id") % 50 == 0, F.lit(float("nan"))).otherwise(F.col("id") * 11 % 1500 + 1.0).alias("price"), (F.col("id") % 3).alias("batch")
    )
    snapshot = drift.take_snapshot(prices)
    with pytest.raises(ValueError, match="no snapshot"):
        snapshots.count_batch(spark, path, "a", current)
    snapshots.save_snapshot(spark, path, snapshot)
    for batch in (0, 1, 2, 1):
        counts = snapshots.count_batch(spark, path, str(batch), current.where(F.col("batch") == batch))
    assert counts["batches"] == ["0", "1", "2"]
    expected = drift.psi_vs_snapshot(current, snapshot).first()
    assert snapshots.psi_of_batches(spark, path).first() == expected
    empty = snapshots.count_batch(spark, path, "none", current.limit(0))
    assert empty["rows"] == expected["current_rows"] == 882
    snapshots.save_snapshot(spark, path, drift.take_snapshot(current))
    assert snapshots.count_batch(spark, path, "3", prices)["batches"] == ["3"]
    assert snapshots.psi_of_batches(spark, path).first()["current_rows"] == 3000


def test_counts_against_a_constant_reference_give_no_psi(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    rows = spark.range(20).select(F.lit(5.0).alias("price"))
    snapshots.save_snapshot(spark, path, drift.take_snapshot(rows))
    snapshots.count_batch(spark, path, "a", rows)
    assert tuple(snapshots.psi_of_batches(spark, path).first()) == (None, 20)
