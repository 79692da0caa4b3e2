import logging
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelry.contract import MODEL_FEATURES, TrainingOptions
from parcelry.operators import features, intervals, models, scoring
from parcelry.plans import jobs
from parcelry.sources import models as store
from parcelry.sources import tables


def rows(spark, n=300):
    i = F.col("id")
    price = 150000 + i * 900 + (i % 7) * 4000
    return spark.range(n).select(
        i.alias("property_id"),
        (i % 5).cast("double").alias("bedrooms"),
        (i % 3 + 1).cast("double").alias("bathrooms"),
        F.when(i % 11 != 0, 900 + i * 3.0).alias("living_area"),
        (36 + (i % 10) / 100).alias("latitude"),
        (-115 - (i % 13) / 100).alias("longitude"),
        (2000 + (i % 17) * 100).cast("double").alias("normalized_lot_area_value"),
        F.when(i % 4 == 0, "CONDO").when(i % 4 == 1, "TOWNHOUSE").otherwise("SINGLE_FAMILY").alias("property_type"),
        F.when(i % 2 == 0, "Anthem").when(i % 19 != 0, "Paradise").alias("vegas_district"),
        price.cast("double").alias("price"),
    )


def fit(spark, df, model_type, hyperparameters, transform="log1p"):
    fitted = features.Preprocessor().fit(df)
    model = models.fit_model(spark, df, fitted, "price", model_type, hyperparameters, target_transform=transform)
    return store.TrainedModel(model, fitted, {"target_transform": transform})


@pytest.mark.parametrize("alpha", [0.0001, 1.0, 50.0])
def test_ridge_matches_the_closed_form(spark, alpha):
    df = rows(spark)
    trained = fit(spark, df, "ridge", {"alpha": alpha})
    made = trained.preprocessor.transform(df, keep=["property_id", "price"]).orderBy("property_id").toPandas()
    x = made[trained.preprocessor.feature_names].to_numpy()
    y = np.log1p(made["price"].to_numpy())
    centred = x - x.mean(axis=0)
    slopes = np.linalg.solve(centred.T @ centred + alpha * np.eye(x.shape[1]), centred.T @ (y - y.mean()))
    expected = np.expm1(y.mean() + centred @ slopes)
    scored = scoring.predict(df, trained).orderBy("property_id").toPandas()["prediction"].to_numpy()
    assert scored == pytest.approx(expected, rel=1e-7)


@pytest.mark.parametrize("name", sorted(models.MODEL_TYPES))
def test_every_model_name_trains(spark, name):
    small = {"n_estimators": 2, "max_iter": 2, "max_depth": 2, "min_samples_leaf": 1}
    trained = fit(spark, rows(spark, 80), name, {k: v for k, v in small.items() if "idge" not in name})
    assert scoring.predict(rows(spark, 80), trained).filter("prediction > 0").count() == 80


def test_unknown_model_and_ignored_hyperparameters(spark, caplog):
    with pytest.raises(ValueError, match="'svm' is unknown"):
        models.model_family("svm")
    with caplog.at_level(logging.INFO, "parcelry.operators.models"):
        chosen = models.model_parameters("hist_gradient_boosting", {"learning_rate": 0.03, "alpha": 3}, 42)
    assert chosen["stepSize"] == 0.03 and chosen["seed"] == 42 and "alpha" not in chosen
    assert "alpha" in caplog.text
    assert "seed" not in models.model_parameters("ridge", None, 42)


def test_untransformed_target(spark):
    df = rows(spark, 120)
    plain = fit(spark, df, "ridge", {"alpha": 0.01}, transform="none")
    error = scoring.predict(df, plain).agg(F.avg(F.abs(F.col("prediction") - F.col("price")))).first()[0]
    assert error < 20000


@pytest.mark.parametrize("transform", ["log1p", "none"])
def test_forest_bounds_match_the_trees_one_by_one(spark, transform):
    df = rows(spark, 150)
    trained = fit(spark, df, "random_forest", {"n_estimators": 7, "max_depth": 4}, transform)
    scored = scoring.score_table(df, trained).orderBy("property_id").toPandas()
    ready = df.orderBy("property_id")
    for stage in trained.model.stages[:-2]:
        ready = stage.transform(ready)
    by_tree = []
    for i, tree in enumerate(models.inner_model(trained.model).trees):
        found = tree.setPredictionCol(f"t{i}").transform(ready).select(f"t{i}").toPandas()[f"t{i}"]
        by_tree.append(found.to_numpy())
    by_tree = np.expm1(np.array(by_tree)) if transform == "log1p" else np.array(by_tree)
    assert scored["lower_bound"].to_numpy() == pytest.approx(np.percentile(by_tree, 2.5, axis=0), rel=1e-12)
    assert scored["upper_bound"].to_numpy() == pytest.approx(np.percentile(by_tree, 97.5, axis=0), rel=1e-12)


def test_forest_bounds_by_join_equal_those_by_constant(spark):
    df = rows(spark, 90)
    trained = fit(spark, df, "random_forest", {"n_estimators": 5, "max_depth": 3})
    scored, inner = trained.model.transform(df.unionByName(df.limit(7))), models.inner_model(trained.model)
    found = [
        sorted(map(tuple, intervals.with_forest_bounds(scored, inner, models.LEAF, "log1p", sent).select("property_id", "lower_bound", "upper_bound").collect()))
        for sent in (intervals.LEAVES_SENT, 0)
    ]
    assert found[0] == found[1] and len(found[0]) == 97
    listed = [v for r in intervals.leaf_values(inner).orderBy("tree").collect() for v in r["values"]]
    assert listed == [float(v) for v in re.findall(r"Predict: (\S+)", inner.toDebugString)]


def test_feature_importance_is_ordered_and_trees_only(spark):
    df = rows(spark)
    trained = fit(spark, df, "random_forest", {"n_estimators": 3, "max_depth": 4})
    found = models.feature_importance(spark, trained.model, trained.preprocessor.feature_names, 5).collect()
    assert len(found) == 5 and found[0]["feature"] == "living_area"
    assert [r["importance"] for r in found] == sorted((r["importance"] for r in found), reverse=True)
    with pytest.raises(ValueError, match="importances"):
        models.feature_importance(spark, fit(spark, df, "ridge", {}).model, [])


def test_train_save_load_score(spark, raw_training, tmp_path):
    options = TrainingOptions(handle_outliers=False, hyperparameters={"max_iter": 3})
    result = jobs.train_job(spark, raw_training, options)
    metadata = result.trained.metadata
    assert (metadata["train_size"], metadata["test_size"], metadata["val_size"]) == (36, 9, 0)
    assert set(result.metrics) == {"r2", "rmse", "mae", "mse", "cheap_segment_mae", "cheap_segment_cutoff_p25"}
    interval = metadata["prediction_interval"]
    assert set(interval["relative_error_quantiles_by_segment"]) == {interval["relative_error_quantiles"]["global"]}
    assert metadata["val_metrics"] is None and metadata["model_key"] == "hist_gradient_boosting"
    assert len(metadata) == 11

    path = store.save_model(spark, result.trained, str(tmp_path / "artifacts"))
    loaded = store.load_model(spark, path)
    assert loaded.metadata == metadata
    assert loaded.preprocessor == result.trained.preprocessor
    assert metadata["feature_names"] == loaded.preprocessor.feature_names
    row = raw_training.limit(1).select(*MODEL_FEATURES)
    assert np.isfinite(scoring.predict(row, loaded).first()["prediction"])
    before = scoring.score_table(raw_training, result.trained).orderBy("property_id").collect()
    assert scoring.score_table(raw_training, loaded).orderBy("property_id").collect() == before

    runs = jobs.run_metrics(spark, result)
    assert {r["metric_name"] for r in runs.collect()} >= {"test_r2", "test_rmse"}


def test_loading_needs_model_and_preprocessor_but_not_metadata(spark, tmp_path, caplog):
    path = str(tmp_path / "model")
    with pytest.raises(FileNotFoundError, match="No saved model"):
        store.load_model(spark, path)
    trained = fit(spark, rows(spark, 60), "ridge", {})
    trained.model.save(f"{path}/model")
    with pytest.raises(FileNotFoundError, match="No saved preprocessor"):
        store.load_model(spark, path)
    store._write_text(spark, f"{path}/preprocessor", trained.preprocessor.to_json())
    assert store.load_model(spark, path).metadata == {}
    assert "No metadata" in caplog.text


def test_scoring_keeps_original_columns_and_fills_only_for_the_model(spark, tmp_path):
    trained = fit(spark, rows(spark), "ridge", {"alpha": 1.0})
    trained.metadata["prediction_interval"] = {
        "method": intervals.METHOD, "segment_edges": [], "relative_error_quantiles_by_segment": [0.1],
    }
    requests = spark.createDataFrame(
        [(1, 2.0, 2.0, 1500.0, None, None, "CONDO", "Anthem", -1.0), (2, 2.0, 2.0, 1500.0, None, None, "CONDO", "Nowhere", -1.0)],
        "id long, bedrooms double, bathrooms double, livingarea double, latitude double, longitude double, "
        "propertytype string, vegas_district string, prediction double",
    )
    scored = scoring.score_table(requests, trained)
    assert scored.columns == [c for c in requests.columns if c != "prediction"] + ["prediction", "lower_bound", "upper_bound"]
    found = {r["id"]: r for r in scored.collect()}
    assert found[1]["latitude"] is None and found[1]["prediction"] > 0
    assert found[1]["upper_bound"] == pytest.approx(found[1]["prediction"] * 1.1)
    assert [r["id"] for r in scoring.score_table(requests, trained, on_missing_location="reject").collect()] == [1]
    assert [r["id"] for r in scoring.rejected_requests(requests).collect()] == [2]
    with pytest.raises(ValueError, match="bathrooms"):
        scoring.score_table(requests.drop("bathrooms"), trained)
    with pytest.raises(ValueError, match="on_missing_location"):
        scoring.score_table(requests, trained, on_missing_location="guess")
    path = jobs.score_job(requests, trained, str(tmp_path / "scored"))
    assert tables.read_csv(spark, path, scored.schema).orderBy("id").collect() == scored.orderBy("id").collect()


@pytest.mark.parametrize(
    "family, given, expected",
    [
        ("random_forest", {}, {"maxDepth": 30, "maxBins": 256, "featureSubsetStrategy": "all"}),
        ("random_forest", {"max_depth": None}, {"maxDepth": 30}),
        ("random_forest", {"max_features": "sqrt", "min_impurity_decrease": 0.1, "max_samples": 0.5}, {"featureSubsetStrategy": "sqrt", "minInfoGain": 0.1, "subsamplingRate": 0.5}),
        ("random_forest", {"max_features": 0.5}, {"featureSubsetStrategy": "0.5"}),
        ("random_forest", {"max_features": 1.0}, {"featureSubsetStrategy": "all"}),
        ("gradient_boosting", {"max_depth": None, "max_features": 3}, {"maxDepth": 30, "featureSubsetStrategy": "3", "maxBins": 256}),
    ],
)
def test_hyperparameters_reach_spark(family, given, expected):
    chosen = models.model_parameters(family, given, 42)
    assert {k: chosen[k] for k in expected} == expected
    models.make_estimator(family, given, 42)


def test_what_has_no_counterpart_is_warned_about(caplog):
    with caplog.at_level("WARNING"):
        chosen = models.model_parameters("hist_gradient_boosting", {"max_features": 0.1}, 42)
        models.model_parameters("random_forest", {"max_samples": 50}, 42)
    assert "max_features" in caplog.text and "max_samples" in caplog.text and "max_features" not in chosen


def test_leafwise_options():
    plain = models.leafwise_options({}, 42)
    assert (plain.max_leaf_nodes, plain.max_depth, plain.min_samples_leaf, plain.max_bins, plain.l2_regularization) == (31, None, 20, 255, 0.0)
    given = models.leafwise_options({"max_leaf_nodes": None, "max_depth": 4, "l2_regularization": 2.0, "early_stopping": False}, 7)
    assert (given.max_leaf_nodes, given.max_depth, given.l2_regularization, given.early_stopping, given.seed) == (None, 4, 2.0, False, 7)
    with pytest.raises(ValueError, match="fit_model"):
        models.make_estimator("hist_gradient_boosting", {}, 42)


def test_ridge_of_ten_thousand_categories(spark):
    """One encoded column has a closed form: shrunken means around an intercept that is not penalised."""
    n, wide, alpha = 30_000, 10_000, 1.0
    i = F.col("id")
    df = spark.range(n).select((i * 7919 % wide).cast("string").alias("vegas_district"), (i % 97 + i * 7919 % wide % 13 * 5).cast("double").alias("price"))
    fitted = features.FittedPreprocessor((), tuple(features.fit_categorical(df, ["vegas_district"])))
    model = models.fit_model(spark, df, fitted, "price", "ridge", {"alpha": alpha}, target_transform="none")
    assert len(models.inner_model(model).coefficients) == wide
    by = df.groupBy("vegas_district").agg(F.count("*").alias("n"), F.avg("price").alias("y")).toPandas()
    weight = by["n"] * alpha / (by["n"] + alpha)
    start = (weight * by["y"]).sum() / weight.sum()
    expected = dict(zip(by["vegas_district"], start + by["n"] * (by["y"] - start) / (by["n"] + alpha)))
    found = model.transform(df.dropDuplicates(["vegas_district"])).select("vegas_district", "prediction").collect()
    assert max(abs(r["prediction"] - expected[r["vegas_district"]]) for r in found) < 1e-4


def test_both_ridge_solvers_agree(spark, monkeypatch):
    df = rows(spark)
    normal = fit(spark, df, "ridge", {"alpha": 2.0})
    monkeypatch.setattr(models, "NORMAL_COLUMNS", 0)
    wide = fit(spark, df, "ridge", {"alpha": 2.0})
    one, other = (models.inner_model(t.model) for t in (normal, wide))
    assert other.coefficients.toArray() == pytest.approx(one.coefficients.toArray(), abs=1e-6)
    assert other.intercept == pytest.approx(one.intercept, abs=1e-6)
