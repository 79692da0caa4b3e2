"""Every operator as a query over the given tables. Each callable takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.contract import CATEGORICAL_FEATURES, NUMERIC_FEATURES, OPTIONAL_DEFAULTS
from parcelry.functions.columns import named
from parcelry.operators import cleaning, drift, features, intervals, location, metrics, models, scoring
from parcelry.operators import splitting, versions
from parcelry.operators.grouped_stats import grouped_order_statistics
from parcelry.operators.order_stats import Wanted, linear_grid, order_statistics
from parcelry.plans import jobs, listings as shapes
from parcelry.plans.listings import OPTIONS, listings, priced_orders, table
from parcelry.session import held, new_shared_path
from parcelry.sources import commits
from parcelry.sources import models as model_store
from parcelry.sources import snapshots, tables

SPLIT_DATE = "1998-01-01"
RAISED = 1.15
HISTOGRAM_EDGES = [50_000.0, 100_000.0, 175_000.0, 300_000.0, 480_000.0, 600_000.0, 700_000.0]
SQL_PARAMS = {"low": 250_000.0, "priority": "2-HIGH"}
OPTIONS_SEEN = {
    "property_type": ["1-URGENT", "2-HIGH", "3-MEDIUM"],
    "vegas_district": [f"NATION_{i}" for i in range(12)],
}
ENCODED_TYPES = ["1-URGENT", "2-HIGH", "5-LOW"]
LEGACY_INTERVAL = {
    "method": intervals.METHOD,
    "segment_edges": [150_000.0, 320_000.0],
    "relative_error_quantiles": {"global": 0.3, "low": 0.45, "high": 0.2},
}
SCORE_INTERVAL = {
    "method": intervals.METHOD,
    "segment_edges": [200_000.0, 202_000.0, 204_000.0, 206_000.0],
    "relative_error_quantiles_by_segment": [0.5, 0.4, 0.3, 0.2, 0.1],
    "relative_error_quantiles": {"global": 0.35},
}
RIDGE_ALPHA = 25.0


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n), digits) for n in names})


# Sources


def scan_priced(spark, folder):
    orders = table(spark, folder, "orders")
    return tables.scan_priced(orders, "o_totalprice").select("o_orderkey", "o_totalprice")


def _spoiled_prices(spark, folder):
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    spoiled = (
        F.when(key % 41 == 0, F.lit(None).cast("double"))
        .when(key % 43 == 0, F.lit(float("nan")))
        .when(key % 47 == 0, -price)
        .otherwise(price)
    )
    return table(spark, folder, "orders").select(key.alias("property_id"), spoiled.alias("price"))


def scan_positive_priced(spark, folder):
    return tables.scan_positive_priced(_spoiled_prices(spark, folder))


def sql_with_params(spark, folder):
    query = (
        "SELECT o_orderkey, o_totalprice FROM {orders} "
        "WHERE o_totalprice >= :low AND o_orderpriority = :priority"
    )
    return tables.run_sql(spark, query, SQL_PARAMS, orders=table(spark, folder, "orders"))


def csv_roundtrip(spark, folder):
    rows = priced_orders(spark, folder)
    path = tables.write_csv(rows, new_shared_path(spark, "csv"))
    return tables.read_csv(spark, path, rows.schema)


def csv_line_breaks(spark, folder):
    """An extract whose text holds line breaks, quotes and commas."""
    rows = priced_orders(spark, folder).select(
        "property_id", "price", F.concat(F.lit('12 "Main", St\nApt '), F.col("property_id").cast("string")).alias("address")
    )
    return tables.store_extract(rows, new_shared_path(spark, "lines"), "csv")


def latest_per_key(spark, folder):
    history = table(spark, folder, "orders").select("o_custkey", "o_orderdate", "o_orderkey", "o_totalprice")
    newest = cleaning.latest_per_key(history, "o_custkey", "o_orderdate", ["o_orderkey"])
    return newest.select("o_custkey", F.to_date("o_orderdate").alias("o_orderdate"), "o_orderkey", "o_totalprice")


# Columns, rows and contract


def drop_columns(spark, folder):
    return cleaning.drop_non_model_columns(listings(spark, folder))


def cast_numeric(spark, folder):
    texts = {c: F.col(c).cast("string") for c in NUMERIC_FEATURES}
    rows = listings(spark, folder).select("property_id", *NUMERIC_FEATURES).withColumns(texts)
    return cleaning.cast_numeric(rows)


def exclude_types(spark, folder):
    rows = priced_orders(spark, folder).select("property_id", "property_type")
    return cleaning.exclude_types(rows, OPTIONS.exclude_property_types)


def outlier_filter(spark, folder):
    rows = cleaning.remove_outliers(listings(spark, folder), OPTIONS)
    return rows.select("property_id", "price", "living_area")


def select_contract(spark, folder):
    return cleaning.select_training_columns(listings(spark, folder))


def clean_rows(spark, folder):
    rows = listings(spark, folder)
    copies = rows.filter(F.col("property_id") % 3 == 0)
    return cleaning.clean(rows.unionAll(copies), OPTIONS, keep=["property_id"])


def alias_rename(spark, folder):
    return cleaning.rename_aliases(shapes.requests(spark, folder))


def validate_rows(spark, folder):
    checked = cleaning.with_errors(shapes.requests(spark, folder))
    return checked.select("property_id", F.concat_ws("; ", "errors").alias("errors"))


def validate_text_rows(spark, folder):
    """The same rules over fields that arrive as text."""
    key, rows = F.col("property_id"), shapes.requests(spark, folder)
    texts = {c: F.col(c).cast("decimal(12,2)").cast("string") for c in ("bedrooms", "bathrooms", "livingarea")}
    rows = rows.select("property_id", "propertytype", *[x.alias(c) for c, x in texts.items()])
    rows = rows.withColumn("bedrooms", F.when(key % 5 == 0, "abc").otherwise(F.col("bedrooms")))
    rows = rows.withColumn("bathrooms", F.when(key % 7 == 0, "99").when(key % 11 == 0, "").otherwise(F.col("bathrooms")))
    rows = rows.withColumn("livingarea", F.when(key % 13 == 0, "-5").otherwise(F.col("livingarea")))
    return cleaning.with_errors(rows).select("property_id", F.concat_ws("; ", "errors").alias("errors"))


def reject_summary(spark, folder):
    return cleaning.reject_summary(cleaning.with_errors(shapes.requests(spark, folder)))


def fill_optional(spark, folder):
    return cleaning.fill_optional(shapes.requests(spark, folder)).select("property_id", *OPTIONAL_DEFAULTS)


def unseen_categories(spark, folder):
    return cleaning.unseen_categories(listings(spark, folder), OPTIONS_SEEN)


# Duplicates and splits


def dedup_rows(spark, folder):
    pairs = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    return cleaning.drop_duplicate_rows(pairs)


def _sides(parts):
    train, test = parts
    return train.select("property_id", F.lit("train").alias("side")).unionAll(
        test.select("property_id", F.lit("test").alias("side"))
    )


def hash_split(spark, folder):
    return _sides(splitting.hash_split(priced_orders(spark, folder), "property_id"))


def exact_split(spark, folder):
    return _sides(splitting.exact_split(priced_orders(spark, folder), "property_id"))


# Location


def centroid_backfill(spark, folder):
    rows = listings(spark, folder).select("property_id", "vegas_district", "latitude", "longitude")
    return location.backfill_location(rows, shapes.nation_centroids(spark, folder))


def missing_location(spark, folder):
    return location.split_missing_location(centroid_backfill(spark, folder))[1]


# Aggregates and order statistics


def price_summary(spark, folder):
    return rounded(drift.price_summary(priced_orders(spark, folder)), 4, "price_mean", "price_std", "price_median")


def _steps(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "step int, value double")


def quantiles(spark, folder):
    stats = order_statistics(
        table(spark, folder, "orders"), {"x": Wanted(F.col("o_totalprice"), linear_grid(10))}
    )
    return rounded(_steps(spark, stats.values["x"]), 4, "value")


def quantiles_by_cuts(spark, folder):
    """The path a very large column takes: gaps of 100 rows force repeated cutting."""
    stats = order_statistics(
        table(spark, folder, "lineitem"), {"x": Wanted(F.col("l_extendedprice"), linear_grid(20))}, gap_rows=100
    )
    return rounded(_steps(spark, stats.values["x"]), 4, "value")


def histogram(spark, folder):
    return drift.histogram(table(spark, folder, "orders"), F.col("o_totalprice"), HISTOGRAM_EDGES)


def order_stat_higher(spark, folder):
    error = intervals.relative_error(F.col("actual"), F.col("prediction"))
    stats = order_statistics(
        shapes.fixed_predictions(spark, folder), {"x": Wanted(error, (0.05, 0.5, 0.95), "higher")}
    )
    return rounded(_steps(spark, stats.values["x"]), 9, "value")


def _grouped(spark, folder, key, wanted, **options):
    found = grouped_order_statistics(table(spark, folder, "orders"), [key], wanted, **options)
    columns = [F.round(F.col("values")[i], 4).alias(f"value_{i}") for i in range(len(wanted.quantiles))]
    return found.select(key, F.col("rows").alias("orders_held"), *columns)


def order_stat_by_customer(spark, folder):
    return _grouped(spark, folder, "o_custkey", Wanted(F.col("o_totalprice"), (0.05, 0.5, 0.95), "higher"))


def order_stat_by_status_by_cuts(spark, folder):
    """A few large groups along the path of a very large table."""
    return _grouped(spark, folder, "o_orderstatus", Wanted(F.col("o_totalprice"), (0.1, 0.5, 0.9)), gap_rows=200)


def regression_metrics(spark, folder):
    found = metrics.regression_metrics(shapes.fixed_predictions(spark, folder), "actual", "prediction")
    return rounded(rounded(found, 9, "r2"), 3, "rmse", "mae", "mse")


def regression_metrics_missing(spark, folder):
    """Rows that lack the prediction, or the price, count in no metric."""
    key, rows = F.col("property_id"), shapes.fixed_predictions(spark, folder)
    rows = rows.select(
        F.when(key % 5 != 0, F.col("actual")).alias("actual"), F.when(key % 3 != 0, F.col("prediction")).alias("prediction")
    )
    found = metrics.regression_metrics(rows, "actual", "prediction")
    return rounded(rounded(found, 9, "r2"), 3, "rmse", "mae", "mse")


def cheap_segment_mae(spark, folder):
    found = metrics.evaluation_metrics(shapes.fixed_predictions(spark, folder), "actual", "prediction")
    return rounded(found.select("cheap_segment_mae", "cheap_segment_cutoff_p25"), 4, "cheap_segment_mae", "cheap_segment_cutoff_p25")


# Drift


def _by_date(spark, folder):
    rows = priced_orders(spark, folder)
    return rows.filter(F.col("snapshot_date") < SPLIT_DATE), rows.filter(F.col("snapshot_date") >= SPLIT_DATE)


def psi(spark, folder):
    reference, current = _by_date(spark, folder)
    return rounded(drift.psi(reference, current, F.col("price"), 10), 9, "psi")


def price_psi(spark, folder):
    reference, current = _by_date(spark, folder)
    return rounded(drift.price_psi(reference, current), 9, "psi")


def price_psi_by_cuts(spark, folder):
    """price_psi along the path of a very large table."""
    reference, current = _by_date(spark, folder)
    return rounded(drift.price_psi(reference, current, gap_rows=50), 9, "psi")


def _labelled(name):
    def element(v, i):
        return F.struct(F.lit(name).alias("field"), i.alias("position"), v.alias("value"))

    return F.transform(F.col(name), element)


def _snapshot_rows(frame):
    plain = ["row_count", "bins", "price_median", "price_mean", "price_std"]
    arrays = ["price_log_bin_edges", "price_log_ref_pct", "price_raw_quantiles"]
    single = [
        F.struct(F.lit(c).alias("field"), F.lit(0).alias("position"), F.col(c).cast("double").alias("value"))
        for c in plain
    ]
    many = [_labelled(c) for c in arrays]
    long = frame.select("snapshot_date", F.inline(F.concat(F.array(*single), *many)))
    return rounded(long, 6, "value")


def drift_snapshot(spark, folder):
    snapshot = drift.take_snapshot(_by_date(spark, folder)[0])
    return _snapshot_rows(drift.snapshot_frame(spark, snapshot))


def snapshot_roundtrip(spark, folder):
    path = new_shared_path(spark, "snapshots")
    reference, current = _by_date(spark, folder)
    snapshots.save_snapshot(spark, path, drift.take_snapshot(current))
    snapshots.save_snapshot(spark, path, drift.take_snapshot(reference))
    return _snapshot_rows(drift.snapshot_frame(spark, snapshots.load_snapshot(spark, path)))


def psi_vs_snapshot(spark, folder):
    reference, current = _by_date(spark, folder)
    return rounded(drift.psi_vs_snapshot(current, drift.take_snapshot(reference)), 9, "psi")


def psi_of_batches(spark, folder):
    """The check of psi_vs_snapshot from counts of one batch after another, one of them submitted twice."""
    reference, current = _by_date(spark, folder)
    path = new_shared_path(spark, "snapshots")
    snapshots.save_snapshot(spark, path, drift.take_snapshot(reference))
    for batch in (0, 1, 2, 1):
        snapshots.count_batch(spark, path, f"batch {batch}", current.where(F.col("property_id") % 3 == batch))
    return rounded(snapshots.psi_of_batches(spark, path), 9, "psi")


def _verdict(found):
    return rounded(rounded(found, 9, "psi"), 4, "current_price_median", "reference_price_median")


def drift_verdict(spark, folder):
    reference, current = _by_date(spark, folder)
    raised = current.withColumn("price", F.col("price") * F.lit(RAISED))
    return _verdict(drift.drift_verdict(raised, drift.take_snapshot(reference)))


def refresh_job(spark, folder):
    reference, current = _by_date(spark, folder)
    path = new_shared_path(spark, "snapshots")
    jobs.refresh_job(spark, reference, path)
    return _verdict(jobs.refresh_job(spark, current, path))


def verdict_no_reference(spark, folder):
    """The verdict of a first run."""
    return _verdict(drift.drift_verdict(_by_date(spark, folder)[1], None))


def verdict_unknown(spark, folder):
    """The verdict against a snapshot of one price, which has no usable edges."""
    reference, current = _by_date(spark, folder)
    flat = drift.take_snapshot(reference.withColumn("price", F.lit(100.0)))
    return _verdict(drift.drift_verdict(current, flat))


def psi_guards(spark, folder):
    """No psi for a constant reference, nor for fewer than ten values on a side."""
    reference, current = _by_date(spark, folder)
    few = current.filter("property_id < 20").limit(9)
    cases = [
        ("constant", drift.psi(reference.withColumn("price", F.lit(1.0)), current, F.col("price"))),
        ("few", drift.psi(reference, few, F.col("price"))),
    ]
    found = [df.select(F.lit(name).alias("case_name"), "psi", "reference_rows") for name, df in cases]
    return found[0].unionByName(found[1])


def snapshot_replaced(spark, folder):
    """The snapshot that a refresh leaves after prices far from the stored ones asked for retraining."""
    reference, current = _by_date(spark, folder)
    path = new_shared_path(spark, "snapshots")
    snapshots.save_snapshot(spark, path, drift.take_snapshot(current.withColumn("price", F.col("price") * 3)))
    jobs.refresh_job(spark, reference, path)
    return _snapshot_rows(drift.snapshot_frame(spark, snapshots.load_snapshot(spark, path)))


# Features


def _numeric(spark, folder):
    rows = listings(spark, folder).select("property_id", *NUMERIC_FEATURES)
    with held(rows.select(*NUMERIC_FEATURES)) as kept:
        return rows, features.fit_numeric(kept, NUMERIC_FEATURES)


def impute_median(spark, folder):
    return rounded(features.impute_numeric(*_numeric(spark, folder)), 6, *NUMERIC_FEATURES)


def standard_scale(spark, folder):
    return rounded(features.scale_numeric(*_numeric(spark, folder)), 6, *NUMERIC_FEATURES)


def impute_mode(spark, folder):
    rows = priced_orders(spark, folder).select("property_id", "property_type")
    return features.impute_categorical(rows, features.fit_categorical(rows, ["property_type"]))


def _encoded(rows, categories):
    made = features.one_hot(F.col("property_type"), categories)
    return rows.select("property_id", *[c.alias(f"property_type_{v}") for c, v in zip(made, categories)])


def one_hot(spark, folder):
    rows = priced_orders(spark, folder).select("property_id", "property_type")
    return _encoded(rows, features.fit_categorical(rows, ["property_type"])[0].categories)


def one_hot_unseen(spark, folder):
    return _encoded(priced_orders(spark, folder), ENCODED_TYPES)


def one_hot_index(spark, folder):
    """The only non-zero place of the one-hot vector of a column with very many categories."""
    rows = shapes.table(spark, folder, "orders").select(F.col("o_orderkey").alias("property_id"), F.col("o_custkey").cast("string").alias("customer"))
    return features.encode_index(rows, "customer", features.category_index(rows, ["customer"])).select("property_id", "index")


def one_hot_index_prefixed(spark, folder):
    """The same with values that all begin alike."""
    customer = F.format_string("Customer#%09d", F.col("o_custkey"))
    rows = shapes.table(spark, folder, "orders").select(F.col("o_orderkey").alias("property_id"), customer.alias("customer"))
    return features.encode_index(rows, "customer", features.category_index(rows, ["customer"])).select("property_id", "index")


def scale_constant(spark, folder):
    """A feature that was constant, with gaps, when fitted: other values are centred and scaled by 1."""
    key = F.col("property_id")
    rows = priced_orders(spark, folder).select("property_id", F.when(key % 3 != 0, F.lit(36.1699)).alias("latitude"))
    fits = features.fit_numeric(rows, ["latitude"])
    moved = rows.withColumn("latitude", F.col("latitude") + key % 5)
    return rounded(features.scale_numeric(moved, fits), 6, "latitude")


def preprocess(spark, folder):
    rows = listings(spark, folder)
    made = features.Preprocessor().fit_transform(rows, keep=["property_id"])
    return made.select("property_id", *[F.round(named(c), 6).alias(c) for c in made.columns[1:]])


# Models and intervals


def target_transform(spark, folder):
    there = priced_orders(spark, folder).select(
        "property_id", models.transform_target(F.col("price"), "log1p").alias("log_price")
    )
    back = there.withColumn("price", models.invert_target(F.col("log_price"), "log1p"))
    return rounded(rounded(back, 9, "log_price"), 4, "price")


def calibrate_interval(spark, folder):
    found = intervals.calibrate_interval(shapes.fixed_predictions(spark, folder), "actual", "prediction")
    return _interval_rows(spark, found)


def calibrate_interval_by_cuts(spark, folder):
    """calibrate_interval along the path of a very large table."""
    pairs = shapes.fixed_predictions(spark, folder)
    return _interval_rows(spark, intervals.calibrate_interval(pairs, "actual", "prediction", gap_rows=40))


def _interval_rows(spark, found):
    edges = found["segment_edges"] + [None]
    rows = [
        (i, edges[i], q, found["relative_error_quantiles"]["global"], found["calibration_size"])
        for i, q in enumerate(found["relative_error_quantiles_by_segment"])
    ]
    schema = "segment int, upper_edge double, quantile double, overall double, calibration_size bigint"
    return rounded(rounded(spark.createDataFrame(rows, schema), 4, "upper_edge"), 9, "quantile", "overall")


def _bounded(spark, folder, interval):
    rows = shapes.fixed_predictions(spark, folder).drop("actual")
    return intervals.add_interval(rows, interval)


def apply_interval(spark, folder):
    pairs = shapes.fixed_predictions(spark, folder)
    return _bounded(spark, folder, intervals.calibrate_interval(pairs, "actual", "prediction"))


def apply_interval_legacy(spark, folder):
    return _bounded(spark, folder, LEGACY_INTERVAL)


def interval_margin(spark, folder):
    found = intervals.interval_margin(_bounded(spark, folder, LEGACY_INTERVAL))
    return found.select("property_id", "margin", "margin_pct", "confidence_level")


def _ridge_one_feature(spark, folder):
    with held(listings(spark, folder).select("living_area", "price")) as rows:
        fitted = features.FittedPreprocessor(tuple(features.fit_numeric(rows, ["living_area"])), ())
        model = models.fit_model(spark, rows, fitted, "price", "ridge", {"alpha": RIDGE_ALPHA})
    metadata = {"target_transform": "log1p", "prediction_interval": SCORE_INTERVAL}
    return model_store.TrainedModel(model, fitted, metadata)


def train_ridge_one_feature(spark, folder):
    scored = scoring.predict(listings(spark, folder), _ridge_one_feature(spark, folder))
    return rounded(scored.select("property_id", "prediction"), 2, "prediction")


def score_table(spark, folder):
    rows = shapes.requests(spark, folder)
    scored = scoring.score_table(
        rows, _ridge_one_feature(spark, folder), shapes.nation_centroids(spark, folder), "reject"
    )
    names = ["property_id", "livingarea", "living_area", "latitude", *scoring.OUTPUTS]
    return rounded(scored.select(*names), 2, *scoring.OUTPUTS)


def score_job_csv(spark, folder):
    """The scoring job's output file, read back."""
    rows = shapes.requests(spark, folder).select("property_id", "livingarea", "latitude", "longitude", "vegas_district")
    path = new_shared_path(spark, "scored")
    jobs.score_job(rows, _ridge_one_feature(spark, folder), path, shapes.nation_centroids(spark, folder), "reject")
    schema = T.StructType([T.StructField("property_id", T.LongType()), *[T.StructField(c, T.DoubleType()) for c in ("livingarea", "latitude", "longitude")], T.StructField("vegas_district", T.StringType()), *[T.StructField(c, T.DoubleType()) for c in scoring.OUTPUTS]])
    found = tables.read_csv(spark, path, schema)
    return rounded(found.select("property_id", *scoring.OUTPUTS), 2, *scoring.OUTPUTS)


def _stump(spark, folder, family, hyperparameters):
    """One split on the number of lines of an order, fitted on all listings."""
    rows = listings(spark, folder).select("property_id", "bedrooms", "price").filter("bedrooms IS NOT NULL AND price IS NOT NULL")
    with held(rows) as kept:
        fitted = features.FittedPreprocessor((features.NumericFit("bedrooms", 0.0, 0.0, 1.0),), ())
        model = models.fit_model(spark, kept, fitted, "price", family, hyperparameters, target_transform="none")
    return rows, model_store.TrainedModel(model, fitted, {"target_transform": "none"})


def forest_stump(spark, folder):
    rows, trained = _stump(spark, folder, "random_forest", {"n_estimators": 1, "max_depth": 1, "bootstrap": False})
    return rounded(scoring.predict(rows, trained).select("property_id", "prediction"), 3, "prediction")


def boosted_stump(spark, folder):
    rows, trained = _stump(spark, folder, "gradient_boosting", {"n_estimators": 1, "max_depth": 1})
    return rounded(scoring.predict(rows, trained).select("property_id", "prediction"), 3, "prediction")


def stump_importance(spark, folder):
    _, trained = _stump(spark, folder, "random_forest", {"n_estimators": 1, "max_depth": 1, "bootstrap": False})
    return models.feature_importance(spark, trained.model, trained.preprocessor.feature_names)


#: One tree of four leaves over two numbers and the categories of a third column.
LEAFWISE = {"learning_rate": 1.0, "max_iter": 1, "max_leaf_nodes": 4, "l2_regularization": 5.0, "early_stopping": False}


def _leafwise(spark, folder):
    rows = listings(spark, folder).select("property_id", "bedrooms", "bathrooms", "property_type", "price")
    rows = rows.filter("bedrooms IS NOT NULL AND bathrooms IS NOT NULL AND property_type IS NOT NULL AND price IS NOT NULL")
    with held(rows) as kept:
        numbers = tuple(features.NumericFit(c, 0.0, 0.0, 1.0) for c in ("bedrooms", "bathrooms"))
        fitted = features.FittedPreprocessor(numbers, tuple(features.fit_categorical(kept, ["property_type"])))
        model = models.fit_model(spark, kept, fitted, "price", "hist_gradient_boosting", LEAFWISE, target_transform="none")
    return rows, model_store.TrainedModel(model, fitted, {"target_transform": "none"})


def leafwise_tree(spark, folder):
    rows, trained = _leafwise(spark, folder)
    return rounded(scoring.predict(rows, trained).select("property_id", "prediction"), 3, "prediction")


def leafwise_importance(spark, folder):
    """The five most important features of that tree; those it does not split on tie."""
    _, trained = _leafwise(spark, folder)
    found = models.feature_importance(spark, trained.model, trained.preprocessor.feature_names, 5)
    return rounded(found, 9, "importance")


def _train(spark, folder, model_type, hyperparameters):
    options = replace(OPTIONS, model_type=model_type, hyperparameters=hyperparameters)
    return jobs.train_job(spark, listings(spark, folder), options)


def _metric_rows(spark, result):
    rows = [(k, float(v)) for k, v in result.metrics.items()]
    sizes = [(k, float(result.trained.metadata[k])) for k in ("train_size", "test_size")]
    return spark.createDataFrame(rows + sizes, "name string, value double")


def train_ridge(spark, folder):
    return _metric_rows(spark, _train(spark, folder, "ridge", {"alpha": 1.0}))


def train_gradient_boosting(spark, folder):
    return _metric_rows(spark, _train(spark, folder, "gradient_boosting", {"n_estimators": 3}))


def train_hist_gradient_boosting(spark, folder):
    """A training run as shipped: 1,200 rounds, ended early only as the operator does by default on many rows."""
    return _metric_rows(spark, _train(spark, folder, "hist_gradient_boosting", OPTIONS.hyperparameters))


def _forest(spark, folder):
    return _train(spark, folder, "random_forest", {"n_estimators": 8, "max_depth": 5}).trained


def train_random_forest(spark, folder):
    return _metric_rows(spark, _train(spark, folder, "random_forest", {"n_estimators": 8, "max_depth": 5}))


def batch_score(spark, folder):
    trained = _train(spark, folder, "gradient_boosting", {"n_estimators": 3}).trained
    return scoring.predict(listings(spark, folder), trained).select("property_id", "prediction")


def forest_interval(spark, folder):
    trained = _forest(spark, folder)
    trained.metadata.pop("prediction_interval")
    return scoring.score_table(listings(spark, folder), trained).select("property_id", *scoring.OUTPUTS)


def _stump_bounds(spark, folder, **options):
    """Bounds from the trees of a forest of equal stumps on all listings, without a calibrated interval."""
    rows, trained = _stump(spark, folder, "random_forest", {"n_estimators": 3, "max_depth": 1, "bootstrap": False})
    inner = models.inner_model(trained.model)
    forest = partial(intervals.with_forest_bounds, model=inner, leaf=models.LEAF, target_transform="none", **options)
    bounded = intervals.add_interval(scoring.predict(rows, trained), None, forest=forest)
    return rounded(bounded.select("property_id", *scoring.OUTPUTS), 3, *scoring.OUTPUTS)


def forest_interval_stumps(spark, folder):
    return _stump_bounds(spark, folder)


def forest_interval_stumps_joined(spark, folder):
    """The same with the leaves joined, as for a forest of too many to send."""
    return _stump_bounds(spark, folder, leaves_sent=0)


def flat_bounds(spark, folder):
    """Bounds of a model without an interval."""
    return intervals.add_interval(priced_orders(spark, folder).select("property_id", F.col("price").alias("prediction")), None)


def train_job_metadata(spark, folder):
    """What a whole training run records of its rows and features."""
    result = _train(spark, folder, "ridge", {"alpha": 1.0})
    kept = result.trained.metadata
    row = (
        kept["model_key"], kept["target_transform"], kept["train_size"], kept["test_size"], kept["prediction_interval"]["calibration_size"],
        len(kept["feature_names"]), round(result.metrics["cheap_segment_cutoff_p25"], 4),
    )
    schema = "model_key string, target_transform string, train_size long, test_size long, calibration_size long, feature_count long, cutoff double"
    return spark.createDataFrame([row], schema)


def feature_importance(spark, folder):
    trained = _forest(spark, folder)
    return models.feature_importance(spark, trained.model, trained.preprocessor.feature_names)


def model_roundtrip(spark, folder):
    path = new_shared_path(spark, "model")
    model_store.save_model(spark, _train(spark, folder, "ridge", {"alpha": 1.0}).trained, path)
    loaded = model_store.load_model(spark, path)
    return scoring.score_table(listings(spark, folder), loaded).select("property_id", *scoring.OUTPUTS)


def model_roundtrip_one_feature(spark, folder):
    """The second of two saved versions, loaded and applied."""
    path, trained = new_shared_path(spark, "model"), _ridge_one_feature(spark, folder)
    for _ in range(2):
        model_store.save_model(spark, trained, path)
    scored = scoring.predict(listings(spark, folder), model_store.load_model(spark, path, 2))
    return rounded(scored.select("property_id", "prediction"), 2, "prediction")


# Version tables


def list_versions(spark, folder):
    return versions.list_versions(shapes.model_versions(spark, folder))


def resolve_version(spark, folder):
    return versions.latest_versions(shapes.model_versions(spark, folder), "Production")


def production_metric(spark, folder):
    return versions.production_metric(shapes.model_versions(spark, folder), shapes.model_runs(spark, folder))


def _gated(spark, folder):
    metric = versions.run_metric(shapes.model_runs(spark, folder)).withColumnRenamed("metric_value", "candidate_metric")
    candidates = shapes.candidate_runs(spark, folder).join(metric, "run_id", "left")
    return versions.promotion_gate(candidates, production_metric(spark, folder))


def promotion_gate(spark, folder):
    return _gated(spark, folder)


def gate_one_model(spark, folder):
    """Every order is a candidate of one model that has no production version yet."""
    key = F.col("o_orderkey")
    candidates = table(spark, folder, "orders").select(
        F.when(key.isNotNull(), "price").alias("model_name"),
        F.concat(F.lit("run_"), key.cast("string")).alias("run_id"),
        ((key * 7919) % 100003 / F.lit(100003.0)).alias("candidate_metric"),
        key.alias("position"),
    )
    none_held = spark.createDataFrame([], "model_name string, production_metric double")
    return versions.promotion_gate(candidates, none_held)


def register_versions(spark, folder):
    return versions.register_versions(shapes.model_versions(spark, folder), _gated(spark, folder), "Staging")


def _targets(spark, folder):
    return versions.latest_versions(shapes.model_versions(spark, folder), "Staging")


def promote_version(spark, folder):
    return versions.promote_versions(shapes.model_versions(spark, folder), _targets(spark, folder))


def promote_missing_target(spark, folder):
    """Half of the targets name a version that is not there; their models stay as they are."""
    absent = F.when(F.col("version") % 2 == 0, -F.col("version")).otherwise(F.col("version"))
    targets = _targets(spark, folder).withColumn("version", absent)
    return versions.promote_versions(shapes.model_versions(spark, folder), targets, on_missing="keep")


def promote_job(spark, folder):
    return jobs.promote_job(
        shapes.model_versions(spark, folder), shapes.model_runs(spark, folder), shapes.candidate_runs(spark, folder)
    )[1]


def promote_in_store(spark, folder):
    """The committed version table after the same promotion."""
    path = new_shared_path(spark, "versions")
    commits.update_table(spark, path, lambda before: shapes.model_versions(spark, folder))
    jobs.promote_in_store(spark, path, shapes.model_runs(spark, folder), shapes.candidate_runs(spark, folder))
    return commits.read_table(spark, path)


def promote_several_candidates(spark, folder):
    """Two candidates per model, the second against what the first has left; verdicts and new versions."""
    first, (second, metrics) = shapes.candidate_runs(spark, folder), shapes.second_candidates(spark, folder)
    offered = first.withColumn("position", F.lit(1)).unionByName(second.withColumn("position", F.lit(2)))
    runs = shapes.model_runs(spark, folder).unionByName(metrics)
    return jobs.promote_job(shapes.model_versions(spark, folder), runs, offered)[0]


def promote_several_stages(spark, folder):
    """The version table that promote_several_candidates leaves."""
    first, (second, metrics) = shapes.candidate_runs(spark, folder), shapes.second_candidates(spark, folder)
    offered = first.withColumn("position", F.lit(1)).unionByName(second.withColumn("position", F.lit(2)))
    runs = shapes.model_runs(spark, folder).unionByName(metrics)
    return jobs.promote_job(shapes.model_versions(spark, folder), runs, offered)[1]


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        scan_priced, scan_positive_priced, sql_with_params, csv_roundtrip, csv_line_breaks, latest_per_key,
        drop_columns, cast_numeric, exclude_types, outlier_filter, select_contract, clean_rows,
        alias_rename, validate_rows, validate_text_rows, reject_summary, fill_optional, unseen_categories,
        dedup_rows, hash_split, exact_split, centroid_backfill, missing_location,
        price_summary, quantiles, quantiles_by_cuts, histogram, order_stat_higher, order_stat_by_customer,
        order_stat_by_status_by_cuts,
        regression_metrics, regression_metrics_missing, cheap_segment_mae,
        psi, price_psi, price_psi_by_cuts, drift_snapshot, snapshot_roundtrip, psi_vs_snapshot, psi_of_batches,
        drift_verdict, refresh_job, verdict_no_reference, verdict_unknown, psi_guards, snapshot_replaced,
        impute_median, standard_scale, impute_mode, one_hot, one_hot_unseen, one_hot_index, one_hot_index_prefixed, scale_constant, preprocess,
        target_transform, calibrate_interval, calibrate_interval_by_cuts, apply_interval,
        apply_interval_legacy, interval_margin, train_ridge_one_feature, score_table, score_job_csv,
        forest_stump, boosted_stump, stump_importance, leafwise_tree, leafwise_importance,
        train_ridge, train_gradient_boosting, train_hist_gradient_boosting, train_random_forest,
        batch_score, forest_interval, forest_interval_stumps, forest_interval_stumps_joined, flat_bounds, train_job_metadata,
        feature_importance, model_roundtrip, model_roundtrip_one_feature,
        list_versions, resolve_version, production_metric, promotion_gate, gate_one_model, register_versions,
        promote_version, promote_missing_target, promote_job, promote_in_store,
        promote_several_candidates, promote_several_stages,
    )
}
