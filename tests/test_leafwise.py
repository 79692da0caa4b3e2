"""Leaf-wise boosting against a plain version that looks at every split of every leaf."""

from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel
from pyspark.sql import functions as F

from checks import queries
from parcelry.contract import TrainingOptions
from parcelry.operators import leafwise
from parcelry.operators.leafwise import LeafwiseOptions, fit_leafwise
from parcelry.plans import jobs
from parcelry.plans import listings as shapes
from parcelry.session import shared_folder

NAMES = {"featuresCol": "features", "labelCol": "y", "predictionCol": "prediction"}


def brute(x, y, leaves, least, ease, rounds=1, rate=1.0):
    """Predictions after growing each tree one best split at a time over all columns and values."""
    score = np.full(len(y), y.mean())
    for _ in range(rounds):
        slope = score - y
        open_ = [np.arange(len(y))]

        def best(at):
            found = (0.0, -1, 0.0)
            whole = slope[at].sum() ** 2 / (len(at) + ease)
            for f in range(x.shape[1]):
                order = np.argsort(x[at, f], kind="stable")
                v, s = x[at, f][order], np.cumsum(slope[at][order])
                n = np.arange(1, len(at) + 1)
                may = np.flatnonzero((v[1:] > v[:-1]) & (n[:-1] >= least) & (len(at) - n[:-1] >= least))
                gain = s[may] ** 2 / (n[may] + ease) + (s[-1] - s[may]) ** 2 / (len(at) - n[may] + ease) - whole
                if len(gain) and gain.max() > found[0] + 1e-9 * abs(found[0]):
                    k = may[gain.argmax()]
                    found = (gain.max(), f, (v[k] + v[k + 1]) / 2)
            return found

        splits = [best(open_[0])]
        while len(open_) < leaves and max(s[0] for s in splits) > 0:
            i = max(range(len(splits)), key=lambda i: splits[i][0])
            at, (_, f, cut) = open_.pop(i), splits.pop(i)
            for part in (at[x[at, f] <= cut], at[x[at, f] > cut]):
                open_.append(part)
                splits.append(best(part))
        for at in open_:
            score[at] -= rate * slope[at].sum() / (len(at) + ease)
    return score, len(open_)


@pytest.fixture(scope="module")
def table(spark):
    """Listings of sf0.01 in few enough values a column that every value is a bin's end."""
    rows = shapes.listings(spark, "/root/testdata/sf0.01").where("price IS NOT NULL AND living_area IS NOT NULL AND bedrooms IS NOT NULL")
    made = rows.select(
        "property_id",
        F.floor(F.col("living_area") % 200).cast("double").alias("a"),
        F.col("bedrooms").alias("b"),
        (F.col("property_id") % 5).cast("double").alias("k"),
        F.round("price").alias("y"),
    )
    return made.orderBy("property_id").coalesce(4).cache()


def fitted(table, **options):
    made = table.select("*", F.array(*[(F.col("k") == i).cast("double") for i in range(5)]).alias("__one"))
    made = made.select("*", *[F.col("__one")[i].alias(f"k{i}") for i in range(5)])
    vectors = VectorAssembler(inputCols=["a", "b", *[f"k{i}" for i in range(5)]], outputCol="features").transform(made)
    model = fit_leafwise(vectors, ["a", "b"], ["k"], [5], "y", LeafwiseOptions(**options), **NAMES)
    return model, model.transform(vectors).orderBy("property_id").toPandas(), made.orderBy("property_id").toPandas()


@pytest.mark.parametrize("leaves, ease, rounds, rate", [(31, 0.0, 1, 1.0), (4, 5.0, 1, 1.0), (6, 1.0, 3, 0.3)])
def test_trees_equal_the_plain_version(table, leaves, ease, rounds, rate):
    model, scored, made = fitted(table, learning_rate=rate, max_iter=rounds, max_leaf_nodes=leaves, l2_regularization=ease, early_stopping=False)
    x = made[["a", "b", *[f"k{i}" for i in range(5)]]].to_numpy()
    expected, grown = brute(x, made["y"].to_numpy(), leaves, 20, ease, rounds, rate)
    assert grown == leaves and model.getNumTrees == rounds + 1
    assert scored["prediction"].to_numpy() == pytest.approx(expected, rel=1e-9)


def test_rows_scored_anew_change_nothing(table, monkeypatch):
    _, once, _ = fitted(table, max_iter=4, max_leaf_nodes=4)
    monkeypatch.setattr(leafwise, "REWRITE", 1)
    _, again, _ = fitted(table, max_iter=4, max_leaf_nodes=4)
    assert again["prediction"].to_numpy() == pytest.approx(once["prediction"].to_numpy(), rel=1e-12)


def test_rows_sent_and_partial_sums_change_nothing(table, monkeypatch):
    wanted = {"max_iter": 4, "max_leaf_nodes": 9, "min_samples_leaf": 5}
    _, once, _ = fitted(table, **wanted)
    for name, value in (("SENT_ROWS", 0), ("PARTIALS", 0), ("BLOCK_BYTES", 20_000), ("SENT_ROWS", 1 << 30)):
        monkeypatch.setattr(leafwise, name, value)
        _, again, _ = fitted(table, **wanted)
        assert again["prediction"].to_numpy() == pytest.approx(once["prediction"].to_numpy(), rel=1e-9), name


def test_the_next_root_follows_from_the_leaves(table, monkeypatch):
    """Sums and loss taken over from a tree's leaves are those counted anew."""
    after, root = leafwise._Grower.after, leafwise._Blocks.root
    taken, counted = [], []

    def kept(found, to):
        to.append((found.rows, found.sums.copy(), found.aside.copy()))
        return found

    monkeypatch.setattr(leafwise, "REWRITE", 1)
    monkeypatch.setattr(leafwise._Grower, "after", lambda *a: kept(after(*a), taken))
    monkeypatch.setattr(leafwise._Blocks, "root", lambda *a: kept(root(*a), counted))
    fitted(table, max_iter=4, early_stopping=True)
    assert len(taken) == len(counted) == 4
    for (rows, sums, aside), (rows_again, sums_again, aside_again) in zip(taken, counted[1:]):
        assert rows == rows_again and aside_again[0] > 0
        assert sums[0] == pytest.approx(sums_again[0])
        scale = abs(sums_again[1]).max()
        assert sums[1] == pytest.approx(sums_again[1], rel=1e-9, abs=1e-9 * scale)
        assert aside[:3] == pytest.approx(aside_again[:3], rel=1e-9, abs=1e-9 * scale)


def test_many_rounds_take_few_passes_and_leave_no_files(table, spark, monkeypatch):
    passes, own, files = [], leafwise._Blocks.counted, shared_folder(spark)
    monkeypatch.setattr(leafwise._Blocks, "counted", lambda self, *a: passes.append(1) or own(self, *a))
    before = {str(p) for p in Path(files).rglob("*")}
    model, _, _ = fitted(table, max_iter=40, min_samples_leaf=8, learning_rate=0.03, early_stopping=False)
    assert model.getNumTrees == 41
    assert len(passes) <= 40 * 6
    left = [p for p in map(str, Path(files).rglob("part-*")) if p not in before]
    assert left == []


def test_the_training_query_runs_the_shipped_rounds(spark, monkeypatch):
    class Seen(Exception):
        pass

    def seen(spark, rows, options):
        raise Seen(options)

    monkeypatch.setattr(jobs, "train_job", seen)
    with pytest.raises(Seen) as found:
        queries.train_hist_gradient_boosting(spark, "/root/testdata/sf0.001")
    options, shipped = found.value.args[0], TrainingOptions()
    assert options.hyperparameters == shipped.hyperparameters == {"learning_rate": 0.03, "max_iter": 1200, "min_samples_leaf": 8}
    assert options.model_type == shipped.model_type


def test_an_unknown_category_goes_with_the_others(spark):
    rows = [(float(i), k, y) for i in range(30) for k, y in ((0, 1.0), (1, 6.0), (2, 9.0), (None, 1.0))]
    df = spark.createDataFrame(rows, "a double, k int, y double")
    made = df.select("a", "k", "y", *[F.when(F.col("k") == i, 1.0).otherwise(0.0).alias(f"k{i}") for i in range(2)])
    vectors = VectorAssembler(inputCols=["a", "k0", "k1"], outputCol="features").transform(made)
    options = LeafwiseOptions(learning_rate=1.0, max_iter=1, max_leaf_nodes=3, min_samples_leaf=5)
    model = fit_leafwise(vectors, ["a"], ["k"], [2], "y", options, **NAMES)
    found = {r["k"]: r["prediction"] for r in model.transform(vectors).collect()}
    assert found == pytest.approx({0: 1.0, 1: 6.0, 2: 5.0, None: 5.0})


def test_depth_bins_and_saved_form(table, tmp_path):
    model, scored, _ = fitted(table, max_iter=1, max_depth=2, max_bins=8, early_stopping=False)
    assert scored["prediction"].nunique() <= 4 and max(t.depth for t in model.trees) == 2
    model.save(str(tmp_path / "model"))
    assert GBTRegressionModel.load(str(tmp_path / "model")).featureImportances == model.featureImportances
    assert sum(model.featureImportances.toArray()) == pytest.approx(1.0)


def test_bins_end_at_quantiles_of_many_values(spark):
    df = spark.range(1000).select((F.col("id") * 1.0).alias("a"), F.lit(3.0).alias("same"))
    many, none = leafwise.find_edges(df, ["a", "same"], 4)
    assert many == [249.75, 499.5, 749.25] and none == []


def test_nothing_to_split_is_the_mean(spark):
    df = spark.createDataFrame([(1.0, 0.0, 2.0), (1.0, 0.0, 4.0)], "a double, k double, y double")
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    model = fit_leafwise(vectors, ["a"], [], [], "y", LeafwiseOptions(min_samples_leaf=1), **NAMES)
    assert [r["prediction"] for r in model.transform(vectors).collect()] == [3.0, 3.0]
    with pytest.raises(ValueError, match="label"):
        fit_leafwise(vectors.limit(0), ["a"], [], [], "y", LeafwiseOptions(), **NAMES)


def test_early_stopping_ends_on_noise(spark):
    df = spark.range(2000).select((F.col("id") % 50 * 1.0).alias("a"), (F.col("id") * 7919 % 101 * 1.0).alias("y"))
    vectors = VectorAssembler(inputCols=["a"], outputCol="features").transform(df)
    options = LeafwiseOptions(max_iter=12, max_leaf_nodes=4, early_stopping=True, n_iter_no_change=2, tol=5.0)
    assert fit_leafwise(vectors, ["a"], [], [], "y", options, **NAMES).getNumTrees < 13


@pytest.mark.parametrize("bad", [{"max_leaf_nodes": 1}, {"max_bins": 1}, {"learning_rate": 0}, {"l2_regularization": -1}])
def test_options_are_checked(bad):
    with pytest.raises(ValueError):
        LeafwiseOptions(**bad)
