import pytest
from pyspark.sql import functions as F

from parcelry.operators import versions
from parcelry.plans import jobs

SCHEMA = "model_name string, version string, run_id string, stage string"
RUNS = "run_id string, metric_name string, metric_value double"


@pytest.fixture(scope="module")
def table(spark):
    rows = [
        ("a", "1", "r1", "Staging"), ("a", "2", "r2", "Production"), ("a", "3", "r3", "Production"),
        ("b", "9", "r9", "Staging"), ("b", "10", "r10", "Staging"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame([("r3", "test_r2", 0.91), ("r3", "test_mae", 5.0), ("c1", "test_r2", 0.90)], RUNS)


def test_versions_sort_as_numbers(table):
    assert [r["version"] for r in versions.list_versions(table, "b").collect()] == [9, 10]
    assert versions.list_versions(table, "none").isEmpty()


def test_resolving_a_version(table):
    assert versions.resolve_version(table, "a", stage="Production") == 3
    assert versions.resolve_version(table, "b") == 10
    assert versions.resolve_version(table, "a", version="1") == 1
    with pytest.raises(ValueError, match="stage 'Production'"):
        versions.resolve_version(table, "b", stage="Production")
    with pytest.raises(ValueError, match="'none'"):
        versions.resolve_version(table, "none")


def test_worse_candidate_is_neither_registered_nor_promoted(spark, table, runs):
    candidates = spark.createDataFrame([("a", "c1")], "model_name string, run_id string")
    verdicts, after = jobs.promote_job(table, runs, candidates)
    row = verdicts.first()
    assert (row["passed"], row["version"], row["production_metric"]) == (False, None, 0.91)
    assert after.count() == 5


@pytest.mark.parametrize(
    "production, candidate, passed",
    [(0.25, 0.5, False), (0.25, 0.5001, True), (None, 0.1, True), (0.25, None, False), (None, None, False)],
)
def test_gate_is_strict(spark, production, candidate, passed):
    held = spark.createDataFrame([("a", production)], "model_name string, production_metric double")
    cand = spark.createDataFrame([("a", "c", candidate)], "model_name string, run_id string, candidate_metric double")
    assert versions.promotion_gate(cand, held, threshold=0.25).first()["passed"] is passed


def test_without_a_production_version_any_candidate_passes(spark):
    held = spark.createDataFrame([], "model_name string, production_metric double")
    cand = spark.createDataFrame([("a", "c", None), ("a", "d", None), ("a", "e", 0.1)], "model_name string, run_id string, candidate_metric double")
    found = {r["run_id"]: (r["passed"], r["reason"]) for r in versions.promotion_gate(cand, held).collect()}
    assert found == {
        "c": (True, "no production version"), "d": (False, "candidate lacks the metric"), "e": (True, "production lacks the metric"),
    }


def test_candidates_are_gated_in_order(spark):
    held = spark.createDataFrame([("a", 0.5)], "model_name string, production_metric double")
    cand = spark.createDataFrame(
        [("a", "x", 0.9, 1), ("a", "y", 0.8, 2), ("a", "w", 0.95, 3)], "model_name string, run_id string, candidate_metric double, position int"
    )
    found = {r["run_id"]: (r["passed"], r["production_metric"]) for r in versions.promotion_gate(cand, held).collect()}
    assert found == {"x": (True, 0.5), "y": (False, 0.9), "w": (True, 0.9)}


def test_several_candidates_end_in_one_production(spark, table, runs):
    more = runs.union(spark.createDataFrame([("c2", "test_r2", 0.95), ("c3", "test_r2", 0.99)], RUNS))
    candidates = spark.createDataFrame([("a", "c2", 1), ("a", "c3", 2)], "model_name string, run_id string, position int")
    verdicts, after = jobs.promote_job(table, more, candidates)
    assert {(r["run_id"], r["passed"], r["version"]) for r in verdicts.collect()} == {("c2", True, 4), ("c3", True, 5)}
    assert {int(r["version"]): r["stage"] for r in after.filter("model_name = 'a'").collect()} == {
        1: "Staging", 2: "Archived", 3: "Archived", 4: "Archived", 5: "Production",
    }


def test_one_metric_per_run(spark, table):
    twice = spark.createDataFrame([("r3", "test_r2", 0.5, 1), ("r3", "test_r2", 0.4, 2), ("r3", "test_r2", None, 3)], RUNS + ", step int")
    assert [r["production_metric"] for r in versions.production_metric(table, twice).filter("model_name = 'a'").collect()] == [0.4]
    assert versions.run_metric(twice.drop("step")).collect() == [("r3", 0.5)]


def test_a_missing_target_moves_nothing(spark, table):
    target = spark.createDataFrame([("a", 9)], "model_name string, version long")
    with pytest.raises(ValueError, match="nothing was promoted"):
        versions.promote_versions(table, target)
    kept = versions.promote_versions(table, target, on_missing="keep")
    assert sorted(kept.collect()) == sorted(table.collect())


def test_promotion_registers_the_next_version_and_archives_the_holder(spark, table, runs):
    more = runs.union(spark.createDataFrame([("c2", "test_r2", 0.95), ("c3", "test_r2", 0.1)], RUNS))
    candidates = spark.createDataFrame([("a", "c2"), ("b", "c3"), ("new", "c4")], "model_name string, run_id string")
    verdicts, after = jobs.promote_job(table, more, candidates)
    assert {(r["model_name"], r["passed"], r["version"]) for r in verdicts.collect()} == {
        ("a", True, 4), ("b", True, 11), ("new", True, 1),
    }
    stages = {(r["model_name"], int(r["version"])): r["stage"] for r in after.collect()}
    assert stages == {
        ("a", 1): "Staging", ("a", 2): "Archived", ("a", 3): "Archived", ("a", 4): "Production",
        ("b", 9): "Staging", ("b", 10): "Staging", ("b", 11): "Production", ("new", 1): "Production",
    }


def test_only_production_archives(spark, table):
    target = spark.createDataFrame([("a", 1)], "model_name string, version long")
    moved = versions.promote_versions(table, target, "Archived")
    assert {(r["model_name"], r["version"]): r["stage"] for r in moved.collect()}[("a", "3")] == "Production"
    with pytest.raises(ValueError, match="none of"):
        versions.promote_versions(table, target, "Live")


def test_many_candidates_of_one_model_are_gated_in_one_pass(spark):
    rows = [("m", f"r{i:06d}", None if i % 101 == 0 else float("nan") if i % 103 == 0 else (i * 7919 % 100003) / 100003 + i / 1e5, i) for i in range(100_000)]
    rows += [(None, "x", 0.5, 1), (None, "y", 0.6, 2), ("held", "z", 0.5, 1)]
    candidates = spark.createDataFrame(rows, "model_name string, run_id string, candidate_metric double, position int").repartition(7)
    production = spark.createDataFrame([("held", 0.49)], "model_name string, production_metric double")
    gated = versions.promotion_gate(candidates, production)
    plan = gated._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan
    found = {(r["model_name"], r["run_id"]): (r["production_metric"], r["passed"]) for r in gated.collect()}
    assert len(found) == len(rows)
    now = {"held": (0.49,)}
    for name, run, metric, _ in rows:
        metric = None if metric is None or metric != metric else metric
        held = now.get(name)
        passed = held is None or metric is not None and (held[0] is None or metric - held[0] > versions.IMPROVEMENT)
        assert found[name, run] == (held[0] if held else None, passed)
        if passed:
            now[name] = (metric,)


def _gated_plainly(rows, held, threshold):
    """Candidates one at a time: {run_id: (production_metric, held, passed)}."""
    now, out = dict(held), {}
    for name, position, run, offer in sorted(rows, key=lambda r: (r[0] is not None, r[0] or "", r[1], r[2])):
        there, metric = name in now, now.get(name)
        passed = not there or (offer is not None and (metric is None or offer - metric > threshold))
        out[run] = (metric, passed)
        if passed:
            now[name] = offer
    return out


@pytest.mark.parametrize("threshold", [0.02, 0.0, -0.05])
@pytest.mark.parametrize("order", ["mixed", "rising"])
def test_a_large_model_is_gated_in_blocks_side_by_side(spark, threshold, order):
    rows = []
    for name, n in (("big", 400), ("held", 260), (None, 90), ("small", 5), ("unmeasured", 120)):
        for i in range(n):
            offer = i / n if order == "rising" else (i * 7919 % 1009) / 1009
            rows.append((name, i, f"{name}_{i:04d}", None if i % 13 == 0 or name == "unmeasured" else offer))
    candidates = spark.createDataFrame(rows, "model_name string, position int, run_id string, candidate_metric double").repartition(4)
    held = {"held": 0.4, "unmeasured": None}
    production = spark.createDataFrame(list(held.items()), "model_name string, production_metric double")
    gated = versions.promotion_gate(candidates, production, threshold, block_rows=25)
    found = gated.withColumn("task", F.spark_partition_id()).collect()
    assert {r["run_id"]: (r["production_metric"], r["passed"]) for r in found} == _gated_plainly(rows, held, threshold)
    assert len(found) == len(rows)
    assert len({r["task"] for r in found if r["model_name"] == "big"}) > 4
