"""Model version tables: resolve, gate, register and promote, for all models at once.

model_versions(model_name, version, run_id, stage) holds one row per version;
model_runs(run_id, metric_name, metric_value[, step]) what runs have logged; of several values for a run and
metric the latest step counts, the largest where steps are equal or not given.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelry.functions.columns import without_nan
from parcelry.operators.joins import lookup_join
from parcelry.session import new_shared_path

# Stages, the gate's metric and its threshold.
STAGES = ("Staging", "Production", "Archived")
PRODUCTION = "Production"
METRIC = "test_r2"
IMPROVEMENT = 0.02
#: Candidates of one model that a task gates at most; those of a larger model are dealt to blocks of about as many.
BLOCK_ROWS = 250_000
_QUEUE = ("model_name", "position", "run_id", "candidate_metric")


def _number() -> Column:
    return F.col("version").cast("bigint")


def list_versions(versions: DataFrame, model_name: str | None = None) -> DataFrame:
    """Versions in numeric order, of one model or of all."""
    rows = versions if model_name is None else versions.filter(F.col("model_name") == model_name)
    return rows.withColumn("version", _number()).orderBy("model_name", "version")


def latest_versions(versions: DataFrame, stage: str | None = None) -> DataFrame:
    """Highest version of every model, at one stage or at any."""
    rows = versions if stage is None else versions.filter(F.col("stage") == stage)
    return rows.groupBy("model_name").agg(F.max(_number()).alias("version"))


def resolve_version(
    versions: DataFrame, model_name: str, version: int | str | None = None, stage: str | None = None
) -> int:
    """The version asked for, else the highest at the stage; none is an error."""
    if version:
        return int(version)
    found = latest_versions(versions.filter(F.col("model_name") == model_name), stage).first()
    if found is None:
        at = f" in stage '{stage}'" if stage else ""
        raise ValueError(f"Model '{model_name}' has no version{at}; register one or name the version wanted")
    return found["version"]


def run_metric(runs: DataFrame, metric_name: str = METRIC) -> DataFrame:
    """(run_id, metric_value) with one row per run that has logged the metric."""
    step = F.col("step") if "step" in runs.columns else F.lit(0)
    logged = runs.filter((F.col("metric_name") == metric_name) & F.col("metric_value").isNotNull())
    last = logged.groupBy("run_id").agg(F.max(F.struct(step.alias("step"), "metric_value")).alias("m"))
    return last.select("run_id", F.col("m.metric_value").alias("metric_value"))


def production_metric(versions: DataFrame, runs: DataFrame, metric_name: str = METRIC) -> DataFrame:
    """Metric of each model's newest Production version; NULL when its run lacks it."""
    held = versions.filter(F.col("stage") == PRODUCTION).groupBy("model_name")
    newest = held.agg(F.max(F.struct(_number().alias("version"), "run_id")).alias("v"))
    metric = run_metric(runs, metric_name).withColumnRenamed("metric_value", "production_metric")
    return newest.select("model_name", "v.version", "v.run_id").join(metric, "run_id", "left").select(
        "model_name", "version", "run_id", "production_metric"
    )


def promotion_gate(
    candidates: DataFrame, production: DataFrame, threshold: float = IMPROVEMENT, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """Which candidates (model_name, run_id, candidate_metric[, position]) may replace production.

    Candidates of a model are gated one after another in order of position, then run_id; each that
    passes is the production the next one must beat. The gain must exceed the threshold. A model
    without a Production version takes any candidate, even one without the metric; where there is one,
    a candidate without the metric does not pass, and a production without it yields to
    any candidate that has it. `reason` says which case applied. production has one row per
    Production version held, as production_metric gives it.

    A NaN metric counts as missing. The candidates of a model stream through one task in sorted order, which holds
    the current metric alone. Where a model has over block_rows, all candidates are stored in sorted blocks in the shared
    folder, _begins finds the metric that each block begins with, and the blocks are gated side by side.
    """
    place = F.col("position") if "position" in candidates.columns else F.lit(0)
    offered = candidates.select(
        "model_name", place.alias("position"), F.col("run_id").cast("string").alias("run_id"),
        without_nan(F.col("candidate_metric").cast("double")).alias("candidate_metric"),
    )
    known = without_nan(F.col("production_metric").cast("double")).alias("production_metric")
    lookup = production.select("model_name", known, F.lit(True).alias("held"))
    named_type = candidates.schema["model_name"].dataType.simpleString()
    schema = f"model_name {named_type}, run_id string, candidate_metric double, production_metric double, held boolean, passed boolean"
    sizes = offered.groupBy("model_name").count().agg(F.max("count").alias("most"), F.sum("count").alias("all")).first()
    if (sizes["most"] or 0) <= block_rows:
        queue = lookup_join(offered, lookup, "model_name", known_unique=True)
        queue = queue.repartition("model_name").sortWithinPartitions(*_QUEUE)
        gated = queue.drop("position").mapInArrow(_gate(threshold), schema)
    else:
        blocks = _in_blocks(offered, lookup, math.ceil(sizes["all"] / block_rows))
        begins = _begins(blocks, threshold)
        gated = _sorted_blocks(blocks).mapInArrow(_gate(threshold, begins), schema)
    reason = (
        F.when(~F.col("held"), "no production version")
        .when(F.col("candidate_metric").isNull(), "candidate lacks the metric")
        .when(F.col("production_metric").isNull(), "production lacks the metric")
        .when(F.col("passed"), "gain above the threshold")
        .otherwise("gain not above the threshold")
    )
    return gated.select("model_name", "run_id", "candidate_metric", "production_metric", "passed", reason.alias("reason"))


def _in_blocks(offered: DataFrame, lookup: DataFrame, n: int) -> DataFrame:
    """The candidates stored with the number of their block, n ranges of the order in which they are gated, and what the lookup has.

    The lookup meets the models of each block, not their candidates, so that those of a large model stay spread.
    """
    spark = offered.sparkSession
    path = new_shared_path(spark, "candidates")
    offered.repartitionByRange(n, *_QUEUE).withColumn("block", F.spark_partition_id()).write.parquet(path)
    blocks = spark.read.parquet(path)
    models = lookup_join(blocks.select("model_name", "block").distinct(), lookup, "model_name", known_unique=True)
    models.write.parquet(f"{path}-models")
    return blocks.join(spark.read.parquet(f"{path}-models"), ["block", "model_name"], "left")


def _sorted_blocks(blocks: DataFrame, n: int | None = None) -> DataFrame:
    """Whole blocks in order, a few a task: as many tasks as blocks, so that a task does not grow with the table."""
    n = n or blocks.agg(F.max("block")).first()[0] + 1
    return blocks.repartition(n, "block").sortWithinPartitions("block", *_QUEUE).drop("position")


def _begins(blocks: DataFrame, threshold: float) -> dict[int, tuple[float | None, bool]]:
    """(metric, held) at the first row of each block that goes on with the model of the block before.

    A block without an offer that gains over what it begins with ends as it begins; its best offer shows that. The others are run,
    many in one job: where a block must wait for the one before, its begin is guessed, from the best offers so far or an earlier run,
    and only blocks that have been guessed wrong run again. Each job settles at least the first of them. The driver
    holds a row a block.
    """
    first, last = (f(F.struct("model_name")).alias(n) for f, n in ((F.min, "first"), (F.max, "last")))
    facts = [F.max(c).alias(n) for c, n in (("candidate_metric", "best"), ("production_metric", "given"), ("held", "held"))]
    about = blocks.groupBy("block").agg(first, last, *facts).orderBy("block").collect()
    known, ended = {}, {}
    while True:
        begins, asked, state = {}, {}, None
        for i, row in enumerate(about):
            block, whole = row["block"], row["first"] == row["last"]
            if i and about[i - 1]["last"] == row["first"]:
                begins[block] = state
            if i + 1 == len(about) or about[i + 1]["first"] != row["last"]:
                continue  # no model goes on from here
            begin = begins.get(block, (row["given"], bool(row["held"]))) if whole else None
            if (block, begin) in known:
                state = known[block, begin]
            elif whole and begin[1] and not _gains(row["best"], begin[0], threshold):
                state = begin
            else:
                asked[block] = begin
                offers = [m for m in (row["best"], begin[0] if whole else None) if m is not None]
                state = ended.get(block, (max(offers, default=None), True))
        if not asked:
            return begins
        runs = {b: begins[b] for b in asked if b in begins}
        run = _sorted_blocks(blocks.where(F.col("block").isin(list(asked))), len(asked))
        for r in run.mapInArrow(_gate(threshold, runs, only_ends=True), "block int, metric double, held boolean").collect():
            ended[r["block"]] = known[r["block"], asked[r["block"]]] = (r["metric"], r["held"])


def _gains(offer: float | None, metric: float | None, threshold: float) -> bool:
    return offer is not None and (metric is None or offer - metric > threshold)


def _gate(threshold: float, begins: dict | None = None, only_ends: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row with the production metric it met; rows of a model come one after another.

    With `begins` rows come in whole blocks, whose first model goes on from the (metric, held) given for it; only_ends
    gives (block, metric, held) after each block instead of the rows. A closure travels to the workers whole, so they need not find this package.
    """

    def gate(batches):
        model, metric, held, begun, block = None, None, False, False, None
        for batch in batches:
            numbers = repeat(None) if begins is None else batch.column("block").to_pylist()
            rows = zip(numbers, *[batch.column(c).to_pylist() for c in ("model_name", "candidate_metric", "production_metric", "held")])
            met, was_held, passes, ends = [], [], [], []
            for number, name, offer, given, there in rows:
                if not begun or number != block or name != model:
                    if begun and number != block:
                        ends.append((block, metric, held))
                    goes_on = begins is not None and number in begins and (not begun or number != block)
                    metric, held = begins[number] if goes_on else (given, bool(there))
                    begun, block, model = True, number, name
                gains = offer is not None and (metric is None or offer - metric > threshold)
                passed = gains or not held
                met.append(metric)
                was_held.append(held)
                passes.append(passed)
                if passed:
                    metric, held = offer, True
            if only_ends:
                yield from closed(ends)
                continue
            columns = [batch.column(c) for c in ("model_name", "run_id", "candidate_metric")]
            columns += [pa.array(met, pa.float64()), pa.array(was_held, pa.bool_()), pa.array(passes, pa.bool_())]
            yield pa.record_batch(columns, names=["model_name", "run_id", "candidate_metric", "production_metric", "held", "passed"])
        if only_ends and begun:
            yield from closed([(block, metric, held)])

    def closed(ends):
        if ends:
            columns = [pa.array(c, t) for c, t in zip(zip(*ends), (pa.int32(), pa.float64(), pa.bool_()))]
            yield pa.record_batch(columns, names=["block", "metric", "held"])

    return gate


def _counted() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each row with its turn, from 1, among the rows of its model, which come one after another."""

    def count(batches):
        model, turn = None, 0
        for batch in batches:
            turns = []
            for name in batch.column("model_name").to_pylist():
                turn = turn + 1 if turn and name == model else 1
                model = name
                turns.append(turn)
            yield pa.record_batch([*batch.columns, pa.array(turns, pa.int64())], names=["model_name", "run_id", "turn"])

    return count


def register_versions(versions: DataFrame, gated: DataFrame, stage: str | None = None) -> DataFrame:
    """A row with the next version numbers for every candidate that passed, in the order it was gated.

    gated holds a model's candidates as promotion_gate gives them: each later one has beaten the one
    before, so their metrics rise and order them; one without a metric comes first. They are counted
    as they stream by, so a model with many holds none of them in memory.
    """
    passed = gated.filter("passed").select("model_name", "run_id", "candidate_metric").repartition("model_name")
    passed = passed.sortWithinPartitions("model_name", F.col("candidate_metric").asc_nulls_first(), "run_id")
    named_type, run_type = (passed.schema[c].dataType.simpleString() for c in ("model_name", "run_id"))
    turns = passed.drop("candidate_metric").mapInArrow(_counted(), f"model_name {named_type}, run_id {run_type}, turn bigint")
    last = latest_versions(versions).withColumnRenamed("version", "last_version")
    return turns.join(last, "model_name", "left").select(
        "model_name",
        (F.coalesce("last_version", F.lit(0)) + F.col("turn")).cast("bigint").alias("version"),
        "run_id",
        F.lit(stage).cast("string").alias("stage"),
    )


def missing_targets(versions: DataFrame, targets: DataFrame) -> DataFrame:
    """Targets (model_name, version) that the version table does not hold."""
    there = versions.select("model_name", _number().alias("version"))
    return targets.select("model_name", _number().alias("version")).join(there, ["model_name", "version"], "left_anti")


def promote_versions(
    versions: DataFrame, targets: DataFrame, stage: str = PRODUCTION, on_missing: str = "error"
) -> DataFrame:
    """The version table after moving one target (model_name, version) per model to a stage.

    Moving to Production archives the versions that held it. A target that the table does not hold fails
    before anything moves, or with on_missing="keep" leaves its model as it is.
    """
    if stage not in STAGES:
        raise ValueError(f"Stage '{stage}' is none of {', '.join(STAGES)}; name one of them")
    if on_missing not in ("error", "keep"):
        raise ValueError("on_missing is 'error' or 'keep'")
    columns = versions.columns
    wanted = targets.select("model_name", _number().alias("version"))
    if on_missing == "error":
        lost = missing_targets(versions, wanted).first()
        if lost is not None:
            raise ValueError(f"Version {lost['version']} of model '{lost['model_name']}' is not in the version table; nothing was promoted")
    else:
        there = versions.select("model_name", _number().alias("version"))
        wanted = wanted.join(there, ["model_name", "version"], "left_semi")
    joined = lookup_join(versions, wanted.withColumnRenamed("version", "__target"), "model_name")
    moved = F.when(_number() == F.col("__target"), F.lit(stage))
    if stage == PRODUCTION:
        replaced = F.col("__target").isNotNull() & (F.col("stage") == PRODUCTION)
        moved = moved.when(replaced, F.lit("Archived"))
    return joined.withColumn("stage", moved.otherwise(F.col("stage"))).select(*columns)
