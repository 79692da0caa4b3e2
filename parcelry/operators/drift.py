"""Distribution drift of a price column: histograms, PSI, snapshots and the verdict."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.contract import SNAPSHOT_DATE, TARGET
from parcelry.functions.columns import clip, named, with_bucket, without_nan
from parcelry.operators.order_stats import GAP_ROWS, Wanted, linear_grid, order_statistics

# PSI levels, the share standing in for an empty bucket, and the smallest sample.
BINS = 10
MODERATE = 0.01
HIGH = 0.02
EMPTY_SHARE = 1e-6
MIN_ROWS = 10

# The reasons a verdict gives.
FIRST_RUN = (
    "No reference snapshot exists. Current data saved as the new reference. "
    "Retraining skipped on this first run."
)
NOT_COMPUTED = "PSI could not be computed. Retraining skipped as a safety measure."
STEADY = "No significant drift (PSI={psi}). Retraining skipped."
DRIFTED = "{level} drift (PSI={psi}). Retraining {action} (threshold={threshold})."

SNAPSHOT_SCHEMA = (
    "snapshot_date string, row_count bigint, bins int, price_median double, price_mean double, "
    "price_std double, price_log_bin_edges array<double>, price_log_ref_pct array<double>, "
    "price_raw_quantiles array<double>"
)


def distinct_edges(values: Sequence[float]) -> list[float]:
    return sorted(set(values))


def histogram(df: DataFrame, x: Column, edges: Sequence[float]) -> DataFrame:
    """(bucket, rows) over the edges, empty buckets included, values outside ignored.

    The counts that are broadcast hold one row per bucket at most.
    """
    buckets = len(edges) - 1
    found = with_bucket(df.select(x.alias("x")), "x", edges)
    counted = found.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(F.count(F.lit(1)).alias("rows"))
    every = df.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    return every.join(F.broadcast(counted), "bucket", "left").select(
        "bucket", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
    )


def _bucket_counts(sides: DataFrame, edges: Sequence[float]) -> DataFrame:
    """One row: per-bucket counts of both sides as arrays, and the rows of each side.

    sides has (x, is_reference). Counts combine per task, so at most one row per bucket
    leaves a task.
    """
    buckets = len(edges) - 1
    counted = (
        with_bucket(sides, "x", edges)
        .groupBy("bucket")
        .agg(
            F.count(F.when(F.col("is_reference"), F.col("x"))).alias("reference"),
            F.count(F.when(~F.col("is_reference"), F.col("x"))).alias("current"),
        )
    )
    per_bucket = {
        side: [
            F.coalesce(F.sum(F.when(F.col("bucket") == i, F.col(side))), F.lit(0)) for i in range(buckets)
        ]
        for side in ("reference", "current")
    }
    return counted.agg(
        F.array(*per_bucket["reference"]).alias("reference"),
        F.array(*per_bucket["current"]).alias("current"),
        F.coalesce(F.sum("reference"), F.lit(0)).alias("reference_rows"),
        F.coalesce(F.sum("current"), F.lit(0)).alias("current_rows"),
    )


def _shares(counts: Column) -> Column:
    """Counts as shares of their sum; a zero count becomes the stand-in share."""
    total = F.aggregate(counts, F.lit(0).cast("bigint"), lambda a, c: a + c)
    return F.transform(counts, lambda c: F.when(c == 0, F.lit(EMPTY_SHARE)).otherwise(c / total))


def _psi(reference: Column, current: Column) -> Column:
    """Sum over buckets of (r - c) ln(r / c), in bucket order."""
    terms = F.zip_with(reference, current, lambda r, c: (r - c) * F.ln(r / c))
    return F.aggregate(terms, F.lit(0.0), lambda a, t: a + t)


def psi(
    reference: DataFrame, current: DataFrame, x: Column, bins: int = BINS, gap_rows: int = GAP_ROWS
) -> DataFrame:
    """One row: psi of x between two tables, with edges from the reference quantiles.

    Values of current outside the edges are left out. psi is NULL for fewer than ten values
    on a side, a constant reference, or fewer than three distinct edges.
    """
    stats = order_statistics(reference, {"x": Wanted(x, linear_grid(bins))}, gap_rows=gap_rows)
    edges = distinct_edges(stats.values["x"] or [])
    usable = stats.counts["x"] >= MIN_ROWS and len(edges) >= 3
    if not usable:
        nothing = F.lit(None).cast("double").alias("psi")
        present = F.count(without_nan(x.cast("double"))).alias("current_rows")
        return current.agg(present).select(
            nothing, F.lit(stats.counts["x"]).cast("bigint").alias("reference_rows"), "current_rows"
        )
    value = without_nan(x.cast("double")).alias("x")
    sides = reference.select(value, F.lit(True).alias("is_reference")).unionAll(
        current.select(value, F.lit(False).alias("is_reference"))
    )
    counts = _bucket_counts(sides, edges)
    score = _psi(_shares(F.col("reference")), _shares(F.col("current")))
    enough = F.col("current_rows") >= MIN_ROWS
    return counts.select(F.when(enough, score).alias("psi"), "reference_rows", "current_rows")


def price_psi(
    reference: DataFrame, current: DataFrame, price: str = TARGET, bins: int = BINS, gap_rows: int = GAP_ROWS
) -> DataFrame:
    """psi on log1p of the price."""
    return psi(reference, current, F.log1p(named(price)), bins, gap_rows)


def latest_date(df: DataFrame) -> Column:
    """Newest snapshot date as text, or "unknown" without such a column."""
    if SNAPSHOT_DATE not in df.columns:
        return F.lit("unknown")
    return F.date_format(F.max(F.to_date(F.col(SNAPSHOT_DATE))), "yyyy-MM-dd")


def price_summary(df: DataFrame) -> DataFrame:
    """One row: row count of the whole table, mean, sample deviation, median, newest date."""
    price = without_nan(F.col(TARGET).cast("double"))
    also = {"n": F.count(F.lit(1)), "mean": F.avg(price), "std": F.stddev_samp(price), "date": latest_date(df)}
    stats = order_statistics(df, {"price": Wanted(F.col(TARGET), (0.5,))}, also)
    row = (
        stats.also["date"],
        stats.also["n"],
        stats.also["mean"],
        stats.also["std"],
        stats.values["price"][0] if stats.values["price"] else None,
    )
    schema = "snapshot_date string, row_count bigint, price_mean double, price_std double, price_median double"
    return df.sparkSession.createDataFrame([row], schema)


def _log1p(spark: SparkSession, values: list[float]) -> list[float]:
    """log1p as Spark computes it, so that edges agree with rows to the last bit.

    log1p keeps order, so the values at the ranks of a price give those of its logarithm.
    """
    return list(spark.range(1).select(F.transform(F.array(*[F.lit(v) for v in values]), F.log1p)).first()[0])


def take_snapshot(df: DataFrame, bins: int = BINS) -> dict:
    """Summary of the prices that later checks compare against."""
    if TARGET not in df.columns:
        raise ValueError(f"The drift check needs the column '{TARGET}'; the table has {df.columns}")
    price = without_nan(F.col(TARGET).cast("double"))
    wanted = Wanted(price, linear_grid(bins) + (0.5,))
    stats = order_statistics(
        df,
        {"price": wanted},
        {"n": F.count(F.lit(1)), "mean": F.avg(price), "std": F.stddev_samp(price), "date": latest_date(df), "lowest": F.min(price)},
    )
    n, by_rank = stats.counts["price"], stats.by_rank["price"]
    lowest = stats.also["lowest"]
    if lowest is not None and lowest <= -1:
        raise ValueError(f"A price of {lowest} has no log1p; take_snapshot needs prices above -1, so drop such rows first")
    if not n:
        raise ValueError(f"take_snapshot found no value in '{TARGET}'; pass rows with prices")
    *raw, median = stats.values["price"]
    log_by_rank = dict(zip(by_rank, _log1p(df.sparkSession, list(by_rank.values()))))
    edges = distinct_edges([wanted.value(n, q, log_by_rank) for q in linear_grid(bins)])
    if len(edges) > 1:
        found = with_bucket(df.select(F.log1p(price).alias("x")), "x", edges).groupBy("bucket").count()
        by_bucket = {r["bucket"]: r["count"] for r in found.collect()}
        counts = [by_bucket.get(i, 0) for i in range(len(edges) - 1)]
    else:
        counts = []
    total = sum(counts)
    return {
        "snapshot_date": stats.also["date"],
        "row_count": stats.also["n"],
        "bins": bins,
        "price_median": median,
        "price_mean": stats.also["mean"],
        "price_std": stats.also["std"],
        "price_log_bin_edges": edges,
        "price_log_ref_pct": [c / total for c in counts],
        "price_raw_quantiles": raw,
    }


def snapshot_frame(spark: SparkSession, snapshot: dict) -> DataFrame:
    names = [part.split()[0] for part in SNAPSHOT_SCHEMA.split(", ")]
    return spark.createDataFrame([tuple(snapshot[n] for n in names)], SNAPSHOT_SCHEMA)


def psi_vs_snapshot(df: DataFrame, snapshot: dict) -> DataFrame:
    """One row: psi of the prices against a stored snapshot. Values beyond the stored edges
    count in the outer buckets. NULL when the snapshot has no usable edges.
    """
    edges, shares = snapshot.get("price_log_bin_edges"), snapshot.get("price_log_ref_pct")
    price = without_nan(F.col(TARGET).cast("double"))
    if not edges or not shares or len(edges) < 3:
        return df.agg(F.count(price).alias("current_rows")).select(
            F.lit(None).cast("double").alias("psi"), "current_rows"
        )
    x = F.log1p(price)
    sides = df.select(x.alias("x")).select(
        clip(F.col("x"), edges[0], edges[-1]).alias("x"), F.lit(False).alias("is_reference")
    )
    stored = F.array(*[F.lit(EMPTY_SHARE if s == 0 else s) for s in shares])
    return _bucket_counts(sides, edges).select(
        _psi(stored, _shares(F.col("current"))).alias("psi"), "current_rows"
    )


def snapshot_counts(df: DataFrame, snapshot: dict) -> dict:
    """What a later check needs of these rows: their number with a price, and per bucket of the snapshot's edges.

    Counts over the same edges add up, so batches counted one by one give what a scan of all would.
    """
    edges = snapshot.get("price_log_bin_edges") or []
    price = without_nan(F.col(TARGET).cast("double"))
    if len(edges) < 3:
        return {"rows": df.agg(F.count(price)).first()[0], "buckets": []}
    clipped = df.select(clip(F.log1p(price), edges[0], edges[-1]).alias("x"), F.lit(False).alias("is_reference"))
    found = _bucket_counts(clipped, edges).first()
    return {"rows": found["current_rows"], "buckets": list(found["current"])}


def add_counts(one: dict, other: dict) -> dict:
    return {"rows": one["rows"] + other["rows"], "buckets": [a + b for a, b in zip(one["buckets"], other["buckets"], strict=True)]}


def psi_of_counts(spark: SparkSession, counts: dict, snapshot: dict) -> DataFrame:
    """psi_vs_snapshot of the rows counted by snapshot_counts, without reading them."""
    shares, rows = snapshot.get("price_log_ref_pct"), F.lit(counts["rows"]).cast("bigint").alias("current_rows")
    if not counts["buckets"] or not shares:
        return spark.range(1).select(F.lit(None).cast("double").alias("psi"), rows)
    stored = F.array(*[F.lit(EMPTY_SHARE if s == 0 else s) for s in shares])
    current = F.array(*[F.lit(c).cast("bigint") for c in counts["buckets"]])
    return spark.range(1).select(_psi(stored, _shares(current)).alias("psi"), rows)


def drift_verdict(df: DataFrame, snapshot: dict | None, threshold: float = MODERATE) -> DataFrame:
    """One row saying how far the prices drifted from the snapshot and whether to retrain.

    Retraining needs a high or moderate level as well as psi at or above the threshold.
    """
    if TARGET not in df.columns:
        raise ValueError(f"The drift check needs the column '{TARGET}'; the table has {df.columns}")
    spark = df.sparkSession
    facts = order_statistics(
        df,
        {"price": Wanted(F.col(TARGET), (0.5,))},
        {"n": F.count(F.lit(1)), "date": latest_date(df)},
    )
    if snapshot is None:
        found = spark.range(1).select(F.lit(None).cast("double").alias("psi"))
    else:
        found = psi_vs_snapshot(df, snapshot)
    level = (
        F.when(F.lit(snapshot is None), "no_reference")
        .when(F.col("psi").isNull(), "unknown")
        .when(F.col("psi") >= HIGH, "high")
        .when(F.col("psi") >= MODERATE, "moderate")
        .otherwise("none")
    )
    retrain = F.col("drift_level").isin("high", "moderate") & (F.col("psi") >= F.lit(float(threshold)))
    shown = F.format_string("%.4f", F.col("psi"))
    action = F.when(F.col("should_retrain"), "triggered").otherwise("not triggered")
    steady = F.format_string(STEADY.format(psi="%s"), shown)
    drifted = F.format_string(
        DRIFTED.format(level="%s", psi="%s", action="%s", threshold=threshold),
        F.initcap("drift_level"), shown, action,
    )
    reason = (
        F.when(F.col("drift_level") == "no_reference", FIRST_RUN)
        .when(F.col("drift_level") == "unknown", NOT_COMPUTED)
        .when(F.col("drift_level") == "none", steady)
        .otherwise(drifted)
    )
    known = snapshot or {}
    median = facts.values["price"][0] if facts.values["price"] else None
    return (
        found.select("psi", level.alias("drift_level"))
        .withColumn("should_retrain", F.coalesce(retrain, F.lit(False)))
        .select(
            "should_retrain",
            "psi",
            F.lit(float(threshold)).alias("psi_threshold"),
            "drift_level",
            F.lit(facts.also["n"]).cast("bigint").alias("current_row_count"),
            F.lit(known.get("row_count")).cast("bigint").alias("reference_row_count"),
            F.lit(median).cast("double").alias("current_price_median"),
            F.lit(known.get("price_median")).cast("double").alias("reference_price_median"),
            F.lit(known.get("snapshot_date")).cast("string").alias("reference_snapshot_date"),
            F.lit(facts.also["date"]).alias("current_snapshot_date"),
            reason.alias("reason"),
        )
    )
