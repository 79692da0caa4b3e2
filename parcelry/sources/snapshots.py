"""Versioned store of drift snapshots: one commit per version, whole or not at all."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from parcelry.operators.drift import SNAPSHOT_SCHEMA, add_counts, psi_of_counts, snapshot_counts, snapshot_frame
from parcelry.sources import commits


def load_snapshot(spark: SparkSession, path: str) -> dict | None:
    """Newest snapshot, or None before the first one."""
    return commits.latest(spark, path)[1]


def read_snapshot_document(spark: SparkSession, path: str) -> dict | None:
    """A snapshot kept as one JSON document in a file of its own, or None if absent."""
    try:
        found = spark.read.schema(SNAPSHOT_SCHEMA).option("multiLine", "true").json(path).limit(2).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if len(found) > 1:
        raise ValueError(f"{path} holds several snapshots; name the file of one")
    return found[0].asDict() if found else None


def save_snapshot(spark: SparkSession, path: str, snapshot: dict) -> int:
    """Commit as the next version. Nothing already stored is rewritten, and no other writer's version is lost."""
    row = snapshot_frame(spark, snapshot).first().asDict()
    return commits.append(spark, path, lambda number, before: row)


def count_batch(spark: SparkSession, path: str, batch: str, df: DataFrame) -> dict:
    """Add the rows of a named batch to the counts kept beside the newest snapshot; only this batch is read.

    A batch that is already counted is not counted again, so a job may be repeated. The first batch after
    a new snapshot starts anew, for the edges have changed. Returns the counts of all batches so far.
    """
    number, snapshot = commits.latest(spark, path)
    if snapshot is None:
        raise ValueError(f"{path} holds no snapshot to count against; save one first")
    before = commits.latest(spark, _counts(path))[1]
    if before and before["snapshot"] == number and batch in before["batches"]:
        return before
    found = snapshot_counts(df, snapshot)

    def merged(_, before):
        if before and before["snapshot"] > number:
            raise commits.Conflict(f"Snapshot {before['snapshot']} replaced {number} while '{batch}' was counted; count it again")
        if not before or before["snapshot"] < number:
            return {"snapshot": number, "batches": [batch], **found}
        if batch in before["batches"]:
            return before
        return {"snapshot": number, "batches": [*before["batches"], batch], **add_counts(before, found)}

    return commits.read(spark, _counts(path), commits.append(spark, _counts(path), merged))


def psi_of_batches(spark: SparkSession, path: str) -> DataFrame:
    """One row: psi of all counted batches against the snapshot they were counted for."""
    counts = commits.latest(spark, _counts(path))[1]
    if counts is None:
        raise ValueError(f"{path} holds no counted batch")
    return psi_of_counts(spark, counts, commits.read(spark, path, counts["snapshot"]))


def _counts(path: str) -> str:
    return f"{path}/counts"
