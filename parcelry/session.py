"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "parcelry", partitions: int = 8) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A temporary folder stands in only when the setting is absent, as in tests.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder shared by all executors.")
        folder = tempfile.mkdtemp(prefix="parcelry-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_shared_path(spark: SparkSession, label: str) -> str:
    """Unused path below the shared folder."""
    return f"{shared_folder(spark)}/parcelry/{label}-{uuid.uuid4().hex}"


@contextmanager
def held(df: DataFrame) -> Iterator[DataFrame]:
    """Keep a table that several passes read, spilling to disk, and release it after.

    Lost blocks are recomputed from the plan.
    """
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative estimators cut their lineage in the shared folder."""
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
