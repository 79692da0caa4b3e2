"""Score request files as they arrive, with the same plan as the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from parcelry.operators.cleaning import REQUEST_RULES, split_valid
from parcelry.operators.scoring import score_table
from parcelry.sources.models import TrainedModel


def read_requests(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def score_stream(requests: DataFrame, trained: TrainedModel, output: str, checkpoint: str) -> StreamingQuery:
    """Score the valid requests of each arriving batch into a parquet folder, exactly once.

    Every step is stateless, so nothing accumulates between batches.
    """
    valid, _ = split_valid(requests, REQUEST_RULES)
    scored = score_table(valid, trained)
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
