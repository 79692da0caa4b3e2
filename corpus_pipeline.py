"""Five operators in a row over the documents: each stage reads what the one before has written.

Toxic documents go, one document of each group of near copies stays, repeated passages are cut, documents
with benchmark items go, and what is left is cut into pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.llm import decontaminate, nearcopies, pieces, substrings, toxicity
from parcelry.llm.common import crc_mod, table
from parcelry.session import new_shared_path

TOXIC = 0.5


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    weights = toxicity.fit(docs, table(spark, sf_dir, "labels"), "toxic", crc_mod(F.col("doc_id"), 5) != 0)
    return toxicity.accepted(docs, weights, TOXIC)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.keep_one(docs)


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substrings.cut(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, piece_ids, lossless) of each document left."""
    found = pieces.roundtrip(docs, pieces.read_vocabulary(pieces.MODEL))
    return found.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")


STAGES = [
    ("toxicity", without_toxic),
    ("near copies", without_near_copies),
    ("repeated passages", without_repeated_passages),
    ("benchmark", without_benchmark),
    ("pieces", as_pieces),
]
#: Learned weights and sampled pieces have no SQL; tests/llm compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_shared_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
