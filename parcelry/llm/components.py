"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelry.session import use_checkpoints


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in links (a, b); a component is named by its least id.

    Each round gives every id the least name among its neighbours' and then that name's own name, so the
    rounds grow with the logarithm of the longest chain. Rounds are checkpointed in the shared folder.
    A hub is no problem: names are reduced per task before they shuffle.
    """
    use_checkpoints(links.sparkSession)
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = both.where("a <> b").distinct().checkpoint()
    names = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("least"))
    names = names.select("id", F.least("id", "least").alias("component")).checkpoint()
    while True:
        heard = both.join(names.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("component").alias("heard"))
        near = names.join(heard, "id").select("id", F.col("component").alias("was"), F.least("component", "heard").alias("component"))
        of_name = names.select(F.col("id").alias("component"), F.col("component").alias("above"))
        # every name is an id and so has a name itself
        after = near.join(of_name, "component").select("id", "was", F.least("component", "above").alias("component")).checkpoint()
        if after.where("was <> component").isEmpty():
            return after.select("id", "component")
        names = after.select("id", "component")
