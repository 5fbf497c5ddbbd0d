"""Connected components by repeated minimum labels, on Spark only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Workspace


def components(edges: DataFrame, tables: Workspace, name: str = "labels") -> DataFrame:
    """(key, label) for every end of the edges (a, b), saved as `name`: label is the least key that can be reached.

    In each round a vertex takes the least label among itself and its neighbours, then the label of that label; the number
    of rounds grows with the logarithm of a component's diameter. Each round is a table in the shared folder that replaces
    the one before. The minimum is combined before the shuffle, so a vertex with many neighbours is a row per task.
    """
    both = tables.save(edges.select("a", "b").union(edges.select("b", "a")).where("a <> b").distinct(), f"{name}-edges")
    labels = tables.save(both.groupBy(F.col("a").alias("key")).agg(F.least(F.min("a"), F.min("b")).alias("label")), name)
    while True:
        near = both.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("near"))
        least = labels.join(near, "key").select("key", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("further"))
        new = tables.save(least.join(jump, "label").select("key", F.least("label", "further").alias("label"), "old"), name)
        labels = new.select("key", "label")
        if new.where("label <> old").isEmpty():
            tables.drop(f"{name}-edges")
            return labels
