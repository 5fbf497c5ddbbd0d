"""Folders that driver and executors share, for tables between steps and for files that a query writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of local sessions that have no spark.checkpoint.dir, by application.
LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below spark.checkpoint.dir; a local session without that setting gets a folder of its own."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        app = spark.conf.get("spark.app.id", "local")
        root = LOCAL.setdefault(app, f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables between the steps of one run. Saving a name again writes a new table; what was read before stays whole."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, shared_folder(spark, name), 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Cut the lineage: lost executors find the table again."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
