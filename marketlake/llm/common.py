"""Shared helpers: the shared folder, cutting lineage by tables that are deleted after use, free column names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders of local sessions that have no spark.checkpoint.dir, by application.
LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local session gets a folder of its own; on a cluster that is an error, as no machine's own folder
    is seen by the others.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.conf.get("spark.app.id", "local")
    if app not in LOCAL:
        LOCAL[app] = f"file://{tempfile.mkdtemp(prefix='spark-', dir='/tmp')}"
    return LOCAL[app]


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one; no two runs write to the same place."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours by the file system that Spark itself uses for it."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


class Workspace:
    """The tables of one run. A name that is saved again replaces its table; drop() deletes tables that are used up.

    A table is deleted only after all that reads it has been written, so that lost executors find whatever they need.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths, self.n = spark, run_dir(spark, name), {}, 0

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Cut the lineage: write df to the shared folder and read it back, so that lost executors lose none of it."""
        self.n += 1
        path = f"{self.root}/{self.n:03d}-{name}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def folder(self, name: str) -> str:
        """A folder for files of that name, which drop() deletes like a table."""
        self.n += 1
        self.paths[name] = f"{self.root}/{self.n:03d}-{name}"
        return self.paths[name]

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                delete(self.spark, self.paths.pop(name))

    def drop_all_but(self, *names: str) -> None:
        self.drop(*[n for n in self.paths if n not in names])


def save(df: DataFrame, name: str) -> DataFrame:
    """Write df to a new folder below the shared one and read it back."""
    return Workspace(df.sparkSession, name).save(df, name)


def free_name(columns: list[str], name: str) -> str:
    """name, or name with underscores before it, such that no column is called so (upper and lower case are alike)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small_batches(spark: SparkSession, rows: int = 256) -> None:
    """Bound what one Arrow batch of texts can hold: texts may have a hundred thousand characters and more.

    Spark reads this setting when a job runs, so it stays set in the session; it is only ever lowered.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


#: Up to so many values (ids, or elements of arrays: some tens of bytes each) a join may broadcast a side; beyond, Spark shuffles both.
MOST_BROADCAST = 500_000


def small(df: DataFrame, weight: Column | None = None) -> DataFrame:
    """df, to be broadcast if its counted rows allow it, or the sum of `weight`, the number of values in a row."""
    n = df.count() if weight is None else df.agg(F.sum(weight)).first()[0] or 0
    return F.broadcast(df) if n <= MOST_BROADCAST else df


def file_system(uri: str):
    """pyarrow file system and path of a URI; file:// and whatever else pyarrow speaks."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri else f"file:{uri}" if uri.startswith("file:") else uri)
