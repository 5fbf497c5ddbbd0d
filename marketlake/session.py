"""Session for local use and tests, and the table loader. On a cluster the caller brings the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: str = "8") -> SparkSession:
    """A local UTC session with AQE; tests and bench.py use it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("marketlake")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under sf_dir; only columns that a query uses are read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
