"""Outputs: month and group folders with an index, archives, single documents, and the guards before a swap.

Every writer goes to a folder that Spark writes, so a lost executor leaves no half file that is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import latest


def write_shards(rows: DataFrame, group: str, target: str) -> DataFrame:
    """Replace the folder of group shards and its index (group, n): groups that are gone leave no stale shard behind."""
    spark = rows.sparkSession
    rows.write.mode("overwrite").partitionBy(group).parquet(f"{target}/shards")
    spark.read.parquet(f"{target}/shards").groupBy(group).agg(F.count("*").alias("n")).write.mode("overwrite").parquet(f"{target}/index")
    return spark.read.parquet(f"{target}/index")


def shard_faults(index: DataFrame, shards: DataFrame, group: str, valid: Column) -> DataFrame:
    """group, fault, n: groups of one side only, counts that differ, and rows that break the contract (not valid). Empty if all is well."""
    there = shards.groupBy(group).agg(F.count("*").alias("rows"), F.count_if(~F.coalesce(valid, F.lit(False))).alias("bad"))
    both = index.select(F.col(group).cast("string").alias(group), "n").join(there.withColumn(group, F.col(group).cast("string")), group, "full")
    fault = F.when(F.col("n").isNull(), "not in the index").when(F.col("rows").isNull(), "no shard").when(F.col("n") != F.col("rows"), "count").when(F.col("bad") > 0, "contract")
    return both.select(group, fault.alias("fault"), F.coalesce("bad", F.lit(0)).alias("n")).where("fault IS NOT NULL")


def write_months(rows: DataFrame, day: str, target: str) -> DataFrame:
    """Replace the month folders that rows touch; returns the index (day, n), made anew from all that is there."""
    spark = rows.sparkSession
    monthly = rows.withColumn("month", F.date_format(day, "yyyy-MM"))
    monthly.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month").parquet(target)
    return spark.read.parquet(target).groupBy(day).agg(F.count("*").alias("n"))


def append_archive(rows: DataFrame, target: str) -> None:
    """Append rows to an archive of JSON lines; the same row may come again."""
    rows.withColumn("archived", F.current_timestamp()).write.mode("append").json(target)


def read_archive(spark, target: str, schema: str, keys: list[str]) -> DataFrame:
    """The archive's rows, of each key the last one archived."""
    rows = spark.read.schema(f"{schema}, archived timestamp").json(target)
    return latest(rows, keys, ["archived", *[F.col(c).desc() for c in rows.columns if c not in (*keys, "archived")]]).drop("archived")


def write_csv(rows: DataFrame, target: str) -> None:
    """Headered CSV."""
    rows.write.mode("overwrite").option("header", True).csv(target)


def one_document(parts: dict[str, DataFrame], order: dict[str, str], most_bytes: int) -> DataFrame:
    """document, bytes: one JSON object with an array for each part (small results, ordered by a column); too large a one is an error.

    The parts are results of aggregations; each becomes one row before they meet.
    """
    out = None
    for name, rows in parts.items():
        by = order[name]
        items = F.array_sort(F.collect_list(F.struct(by, *[c for c in rows.columns if c != by]))).alias(name)
        row = rows.agg(items)
        out = row if out is None else out.crossJoin(row)  # one row each
    made = out.select(F.to_json(F.struct(*parts)).alias("document"))
    size = F.octet_length("document")
    checked = F.when(size <= most_bytes, F.col("document")).otherwise(F.raise_error(F.format_string("the document has %d bytes", size)))
    return made.select(checked.alias("document"), size.alias("bytes"))


def shrink_guard(new: DataFrame, old: DataFrame, least: int, ratio: float) -> DataFrame:
    """n_new, n_old, verdict: refused if the new output has under `least` rows or under ratio times the old one's, else ok."""
    both = new.agg(F.count("*").alias("n_new")).crossJoin(old.agg(F.count("*").alias("n_old")))  # one row each
    small = (F.col("n_new") < least) | (F.col("n_new") < ratio * F.col("n_old"))
    return both.withColumn("verdict", F.when(small, "refused").otherwise("ok"))


def state_of(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """name, n, last: rows and the last period with a value of each table (rows, period, value): what a publication depends on."""
    out = None
    for name, (rows, period, value) in sorted(tables.items()):
        row = rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.max(F.when(F.col(value).isNotNull(), F.col(period).cast("string"))).alias("last"))
        out = row if out is None else out.union(row)
    return out.select("name", "n", "last")


def changed(now: DataFrame, before: DataFrame) -> DataFrame:
    """name, changed: whether a table's state differs from the stored one; new and vanished tables have changed."""
    a, b = now.select("name", F.struct("n", "last").alias("now")), before.select("name", F.struct("n", "last").alias("then"))
    return a.join(b, "name", "full").select("name", (~F.col("now").eqNullSafe(F.col("then"))).alias("changed"))


def changed_releases(files: DataFrame, known: DataFrame) -> DataFrame:
    """key, digest of the releases (key, body) whose body's hash isn't the known one (key, digest)."""
    new = files.select("key", F.md5("body").alias("digest"))
    return new.join(known.select("key", "digest").distinct(), ["key", "digest"], "left_anti")


def archive_and_delete(notes: DataFrame, marker: str, today: str, archive_days: int = 20, keep_days: int = 30) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(to archive, kept, deleted) of notes with fecha: what lies in (marker, today - archive_days] is due for the archive; what is
    keep_days old is deleted, and goes to the archive again before, whatever the marker says."""
    edge = lambda n: F.date_sub(F.lit(today).cast("date"), n)
    due = (F.col("fecha") > F.lit(marker).cast("date")) & (F.col("fecha") <= edge(archive_days))
    old = F.col("fecha") <= edge(keep_days)
    return notes.where(due | old), notes.where(F.coalesce(~old, F.lit(True))), notes.where(old)


def shrink_guard_by(new: DataFrame, old: DataFrame, group: str, least: int, share: float) -> DataFrame:
    """group, n_new, n_old, verdict for every group of either table: refused if the new one has under `least` rows or under `share` of
    the old ones."""
    counts = lambda rows, name: rows.groupBy(group).agg(F.count("*").alias(name))
    both = counts(new, "n_new").join(counts(old, "n_old"), group, "full").na.fill(0, ["n_new", "n_old"])
    refused = (F.col("n_new") < least) | (F.col("n_new") < share * F.col("n_old"))
    return both.withColumn("verdict", F.when(refused, "refused").otherwise("ok"))
