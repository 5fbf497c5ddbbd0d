"""Structured Streaming jobs over ticks (ts, user_id, event_type, cents, event_id)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.tables import latest

TICK_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, cents long"


def candles(ticks: DataFrame, minutes: int = 30, late: str = "1 hour") -> DataFrame:
    """start, open, high, low, close, volume of each window; ticks later than the watermark are dropped."""
    key = F.struct("ts", "event_id")
    window = F.window("ts", f"{minutes} minutes")
    made = ticks.withWatermark("ts", late).groupBy(window).agg(F.min_by("cents", key).alias("open"), F.max("cents").alias("high"), F.min("cents").alias("low"), F.max_by("cents", key).alias("close"), F.count("*").alias("volume"))
    return made.select(F.col("window.start").alias("start"), "open", "high", "low", "close", "volume")


def sessions(ticks: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end, n of each visit."""
    made = ticks.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap)).agg(F.count("*").alias("n"))
    return made.select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def first_seen(ticks: DataFrame, keys: list[str], ttl: str = "7 days") -> DataFrame:
    """Rows whose key wasn't seen within the ttl; older keys are forgotten."""
    return ticks.withWatermark("ts", ttl).dropDuplicatesWithinWatermark(keys)


def sliding_volatility(ticks: DataFrame, size: str = "1 hour", slide: str = "10 minutes", late: str = "1 hour") -> DataFrame:
    """start, n, volatility of sliding windows."""
    made = ticks.withWatermark("ts", late).groupBy(F.window("ts", size, slide)).agg(F.count("*").alias("n"), F.stddev_samp("cents").alias("volatility"))
    return made.select(F.col("window.start").alias("start"), "n", "volatility")


def intake(files: DataFrame, target: str, checkpoint: str, keys: list[str], order: list[str], part: Column) -> StreamingQuery:
    """Load a file stream into a table partitioned by `part`, replacing by key within it; a replayed batch changes nothing.

    Only the parts that a batch touches are read and written again, first beside the table, then over it, so that no
    batch reads what it overwrites.
    """

    def load(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        new = batch.withColumn("part", part)
        touched = new.select("part").distinct()
        try:
            old = spark.read.parquet(f"{target}/rows").select(*batch.columns, F.col("part").cast(new.schema["part"].dataType).alias("part"))
            merged = old.join(F.broadcast(touched), "part", "left_semi").select(*new.columns).unionByName(new)  # a row per part
        except Exception as e:  # the first batch
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
            merged = new
        latest(merged, keys, order).write.mode("overwrite").parquet(f"{target}/batch")
        writer = spark.read.schema(new.schema).parquet(f"{target}/batch").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("part").parquet(f"{target}/rows")

    return files.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def on_time(items: DataFrame, published: str, seen: str, hours: int = 28, keep_undated: bool = True) -> DataFrame:
    """Items at most `hours` old when they were seen; undated ones pass or, in the strict lane, don't."""
    age = F.unix_micros(F.col(seen).cast("timestamp")) - F.unix_micros(F.col(published).cast("timestamp"))
    return items.where(F.coalesce(age <= hours * 3_600_000_000, F.lit(keep_undated)))


def membership_flow(snapshots: DataFrame, key: str = "side") -> DataFrame:
    """key, snapshot, n, new, gone of a stream of (snapshot, key, members array): the members of the key's snapshot before are the
    state. The first snapshot of a key has none new or gone; one that is older than the state is left out."""
    import pandas as pd

    def advance(name: tuple, frames, state):
        last, members = state.get if state.exists else (None, [])
        rows = pd.concat(frames).sort_values("snapshot")
        before, out = set(members), []
        for snapshot, now in zip(rows["snapshot"], rows["members"], strict=True):
            if last is not None and snapshot <= last:
                continue
            now = set(now)
            out.append((name[0], snapshot, len(now), 0 if last is None else len(now - before), 0 if last is None else len(before - now)))
            last, before = snapshot, now
        state.update((None if last is None else str(last), sorted(int(m) for m in before)))
        yield pd.DataFrame(out, columns=[key, "snapshot", "n", "new", "gone"]).astype({"n": "int64", "new": "int64", "gone": "int64"})

    shape = f"{key} string, snapshot string, n long, new long, gone long"
    return snapshots.groupBy(key).applyInPandasWithState(advance, shape, "last string, members array<long>", "append", "NoTimeout")


def official_first(provisional: DataFrame, official: DataFrame, keys: list[str]) -> DataFrame:
    """A stream of provisional rows with the official value (static) of the same key where there is one; flag provisional."""
    known = official.select(*keys, F.col("valor").alias("__official"))
    rows = provisional.join(known, keys, "left")
    return rows.withColumn("provisional", F.col("__official").isNull().cast("int")).withColumn("valor", F.coalesce("__official", "valor")).drop("__official")


def with_side_log(rows: DataFrame, main: callable, log: callable, checkpoint: str) -> StreamingQuery:
    """Write every batch by main(batch, n), then log it by log(batch, n): a failing log is reported and leaves the main write be."""
    import logging

    def both(batch: DataFrame, n: int) -> None:
        main(batch, n)
        try:
            log(batch, n)
        except Exception as e:  # the log is worth less than the batch
            logging.getLogger(__name__).warning("batch %s isn't logged: %s", n, e)

    return rows.writeStream.foreachBatch(both).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
