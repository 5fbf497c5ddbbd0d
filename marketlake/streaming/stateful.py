"""Streams with keyed state, event-time timers and lateness that is accounted for.

Processors keep their state in the RocksDB store, one small entry per key; what a key needs later is asked for by a timer, so silence itself
can raise an alarm and forgotten keys cost nothing. Sinks are Parquet folders with a checkpoint, or a VersionedTable that takes each batch
once: no result passes the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.versioned import VersionedTable

MINUTE = 60_000_000
DAY = 24 * 60 * MINUTE


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started within keep their state in RocksDB, which processors need; the session's own choice returns afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def to_folder(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append what a stream gives to a Parquet folder until all that is there is taken."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()


class FeedAlarms(StatefulProcessor):
    """Ticks of a feed: `gap` between two that are more than gap_us apart, and `stale` where stale_us pass without one.

    Ticks wait in the state until the watermark says that none can come between any more; a timer asks for the earliest of them. So an
    alarm is raised by time alone, before the feed's next tick, and the state is what came within the watermark's delay. Of a batch's
    ticks only the first and last of each stretch of time wait that is too short for an alarm within it.
    """

    def __init__(self, gap_us: int, stale_us: int):
        self.gap_us, self.stale_us = gap_us, stale_us

    def init(self, handle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "us long")
        self.last = handle.getValueState("last", "us long")

    def _ask(self, us: int) -> None:
        self.handle.registerTimer((us + self.stale_us) // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        ends: dict[int, tuple[int, int]] = {}
        for r in rows:
            low, high = ends.get(stretch := r.us // min(self.gap_us, self.stale_us), (r.us, r.us))
            ends[stretch] = min(low, r.us), max(high, r.us)
        new = sorted({us for pair in ends.values() for us in pair})
        self.waiting.appendList([(us,) for us in new])
        self._ask(new[0])
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = sorted({w[0] for w in self.waiting.get()})
        sure = [us for us in waiting if us + self.stale_us < known]
        if not sure:
            return
        before = self.last.get()[0] if self.last.exists() else None
        for k, us in enumerate(sure):
            if before is not None and us - before > self.gap_us:
                yield Row(feed=key[0], alarm="gap", start_us=before, end_us=us, minutes=(us - before + MINUTE // 2) // MINUTE)
            if k + 1 == len(waiting) or waiting[k + 1] - us > self.stale_us:
                yield Row(feed=key[0], alarm="stale", start_us=us, end_us=us + self.stale_us, minutes=self.stale_us // MINUTE)
            before = us
        self.last.update((before,))
        rest = waiting[len(sure) :]
        self.waiting.clear()
        if rest:
            self.waiting.put([(us,) for us in rest])
            self._ask(rest[0])


def feed_alarms(ticks: DataFrame, feed: str, gap_minutes: int = 20, stale_minutes: int = 15, late: str = "1 hour") -> DataFrame:
    """feed, alarm (gap or stale), start_us, end_us, minutes of a stream with a time ts."""
    keyed = ticks.withWatermark("ts", late).select(F.col(feed).cast("string").alias("feed"), "ts", F.unix_micros("ts").alias("us"))
    return keyed.groupBy("feed").transformWithState(FeedAlarms(gap_minutes * MINUTE, stale_minutes * MINUTE), "feed string, alarm string, start_us long, end_us long, minutes long", "append", "eventTime")


class LastSnapshot(StatefulProcessor):
    """The snapshot in which a member was seen last; rows of older snapshots give nothing."""

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", "snapshot string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        last = self.last.get()[0] if self.last.exists() else None
        for snapshot in sorted({r.snapshot for r in rows}):
            if last is None or snapshot > last:
                yield Row(side=key[0], snapshot=snapshot, last=last)
                last = snapshot
        self.last.update((last,))


def last_snapshots(members: DataFrame) -> DataFrame:
    """side, snapshot, last for each member's appearance in a stream of (side, member, snapshot): last is the snapshot that had it before."""
    return members.groupBy("side", "member").transformWithState(LastSnapshot(), "side string, snapshot string, last string", "append", "none")


def flow_of(appearances: DataFrame) -> DataFrame:
    """side, snapshot, n, new, gone from what last_snapshots() gave: members are counted by (snapshot, last) first, so what is left to
    put in order has a row per snapshot."""
    from pyspark.sql.window import Window

    counts = appearances.groupBy("side", "snapshot", "last").agg(F.count("*").alias("k"))
    order = counts.select("side", "snapshot").distinct().withColumn("before", F.lag("snapshot").over(Window.partitionBy("side").orderBy("snapshot")))
    each = counts.join(order, ["side", "snapshot"]).groupBy("side", "snapshot", "before").agg(F.sum("k").alias("n"), F.coalesce(F.sum(F.when(F.col("last") == F.col("before"), F.col("k"))), F.lit(0)).alias("stay"))
    sizes = each.select("side", F.col("snapshot").alias("before"), F.col("n").alias("n_before"))
    first = F.col("before").isNull()
    both = each.join(sizes, ["side", "before"], "left")
    return both.select("side", "snapshot", "n", F.when(first, 0).otherwise(F.col("n") - F.col("stay")).alias("new"), F.when(first, 0).otherwise(F.col("n_before") - F.col("stay")).alias("gone"))


class SettledOnce(StatefulProcessor):
    """A key's items: `new` unless the key was marked within ttl_us, then `seen`; only settled items mark it. Items that come more than
    late_us behind the newest of all are `late` and change nothing.

    A timer clears the mark once the watermark is past its end; no item that still counts could meet it there.
    """

    def __init__(self, ttl_us: int, late_us: int, delay_us: int):
        self.ttl_us, self.late_us, self.delay_us = ttl_us, late_us, delay_us

    def init(self, handle) -> None:
        self.handle = handle
        self.mark = handle.getValueState("mark", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        limit = watermark * 1000 + self.delay_us - self.late_us if watermark else None
        mark = before = self.mark.get()[0] if self.mark.exists() else None
        for r in sorted(rows, key=lambda r: (r.us, r.item)):
            if limit is not None and r.us <= limit:
                yield Row(item=r.item, verdict="late")
            elif mark is not None and r.us <= mark + self.ttl_us:
                yield Row(item=r.item, verdict="seen")
            else:
                yield Row(item=r.item, verdict="new")
                mark = r.us if r.settled else mark
        if mark != before:
            self.mark.update((mark,))
            self.handle.registerTimer((mark + self.ttl_us) // 1000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.mark.exists() and self.mark.get()[0] + self.ttl_us < timerValues.getCurrentWatermarkInMs() * 1000:
            self.mark.clear()
        return iter(())


def settled_once(items: DataFrame, key: Column, item: str, settled: Column, ttl_days: int = 7, late_minutes: int = 60) -> DataFrame:
    """item, verdict (new, seen or late) of a stream with a time ts. The watermark is ttl_days behind, so that late items still come as
    far as the processor and are counted; items that old are `late` by any measure, and those older than the watermark Spark drops."""
    rows = items.withWatermark("ts", f"{ttl_days} days").select(key.alias("key"), "ts", F.unix_micros("ts").alias("us"), F.col(item).alias("item"), settled.alias("settled"))
    return rows.groupBy("key").transformWithState(SettledOnce(ttl_days * DAY, late_minutes * MINUTE, ttl_days * DAY), "item long, verdict string", "append", "eventTime")


CANDLE = "start_us long, first_us long, first_id long, open long, last_us long, last_id long, close long, high long, low long, volume long"


def candle_table(spark: SparkSession, root: str, file_rows: int = 1_000_000) -> VersionedTable:
    return VersionedTable(spark, root, CANDLE, ["start_us"], file_rows=file_rows)


def candles_of(rows: DataFrame) -> DataFrame:
    """One row per start_us of rows that are candles of parts of it."""
    first, last = F.struct("first_us", "first_id"), F.struct("last_us", "last_id")
    edges = [F.min_by(c, first).alias(c) for c in ("first_us", "first_id", "open")] + [F.max_by(c, last).alias(c) for c in ("last_us", "last_id", "close")]
    return rows.groupBy("start_us").agg(*edges, F.max("high").alias("high"), F.min("low").alias("low"), F.sum("volume").alias("volume"))


def candle_intake(table: VersionedTable, side: str, minutes: int = 30, late_minutes: int = 60, name: str = "candles") -> Callable[[DataFrame, int], None]:
    """For foreachBatch: merge a batch of ticks (ts, event_id, cents) into the table of candles.

    Ticks that come late_minutes and more behind the newest tick of earlier batches go to the folder `side` instead, one subfolder per
    batch, and are counted. Rows, newest tick, count and batch number change in one commit; a repeated batch changes nothing. Ticks are
    summed up per window in each task, and only files of windows that are still filling are written again.
    """
    wide, late = minutes * MINUTE, late_minutes * MINUTE

    def load(batch: DataFrame, n: int) -> None:
        said = table.version().properties
        if said.get("batches", {}).get(name, -1) >= n:
            return
        rows = batch.select(F.unix_micros("ts").alias("us"), "event_id", "cents")
        newest = said.get("newest_us")
        is_late = F.lit(False) if newest is None else F.col("us") <= newest - late
        count = rows.agg(F.max("us").alias("newest"), F.count_if(is_late).alias("late")).first()
        if count["newest"] is None:
            return
        start = (F.col("us") - F.pmod("us", F.lit(wide))).alias("start_us")
        if count["late"]:
            rows.where(is_late).select(start, "us", "event_id", "cents").write.mode("overwrite").parquet(f"{side}/batch={n}")
        each = rows.where(~is_late).select(start, F.col("us").alias("first_us"), F.col("event_id").alias("first_id"), F.col("cents").alias("open"), F.col("us").alias("last_us"), F.col("event_id").alias("last_id"), F.col("cents").alias("close"), F.col("cents").alias("high"), F.col("cents").alias("low"), F.lit(1).cast("long").alias("volume"))
        properties = {"newest_us": max(count["newest"], newest or count["newest"]), "late": said.get("late", 0) + count["late"]}
        table.upsert(candles_of(each), lambda old, new: candles_of(old.unionByName(new)), properties, once=(name, n))

    return load


def upsert_intake(table: VersionedTable, name: str, rows_of: Callable[[DataFrame], DataFrame] = lambda batch: batch) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: upsert each batch exactly once; the batch's number is part of the commit."""

    def load(batch: DataFrame, n: int) -> None:
        table.upsert(rows_of(batch), once=(name, n))

    return load


def to_table(stream: DataFrame, load: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Run foreachBatch until all that is there is taken."""
    stream.writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
