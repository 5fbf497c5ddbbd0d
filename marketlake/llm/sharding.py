"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has SLOTS slots. Each shard owns several virtual nodes on it; a slot belongs to the next virtual node clockwise.
A shard takes keys until its bound is reached; what overflows continues clockwise to the next virtual node whose shard has
room. Only counts per slot (at most SLOTS rows) reach the driver, which turns them into stretches "ranks a to b of slot s
go to shard t, from place p"; rows then find their stretch by their rank in the slot.

With load factor 1 the bounds are the exact even split, so counts differ by one at most (law `rows`); a larger factor
moves fewer rows when a shard is added and bounds each shard by factor times the mean.

Defined results: a null text has no bytes (size 8, crc32 0); a null doc_id hashes by the text's crc32; repeated rows keep
a row each, also those that differ in nothing; whole texts count, however long; an empty table gives no rows. Columns besides
the key and text, with whatever names, are ignored.
"""

from __future__ import annotations

import bisect
import hashlib
import math

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import documents, save

SLOTS = 1 << 14
CHUNK_ROWS = 50_000


def ring(shards: int, vnodes: int) -> list[tuple[int, int]]:
    """Sorted (slot, shard) of the virtual nodes; shards keep their places when others come or go."""
    nodes = []
    for shard in range(shards):
        for v in range(vnodes):
            digest = hashlib.blake2b(f"{shard}/{v}".encode(), digest_size=8).digest()
            nodes.append((int.from_bytes(digest, "big") % SLOTS, shard))
    return sorted(nodes)


def bounds(rows: int, shards: int, load_factor: float) -> list[int]:
    """Most rows of each shard."""
    if load_factor <= 1:
        return [rows // shards + (s < rows % shards) for s in range(shards)]
    return [math.ceil(load_factor * rows / shards)] * shards


def stretches(counts: dict[int, int], shards: int, vnodes: int, load_factor: float) -> list[tuple[int, int, int, int, int]]:
    """(slot, first rank, end rank, shard, place of the first) for the rows counted in each slot."""
    nodes = ring(shards, vnodes)
    places = [slot for slot, _ in nodes]
    left = bounds(sum(counts.values()), shards, load_factor)
    filled = [0] * shards
    out = []
    for slot in sorted(counts):
        rank, n = 0, counts[slot]
        at = bisect.bisect_left(places, slot)
        for step in range(len(nodes)):
            if rank == n:
                break
            shard = nodes[(at + step) % len(nodes)][1]
            take = min(n - rank, left[shard])
            if take:
                out.append((slot, rank, rank + take, shard, filled[shard]))
                left[shard] -= take
                filled[shard] += take
                rank += take
    return out


def assign(df: DataFrame, shards: int = 24, vnodes: int = 64, load_factor: float = 1.0) -> DataFrame:
    """Add shard and slot (gapless from 0 in each shard) to rows with the columns place (ring position) and tie columns.

    Rows of a ring slot are ranked within chunks of it, dealt by a hash of the tie columns, and moved by the counts of the
    chunks before, so that a key with a third of all rows is as many tasks' work as its slot has chunks.
    """
    spark = df.sparkSession
    ties = [c for c in df.columns if c != "place"]
    df = df.withColumn("ring_slot", F.shiftrightunsigned("place", 64 - SLOTS.bit_length() + 1).cast("int"))
    counts = {r["ring_slot"]: r["n"] for r in df.groupBy("ring_slot").agg(F.count("*").alias("n")).collect()}
    plan = pd.DataFrame(stretches(counts, shards, vnodes, load_factor), columns=["ring_slot", "a", "b", "shard", "base"])
    plan = spark.createDataFrame(plan.astype("int64"), "ring_slot int, a long, b long, shard int, base long")
    chunks = max(1, -(-max(counts.values(), default=0) // CHUNK_ROWS))
    df = df.withColumn("chunk", F.pmod(F.xxhash64("place", *ties, F.lit(7)), F.lit(chunks)).cast("int"))
    order = Window.partitionBy("ring_slot", "chunk").orderBy("place", *ties)
    ranked = df.withColumn("rank", F.row_number().over(order) - 1)
    if chunks > 1:  # a row for each slot and chunk
        sizes = df.groupBy("ring_slot", "chunk").agg(F.count("*").alias("n"))
        before = sizes.select("ring_slot", "chunk", (F.sum("n").over(Window.partitionBy("ring_slot").orderBy("chunk")) - F.col("n")).alias("before"))
        ranked = ranked.join(before, ["ring_slot", "chunk"]).withColumn("rank", F.col("rank") + F.col("before")).drop("before")
    # at most SLOTS stretches and those that overflow, whatever the input
    found = ranked.join(F.broadcast(plan), ["ring_slot"]).where("rank >= a AND rank < b")
    return found.withColumn("slot", F.col("base") + F.col("rank") - F.col("a")).drop("ring_slot", "chunk", "rank", "a", "b", "base", "place")


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 24 shards, counts at most one apart."""
    crc = F.crc32(F.coalesce("text", F.lit("")))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    rows = documents(spark, sf_dir).select("doc_id", size.alias("size"), crc.alias("text_crc32"))
    rows = rows.withColumn("place", F.xxhash64(F.coalesce("doc_id", "text_crc32")))
    out = assign(save(rows, "shard-rows"))
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
