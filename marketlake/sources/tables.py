"""Merges of a table with new rows. Each returns the merged table; the caller writes it to a new place and swaps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def latest(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """One row for each key, the last in the order."""
    last = Window.partitionBy(*keys).orderBy(*[F.desc(c) if isinstance(c, str) else c for c in order])
    return rows.withColumn("__k", F.row_number().over(last)).where("__k = 1").drop("__k")


def keyed_replace(old: DataFrame, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Insert or replace by key: the last row in the order wins, whichever table it is in."""
    return latest(old.unionByName(new), keys, order)


def insert_absent(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """old and those rows of new whose key isn't there yet; keys are compared NULL-safely."""
    same = [old[k].eqNullSafe(new[k]) for k in keys]
    cond = same[0]
    for c in same[1:]:
        cond = cond & c
    return old.unionByName(new.join(old.select(*keys), cond, "left_anti"))


def merge_fields(old: DataFrame, new: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Full outer merge by key: a field of new wins unless it is NULL; verdict is new, updated, equal or kept."""
    o = old.select(*keys, *[F.col(f).alias(f"__old_{f}") for f in fields], F.lit(True).alias("__old"))
    n = new.select(*keys, *[F.col(f).alias(f"__new_{f}") for f in fields], F.lit(True).alias("__new"))
    both = o.join(n, keys, "full")
    merged = {f: F.coalesce(f"__new_{f}", f"__old_{f}") for f in fields}
    same = F.lit(True)
    for f in fields:
        same = same & merged[f].eqNullSafe(F.col(f"__old_{f}"))
    verdict = F.when(F.col("__old").isNull(), "new").when(F.col("__new").isNull(), "kept").when(same, "equal").otherwise("updated")
    return both.select(*keys, *[c.alias(f) for f, c in merged.items()], verdict.alias("verdict"))


def overlay(official: DataFrame, provisional: DataFrame, keys: list[str]) -> DataFrame:
    """Official rows, and the provisional ones of keys that official lacks, flagged."""
    fill = provisional.join(official.select(*keys).distinct(), keys, "left_anti").withColumn("provisional", F.lit(1))
    return official.withColumn("provisional", F.lit(0)).unionByName(fill)
