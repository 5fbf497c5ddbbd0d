"""Order-book operators. A book has snapshot, side, price4 (1/10000), size, trader, merchant; any number of snapshots at once.

Windows run over price levels, not ads: ads of equal price are summed first (their order doesn't matter), in each task before
the shuffle, so that a snapshot with very many ads is as many window rows as it has prices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .quantiles import exact_quantiles


def verified(book: DataFrame) -> DataFrame:
    """Ads of verified merchants."""
    return book.where("merchant = 1")


def vwap_by_depth(book: DataFrame, percents: tuple[int, ...] = (5, 10, 25, 50)) -> DataFrame:
    """snapshot, side, vwap_<p>: mean price of the first p per cent of the depth; the walk goes up on BUY and down on SELL.

    BUY lists whom a buyer can buy from, so the lowest price is the best; SELL lists whom a seller can sell to.

    An ad of size 0 or less ends the walk at its price, after the ads of the same price that have a size. NULL if nothing
    was taken.
    """
    levels = book.groupBy("snapshot", "side", "price4").agg(F.sum(F.greatest("size", F.lit(0))).alias("size"), F.max((F.col("size") <= 0).cast("int")).alias("ends"))
    best = F.when(F.col("side") == "BUY", F.col("price4")).otherwise(-F.col("price4"))
    order = Window.partitionBy("snapshot", "side").orderBy(best)
    past = order.rowsBetween(Window.unboundedPreceding, -1)
    walked = levels.select(
        "snapshot", "side", "price4", "size",
        F.coalesce(F.sum("size").over(past), F.lit(0)).alias("before"),
        F.coalesce(F.max("ends").over(past), F.lit(0)).alias("ended"),
        F.sum("size").over(Window.partitionBy("snapshot", "side")).alias("total"),
    )

    def vwap(p: int) -> Column:
        # in hundredths of a unit, so that everything stays whole
        take = F.when(F.col("ended") == 1, 0).otherwise(F.greatest(F.lit(0), F.least(F.col("size") * 100, F.col("total") * p - F.col("before") * 100)))
        return (F.sum(F.col("price4") * take) / F.nullif(F.sum(take), F.lit(0)) / 10000.0).alias(f"vwap_{p}")

    return walked.groupBy("snapshot", "side").agg(*[vwap(p) for p in percents])


def spreads(vwaps: DataFrame, percents: tuple[int, ...] = (5, 10, 25, 50)) -> DataFrame:
    """snapshot, spread_<p>: BUY minus SELL; NULL unless both sides have a price other than 0."""
    of = lambda side, p: F.max(F.when(F.col("side") == side, F.nullif(f"vwap_{p}", F.lit(0.0))))
    return vwaps.groupBy("snapshot").agg(*[(of("BUY", p) - of("SELL", p)).alias(f"spread_{p}") for p in percents])


def summary(book: DataFrame) -> DataFrame:
    """snapshot, side, n, lowest, highest, depth."""
    return book.groupBy("snapshot", "side").agg(F.count("*").alias("n"), F.min("price4").alias("lowest"), F.max("price4").alias("highest"), F.sum("size").alias("depth"))


def depth_ratio(book: DataFrame) -> DataFrame:
    """snapshot, depth and count of each side, SELL / BUY depth (NULL without BUY depth)."""
    depth = lambda side: F.coalesce(F.sum(F.when(F.col("side") == side, F.col("size"))), F.lit(0))
    count = lambda side: F.count_if(F.col("side") == side)
    sums = book.groupBy("snapshot").agg(depth("BUY").alias("buy_depth"), depth("SELL").alias("sell_depth"), count("BUY").alias("n_buy"), count("SELL").alias("n_sell"))
    return sums.withColumn("ratio", F.col("sell_depth") / F.nullif("buy_depth", F.lit(0)))


def concentration(book: DataFrame, top: int = 5) -> DataFrame:
    """snapshot, side, share_pct of the `top` traders in the depth; a NULL trader is one trader."""
    each = book.groupBy("snapshot", "side", "trader").agg(F.sum("size").alias("depth"))
    rank = F.row_number().over(Window.partitionBy("snapshot", "side").orderBy(F.desc("depth"), "trader"))
    ranked = each.withColumn("rank", rank)
    share = F.sum(F.when(F.col("rank") <= top, F.col("depth")).otherwise(0)) * 100 / F.nullif(F.sum("depth"), F.lit(0))
    return ranked.groupBy("snapshot", "side").agg(share.alias("share_pct"))


def coverage(book: DataFrame, banks: Column, skip: str = "BANK") -> DataFrame:
    """snapshot, side, bank, n, depth, pct: an ad counts in full for each of its banks; `skip` is left out above the line only."""
    rows = book.select("snapshot", "side", "size", F.explode(banks).alias("bank"))
    each = rows.where(F.col("bank") != skip).groupBy("snapshot", "side", "bank").agg(F.count("*").alias("n"), F.sum("size").alias("depth"))
    totals = book.groupBy("snapshot", "side").agg(F.sum("size").alias("total"))
    return each.join(totals, ["snapshot", "side"]).withColumn("pct", F.col("depth") * 100 / F.nullif("total", F.lit(0))).drop("total")


def traders(book: DataFrame) -> DataFrame:
    """side, trader, n, depth, vwap, share_pct, first_ad: the book of each trader; descriptors come from the least ad_id."""
    each = book.groupBy("side", "trader").agg(
        F.count("*").alias("n"), F.sum("size").alias("depth"), (F.sum(F.col("price4") * F.col("size")) / F.nullif(F.sum("size"), F.lit(0)) / 10000.0).alias("vwap"), F.min("ad_id").alias("first_ad"),
    )
    totals = each.groupBy("side").agg(F.sum("depth").alias("total"))
    return each.join(F.broadcast(totals), "side").withColumn("share_pct", F.col("depth") * 100 / F.nullif("total", F.lit(0))).drop("total")  # a row per side


def top_traders(book: DataFrame, top: int = 10) -> DataFrame:
    """The `top` rows of traders() by depth on each side, with their rank."""
    rank = F.row_number().over(Window.partitionBy("side").orderBy(F.desc("depth"), "trader"))
    return traders(book).withColumn("rank", rank).where(F.col("rank") <= top)


def outliers(book: DataFrame, soft: int = 15, hard: int = 20) -> DataFrame:
    """Every ad with its deviation from the side's mean price: ok, soft or hard. Rows are kept."""
    mean = book.groupBy("snapshot", "side").agg((F.sum(F.col("price4") * F.col("size")) / F.nullif(F.sum("size"), F.lit(0))).alias("mean4"))
    rows = book.join(mean, ["snapshot", "side"])
    off = F.abs(F.col("price4") - F.col("mean4")) * 100
    flag = F.when(off >= hard * F.col("mean4"), "hard").when(off >= soft * F.col("mean4"), "soft").otherwise("ok")
    return rows.withColumn("flag", flag).drop("mean4")


def snapshots(book: DataFrame) -> DataFrame:
    """snapshot, previous: the distinct snapshots, few enough to be ordered in one place."""
    return book.select("snapshot").distinct().withColumn("previous", F.lag("snapshot").over(Window.orderBy("snapshot")))


def flow(book: DataFrame) -> DataFrame:
    """snapshot, side, n, new, gone: traders of each snapshot against the snapshot before; the first has none new or gone."""
    members = book.select("snapshot", "side", "trader").distinct()
    order = snapshots(book)
    ahead = order.where("previous IS NOT NULL").select(F.col("previous"), F.col("snapshot").alias("next"))
    carried = members.withColumnRenamed("snapshot", "previous").join(ahead, "previous").select(F.col("next").alias("snapshot"), "side", "trader")
    both = members.withColumn("now", F.lit(1)).unionByName(carried.withColumn("was", F.lit(1)), allowMissingColumns=True)
    each = both.groupBy("snapshot", "side", "trader").agg(F.max("now").alias("now"), F.max("was").alias("was"))
    first = order.where("previous IS NULL").select(F.col("snapshot").alias("first"))
    counts = each.groupBy("snapshot", "side").agg(F.count("now").alias("n"), F.count_if(F.expr("now IS NOT NULL AND was IS NULL")).alias("new"), F.count_if(F.expr("now IS NULL")).alias("gone"))
    is_first = F.col("first").isNotNull()
    return counts.join(first, F.col("snapshot") == F.col("first"), "left").select("snapshot", "side", "n", F.when(is_first, 0).otherwise(F.col("new")).alias("new"), F.when(is_first, 0).otherwise(F.col("gone")).alias("gone"))


def price_deciles(book: DataFrame, trim: bool = False) -> DataFrame:
    """side, decile, price4: exact deciles 0..10 of the price; trim leaves out the lowest and highest."""
    points = [k / 10 for k in range(1 if trim else 0, 10 if trim else 11)]
    curve = exact_quantiles(book, "side", "price4", points)
    return curve.select("side", F.round(F.col("point") * 10).cast("int").alias("decile"), F.col("value").alias("price4"))


def columnar(vwaps: DataFrame, column: str) -> DataFrame:
    """side and parallel arrays of snapshots and values in the order of time."""
    pairs = F.array_sort(F.collect_list(F.struct("snapshot", F.col(column).alias("value"))))
    packed = vwaps.groupBy("side").agg(pairs.alias("pairs"))
    return packed.select("side", F.transform("pairs", lambda p: p["snapshot"]).alias("snapshots"), F.transform("pairs", lambda p: p["value"]).alias("values"))


def dictionary(book: DataFrame) -> DataFrame:
    """trader, code: traders numbered from 0 by their first snapshot, then by themselves."""
    first = book.groupBy("trader").agg(F.min("snapshot").alias("first"))
    # ranks across blocks: count the traders of earlier snapshots, then rank within the snapshot
    counts = first.groupBy("first").agg(F.count("*").alias("n"))
    before = counts.select("first", (F.sum("n").over(Window.orderBy("first")) - F.col("n")).alias("before"))
    within = F.row_number().over(Window.partitionBy("first").orderBy("trader")) - 1
    return first.withColumn("within", within).join(before, "first").select("trader", (F.col("before") + F.col("within")).alias("code"))


def row_offsets(book: DataFrame) -> DataFrame:
    """snapshot, offset, n: where each snapshot's rows begin in an array ordered by snapshot."""
    counts = book.groupBy("snapshot").agg(F.count("*").alias("n"))
    return counts.select("snapshot", (F.sum("n").over(Window.orderBy("snapshot")) - F.col("n")).alias("offset"), "n")
