"""Operators on long facts and trade records: pivots, overlays, contributions, cubes, top-N with others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def dense(facts: DataFrame, slugs: list[str]) -> DataFrame:
    """periodo and a column for each slug; NULL where there is no fact."""
    return facts.groupBy("periodo").agg(*[F.sum(F.when(F.col("slug") == s, F.col("valor"))).alias(s) for s in slugs])


def long(wide: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """key, slug, valor of the non-null cells."""
    return wide.unpivot([key], columns, "slug", "valor").where("valor IS NOT NULL")


def contributions(facts: DataFrame, published: DataFrame, tolerance: float | None = None) -> DataFrame:
    """periodo, slug, contribution: weight times the change against the same month of the year before, in per cent of the
    published total (periodo, total) then. facts has periodo (yyyy-MM), slug, valor, weight.

    With a tolerance, a month is left out whole unless its contributions add up to the published total's change (in per cent).
    """
    number = F.substring("periodo", 1, 4).cast("int") * 12 + F.substring("periodo", 6, 2).cast("int")
    rows, totals = facts.withColumn("n", number), published.select(number.alias("n"), "total")
    then = rows.select((F.col("n") + 12).alias("n"), "slug", F.col("valor").alias("before"))
    base = totals.select((F.col("n") + 12).alias("n"), F.col("total").alias("was"))
    both = rows.join(then, ["n", "slug"]).join(base, "n")
    out = both.select("n", "periodo", "slug", (F.col("weight") * (F.col("valor") - F.col("before")) * 100 / F.col("was")).alias("contribution"))
    if tolerance is not None:
        change = totals.join(base, "n").select("n", ((F.col("total") - F.col("was")) * 100 / F.col("was")).alias("change"))
        sums = out.groupBy("n").agg(F.sum("contribution").alias("sum")).join(change, "n")
        out = out.join(sums.where(F.abs(F.col("sum") - F.col("change")) <= tolerance).select("n"), "n", "left_semi")
    return out.drop("n")


def top_with_others(rows: DataFrame, group: str, member: str, value: str, top: int, others: str = "OTHERS") -> DataFrame:
    """group, member, value of the `top` members of each group, and of all others together."""
    sums = rows.groupBy(group, member).agg(F.sum(value).alias(value))
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.desc(value), member))
    named = sums.withColumn(member, F.when(rank <= top, F.col(member)).otherwise(others))
    return named.groupBy(group, member).agg(F.sum(value).alias(value))


def first_prefix_rule(code: str, rules: list[tuple[str, list[str], list[str]]]) -> Column:
    """The key of the first rule one of whose prefixes the code has, and none of whose exclusions; NULL if none."""
    out = []
    for key, includes, excludes in rules:
        hit, miss = F.lit(False), F.lit(False)
        for p in includes:
            hit = hit | F.col(code).startswith(p)
        for p in excludes:
            miss = miss | F.col(code).startswith(p)
        out.append(F.when(hit & ~miss, key))
    return F.coalesce(*out)


def modal(rows: DataFrame, key: str, label: str) -> DataFrame:
    """key and its most frequent label, the least on ties."""
    counts = rows.groupBy(key, label).agg(F.count("*").alias("n"))
    return counts.groupBy(key).agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias(label))


def in_polygon(points: DataFrame, edges: DataFrame, across: int = 8) -> DataFrame:
    """points (id, x, y, ...) with the name of the first polygon (least order) that holds them, by ray casting; NULL if none does.

    edges (name, order, x1, y1, x2, y2) are outlines. Each polygon has a grid whose cells are a power of two wide, so that it lies in
    some `across` columns and rows whatever its size; an edge is filed in the rows that it passes, under all columns of its polygon. A
    point looks up its own cell in the grids of the sizes that occur, an equality join, and counts the edges to its right.
    """
    low, high = lambda a, b: F.least(a, b), lambda a, b: F.greatest(a, b)
    boxes = edges.groupBy("name", "order").agg(F.min(low("x1", "x2")).alias("x0"), F.max(high("x1", "x2")).alias("x9"), F.min(low("y1", "y2")).alias("y0"), F.max(high("y1", "y2")).alias("y9"))
    size = F.greatest(F.col("x9") - F.col("x0"), F.col("y9") - F.col("y0"), F.lit(1e-9))
    boxes = boxes.withColumn("level", F.ceil(F.log2(size / across)).cast("int"))
    cell = lambda x: F.floor(F.col(x) / F.pow(F.lit(2.0), F.col("level"))).cast("long")
    columns = F.explode(F.sequence(cell("x0"), cell("x9"))).alias("column")
    filed = edges.join(boxes, ["name", "order"]).where("y1 <> y2").withColumns({"lo": low("y1", "y2"), "hi": high("y1", "y2")})
    filed = filed.select("*", F.explode(F.sequence(cell("lo"), cell("hi"))).alias("row")).select("level", "row", "name", "order", "x1", "y1", "x2", "y2", "x0", "x9", columns)
    # the sizes that occur: a few powers of two
    levels = boxes.agg(F.collect_set("level").alias("levels"))
    asked = points.where("x IS NOT NULL AND y IS NOT NULL").select("id", "x", "y").crossJoin(F.broadcast(levels)).select("id", "x", "y", F.explode("levels").alias("level"))
    asked = asked.select("*", cell("x").alias("column"), cell("y").alias("row"))
    crossing = ((F.col("y1") > F.col("y")) != (F.col("y2") > F.col("y"))) & (F.col("x") < (F.col("x2") - F.col("x1")) * (F.col("y") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1"))
    hits = asked.join(filed, ["level", "row", "column"]).where(crossing).groupBy("id", "name", "order").agg(F.count("*").alias("n")).where("n % 2 = 1")
    first = hits.groupBy("id").agg(F.min_by("name", "order").alias("name"))
    return points.join(first, "id", "left")


def index_weights(wide: DataFrame, parts: list[str], total: str, most_error: float = 0.02, sum_error: float = 0.001) -> DataFrame:
    """part, weight: fixed weights with which the parts make up the total, by least squares; no rows unless they are sound.

    Sound: at least len(parts) + 12 whole rows, each row made within most_error, weights above 0 with a sum of 1 within
    sum_error. The normal equations are sums over the rows; only their len(parts)^2 numbers are solved on the driver.
    """
    import numpy as np

    spark, n = wide.sparkSession, len(parts)
    whole = wide.select(*[F.col(c).cast("double").alias(c) for c in (*parts, total)]).dropna()
    columns = [*parts, total]
    sums = whole.agg(F.count("*").alias("n"), *[F.sum(F.col(a) * F.col(b)).alias(f"{i}_{j}") for i, a in enumerate(parts) for j, b in enumerate(columns)]).first()
    schema, none = "part string, weight double", []
    if sums["n"] < n + 12:
        return spark.createDataFrame(none, schema)
    matrix = np.array([[sums[f"{i}_{j}"] for j in range(n)] for i in range(n)])
    if np.linalg.matrix_rank(matrix) < n:
        return spark.createDataFrame(none, schema)
    weights = [float(w) for w in np.linalg.solve(matrix, np.array([sums[f"{i}_{n}"] for i in range(n)]))]
    made = sum((F.col(c) * w for c, w in zip(parts, weights, strict=True)), F.lit(0.0))
    error = whole.agg(F.max(F.abs(made - F.col(total))).alias("e")).first()["e"]
    sound = error <= most_error and abs(sum(weights) - 1) <= sum_error and min(weights) > 0
    return spark.createDataFrame(list(zip(parts, weights, strict=True)) if sound else none, schema)


def open_days(readings: DataFrame, places: DataFrame, sections: DataFrame, decimals: int = 3) -> DataFrame:
    """lat, lon, days, section: different days with an open incident in each cell, and the section named there most often.

    readings has fecha, open (array of ids); places id, lat, lon; sections lat, lon, section. Of sections named as often the
    least name counts.
    """
    seen = readings.select("fecha", F.explode("open").alias("id")).join(places, "id")
    named = seen.join(sections, ["lat", "lon"], "left").withColumns({"cell_lat": F.round("lat", decimals), "cell_lon": F.round("lon", decimals)})
    cell = ["cell_lat", "cell_lon"]
    days = named.groupBy(*cell).agg(F.countDistinct("fecha").alias("days"))
    votes = named.where("section IS NOT NULL").groupBy(*cell, "section").agg(F.count("*").alias("n"))
    best = votes.groupBy(*cell).agg(F.min_by("section", F.struct(-F.col("n"), F.col("section"))).alias("section"))
    return days.join(best, cell, "left").select(F.col("cell_lat").alias("lat"), F.col("cell_lon").alias("lon"), "days", "section")


def located(readings: DataFrame, places: DataFrame, sections: DataFrame) -> DataFrame:
    """id, lat, lon, section of the incidents that are open at the last reading; without a place they are left out."""
    last = readings.agg(F.max_by("open", "ts").alias("open")).select(F.explode("open").alias("id"))
    return last.join(places, "id").join(sections, ["lat", "lon"], "left").select("id", "lat", "lon", "section")


def tiers(orders: int = 100, completed: float = 0.95, size: float = 500, some_orders: int = 20) -> Column:
    """Of the columns merchant, orders, completed, size (NULL counts as 0): A for merchants with at least so many orders, such a
    share completed and such a size; B for other merchants and whoever has some_orders; else C."""
    have = {c: F.coalesce(c, F.lit(0)) for c in ("merchant", "orders", "completed", "size")}
    merchant = have["merchant"] == 1
    best = merchant & (have["orders"] >= orders) & (have["completed"] >= completed) & (have["size"] >= size)
    return F.when(best, "A").when(merchant | (have["orders"] >= some_orders), "B").otherwise("C")


def categories(event: Column, of: dict[str, str], filtered: list[str], rest: str = "other") -> Column:
    """The category of an event by a map; rest for unknown ones, NULL for those that are none (filtered)."""
    known = F.create_map(*[F.lit(x) for pair in of.items() for x in pair])
    return F.when(F.coalesce(event, F.lit("")).isin(filtered), None).otherwise(F.coalesce(known[event], F.lit(rest)))


def active_days(ranges: DataFrame, keys: list[str], since: str, last_reading: Column) -> DataFrame:
    """keys, days: different days on which a range (start, end; NULL while it lasts) is open, from `since` to the last reading.

    Of ranges of one first day the longest counts; each adds the days after all that began before it. No day is a row of its own."""
    start, end = F.greatest("start", F.lit(since).cast("date")), F.least(F.coalesce("end", last_reading), last_reading)
    open_ = ranges.where(start <= end).select(*keys, start.alias("first"), end.alias("last"))
    longest = open_.groupBy(*keys, "first").agg(F.max("last").alias("last"))  # a key has a row for each day at most
    before = F.max("last").over(Window.partitionBy(*keys).orderBy("first").rowsBetween(Window.unboundedPreceding, -1))
    new = F.datediff("last", F.greatest(F.date_sub("first", 1), "before"))
    return longest.withColumn("before", before).groupBy(*keys).agg(F.sum(F.greatest(new, F.lit(0)).cast("long")).alias("days"))


def sparse_fields(columns: list[str]) -> Column:
    """Map of the columns that aren't NULL, as text."""
    pairs = [x for c in columns for x in (F.lit(c), F.col(c).cast("string"))]
    return F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull())


def crosswalk(rows: DataFrame, by_code: DataFrame, by_name: DataFrame, region: str = "region", name: str = "name") -> tuple[DataFrame, DataFrame]:
    """(rows with target, rows that match nothing): by code first (code, target), then by region and name (region, name, target) where
    these name one target only."""
    unique = by_name.groupBy(region, name).agg(F.countDistinct("target").alias("n"), F.min("target").alias("by_name")).where("n = 1").drop("n")
    codes = by_code.select("code", F.col("target").alias("by_code"))
    both = rows.join(codes, "code", "left").join(unique, [region, name], "left").withColumn("target", F.coalesce("by_code", "by_name")).drop("by_code", "by_name")
    return both.where("target IS NOT NULL"), both.where("target IS NULL").drop("target")


def fingerprint(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row with a number for each column and for the whole table, and n: equal for tables of the same rows in any order.

    Sums modulo 2^60 of hashes of the values as text, so repeated rows count; NULL is unlike an empty text.
    """
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("NULL"))
    number = lambda t: F.conv(F.substring(F.md5(t), 1, 12), 16, 10).cast("long")
    total = lambda t: F.pmod(F.sum(number(t).cast("decimal(20,0)")), F.lit(1 << 60).cast("decimal(20,0)")).cast("long")
    return rows.agg(*[total(text(c)).alias(c) for c in columns], total(F.concat_ws("|", *[text(c) for c in columns])).alias("whole"), F.count("*").alias("n"))
