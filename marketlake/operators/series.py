"""Operators on daily series and ticks: as-of joins, closes, calendars, gaps, candles, heatmaps.

Windows over a whole series run on one row per day, which a series of centuries fits; ticks are reduced to days, hours or
half hours first. Local time is UTC-4, all year.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

def local(ts: str) -> Column:
    """A UTC timestamp on the local clock."""
    return F.col(ts) - F.expr("INTERVAL 4 HOURS")


def as_of(targets: DataFrame, series: DataFrame, value: str = "rate", strict: bool = False, tolerance_days: int | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """by, fecha, as_of, <value> of the last day of series at or before (strict: before) each target day, of the same key; NULL beyond
    the tolerance.

    Both sides are merged in one order and the last known day is carried along, within each year; what a year begins with is the
    last day known in the years before, found on one row per key and year.
    """
    keys = list(by)
    year = F.year("fecha")
    marks = targets.select(*keys, "fecha").distinct().select(*keys, "fecha", F.lit(0 if strict else 1).alias("turn"), F.lit(None).cast("date").alias("day"), F.lit(None).cast(series.schema[value].dataType).alias("v"))
    known = series.select(*keys, "fecha", F.lit(1 if strict else 0).alias("turn"), F.col("fecha").alias("day"), F.col(value).alias("v"))
    rows = marks.union(known).withColumn("__year", year)
    last = lambda c: F.last(c, ignorenulls=True)
    order = Window.partitionBy(*keys, "__year").orderBy("fecha", "turn").rowsBetween(Window.unboundedPreceding, 0)
    here = rows.withColumn("k", last(F.when(F.col("day").isNotNull(), F.struct("day", "v"))).over(order))
    ends = rows.groupBy(*keys, "__year").agg(F.max_by(F.struct("day", "v"), F.when(F.col("day").isNotNull(), F.struct("fecha", "turn"))).alias("end"))
    ends = ends.withColumn("end", F.when(F.col("end.day").isNotNull(), F.col("end")))
    past = Window.partitionBy(*keys).orderBy("__year").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("before", last("end").over(past)).select(*[F.col(k).alias(f"__{k}") for k in keys], F.col("__year").alias("__y"), "before")
    same = F.col("__year") == F.col("__y")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    asked = here.where("day IS NULL").join(ends, same)
    known_day = F.coalesce("k", "before")
    out = asked.select(*keys, "fecha", known_day["day"].alias("as_of"), known_day["v"].alias(value))
    if tolerance_days is None:
        return out
    near = F.datediff("fecha", "as_of") <= tolerance_days
    return out.select(*keys, "fecha", F.when(near, F.col("as_of")).alias("as_of"), F.when(near, F.col(value)).alias(value))


def nearest(targets: DataFrame, series: DataFrame, value: str = "rate") -> DataFrame:
    """fecha, nearest, <value>: the closest day of series, the earlier of two as close. From the neighbours on either side."""
    back = as_of(targets, series, value).withColumnsRenamed({"as_of": "b", value: "bv"})
    turned = lambda df: df.withColumn("fecha", F.date_sub(F.lit("2200-01-01").cast("date"), F.datediff("fecha", F.lit("1800-01-01").cast("date"))))
    ahead = as_of(turned(targets), turned(series.select("fecha", value)), value)
    ahead = turned(ahead).select("fecha", F.date_sub(F.lit("2200-01-01").cast("date"), F.datediff("as_of", F.lit("1800-01-01").cast("date"))).alias("a"), F.col(value).alias("av"))
    both = back.join(ahead, "fecha")
    use_back = F.col("a").isNull() | (F.col("b").isNotNull() & (F.datediff("fecha", "b") <= F.datediff("a", "fecha")))
    return both.select("fecha", F.when(use_back, F.col("b")).otherwise(F.col("a")).alias("nearest"), F.when(use_back, F.col("bv")).otherwise(F.col("av")).alias(value))


def redated_weekends(series: DataFrame) -> DataFrame:
    """fecha, <columns>: weekend days move to Monday; a Monday that is there wins, then Saturday."""
    day = F.weekday("fecha")
    moved = series.withColumn("old", F.col("fecha")).withColumn("weekend", (day >= 5).cast("int")).withColumn("fecha", F.when(day >= 5, F.date_add("fecha", 7 - day)).otherwise(F.col("fecha")))
    rank = F.row_number().over(Window.partitionBy("fecha").orderBy("weekend", "old"))
    return moved.withColumn("k", rank).where("k = 1").drop("k", "old", "weekend")


def calendar(series: DataFrame) -> DataFrame:
    """Every day from the first to the last of series."""
    ends = series.agg(F.min("fecha").alias("a"), F.max("fecha").alias("b")).where("a IS NOT NULL")
    return ends.select(F.explode(F.sequence("a", "b")).alias("fecha"))


def weekend_fill(series: DataFrame, value: str = "rate") -> DataFrame:
    """series, and a tagged row for each missing weekend day with the last strictly earlier weekday's value."""
    missing = calendar(series).where(F.weekday("fecha") >= 5).join(series.select("fecha"), "fecha", "left_anti")
    filled = as_of(missing, series.where(F.weekday("fecha") < 5), value, strict=True).where("as_of IS NOT NULL")
    return series.select("fecha", value, F.lit(0).alias("filled")).union(filled.select("fecha", value, F.lit(1)))


def closes(ticks: DataFrame, value: str = "cents") -> DataFrame:
    """fecha, <value>: the last non-null value of each local day."""
    last = F.max_by(F.struct(value), F.struct("ts", "event_id"))
    return ticks.where(F.col(value).isNotNull()).groupBy(F.to_date(local("ts")).alias("fecha")).agg(last.alias("x")).select("fecha", f"x.{value}")


def with_deltas(daily: DataFrame, value: str = "cents") -> DataFrame:
    """fecha, <value>, day_delta, week_delta: against the closes of the day before and seven days before, as of then."""
    day = lambda n: daily.select(F.date_sub("fecha", n).alias("fecha"))
    before = as_of(day(1), daily, value).select(F.date_add("fecha", 1).alias("fecha"), F.col(value).alias("d"))
    week = as_of(day(7), daily, value).select(F.date_add("fecha", 7).alias("fecha"), F.col(value).alias("w"))
    return daily.join(before, "fecha").join(week, "fecha").select("fecha", value, (F.col(value) - F.col("d")).alias("day_delta"), (F.col(value) - F.col("w")).alias("week_delta"))


def last_in_bucket(ticks: DataFrame, unit: str, value: str = "cents") -> DataFrame:
    """bucket, ts, <value> of the last tick of each UTC hour or day."""
    bucket = F.date_trunc(unit, "ts").cast("timestamp_ntz")
    return ticks.groupBy(bucket.alias("bucket")).agg(F.max_by(F.struct("ts", value), F.struct("ts", "event_id")).alias("x")).select("bucket", "x.*")


def gaps(ticks: DataFrame, minutes: int = 20) -> DataFrame:
    """start, end, minutes of every stretch of more than `minutes` between neighbouring ticks.

    Ticks of one hour are ordered in the hour; only its first and last tick meet those of other hours.
    """
    hours = ticks.select("ts").distinct().withColumn("hour", F.date_trunc("hour", "ts"))
    inside = hours.withColumn("next", F.lead("ts").over(Window.partitionBy("hour").orderBy("ts"))).where("next IS NOT NULL").select("ts", "next")
    ends = hours.groupBy("hour").agg(F.min("ts").alias("first"), F.max("ts").alias("ts"))
    across = ends.withColumn("next", F.lead("first").over(Window.orderBy("hour"))).where("next IS NOT NULL").select("ts", "next")
    seconds = F.unix_micros(F.col("next").cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp"))
    return inside.union(across).where(seconds > minutes * 60_000_000).select(F.col("ts").alias("start"), F.col("next").alias("end"), F.floor((seconds + 30_000_000) / 60_000_000).cast("long").alias("minutes"))


def busy_spells(ticks: DataFrame, minutes: int = 20) -> DataFrame:
    """start, last, n (different times) of each stretch without a gap of `minutes` or more.

    As in gaps(), times are ordered within their hour, where spells that both begin and end inside it are complete; only
    spells that touch an hour's first or last time meet those of other hours, one or two rows per hour.
    """
    micros = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    wide = minutes * 60_000_000
    hours = ticks.select("ts").where("ts IS NOT NULL").distinct().withColumn("hour", F.date_trunc("hour", "ts"))
    order = Window.partitionBy("hour").orderBy("ts")
    opens = F.coalesce(micros("ts") - micros("before") >= wide, F.lit(False)).cast("int")
    inside = hours.withColumn("before", F.lag("ts").over(order)).withColumn("k", F.sum(opens).over(order))
    spells = inside.groupBy("hour", "k").agg(F.min("ts").alias("start"), F.max("ts").alias("last"), F.count("*").alias("n"))
    of_hour = Window.partitionBy("hour")
    edge = (F.col("k") == 0) | (F.col("k") == F.max("k").over(of_hour))
    spells = spells.withColumn("edge", edge)
    line = Window.orderBy("start")  # two rows per hour at most
    met = spells.where("edge").withColumn("before", F.lag("last").over(line))
    met = met.withColumn("k", F.sum(F.coalesce(micros("start") - micros("before") >= wide, F.lit(True)).cast("int")).over(line))
    joined = met.groupBy("k").agg(F.min("start").alias("start"), F.max("last").alias("last"), F.sum("n").alias("n"))
    return spells.where("NOT edge").select("start", "last", "n").union(joined.select("start", "last", "n"))


def candles(ticks: DataFrame, minutes: int = 30, keep: int = 48, value: str = "cents") -> DataFrame:
    """start, open, high, low, close, volume of the last `keep` windows that have ticks."""
    key = F.struct("ts", "event_id")
    window = F.window("ts", f"{minutes} minutes")["start"]
    made = ticks.groupBy(window.alias("start")).agg(F.min_by(value, key).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, key).alias("close"), F.count("*").alias("volume"))
    return made.orderBy(F.desc("start")).limit(keep)


def hourly_means(ticks: DataFrame, value: str = "cents") -> DataFrame:
    """hour (0 to 23, local), mean; NULL for hours without ticks."""
    hours = ticks.sparkSession.range(24).select(F.col("id").cast("int").alias("hour"))
    means = ticks.groupBy(F.hour(local("ts")).alias("hour")).agg((F.sum(value) / F.count(value)).alias("mean"))
    return hours.join(F.broadcast(means), "hour", "left")  # 24 rows


def week_matrix(ticks: DataFrame, value: str = "cents") -> DataFrame:
    """weekday (Monday 0), h0 to h23: sums by local weekday and hour, 0 where there are none."""
    days = ticks.sparkSession.range(7).select(F.col("id").cast("int").alias("weekday"))
    rows = ticks.select(F.weekday(local("ts")).alias("weekday"), F.hour(local("ts")).alias("hour"), value)
    sums = rows.groupBy("weekday").agg(*[F.sum(F.when(F.col("hour") == h, F.col(value))).alias(f"h{h}") for h in range(24)])
    return days.join(F.broadcast(sums), "weekday", "left").na.fill(0)  # 7 rows


def change_pct(daily: DataFrame, value: str = "cents") -> DataFrame:
    """fecha, <value>, pct: change against the day before; NULL unless that is above 0."""
    before = F.lag(value).over(Window.orderBy("fecha"))
    return daily.select("fecha", value, F.when(before > 0, (F.col(value) - before) * 100 / before).alias("pct"))


def observation_deltas(daily: DataFrame, value: str = "rate", last: int = 1260, steps: tuple[int, ...] = (1, 21)) -> DataFrame:
    """The last observations with their change over 1 and 21 observations."""
    order = Window.orderBy("fecha")
    rows = daily.select("fecha", value, *[(F.col(value) - F.lag(value, n).over(order)).alias(f"d{n}") for n in steps], F.row_number().over(Window.orderBy(F.desc("fecha"))).alias("k"))
    return rows.where(F.col("k") <= last).drop("k")


def retention(days: DataFrame, daily: int = 7, weekly: int = 4, monthly: int = 3) -> DataFrame:
    """fecha, rule: newest days, then the oldest of each ISO week before them, then of each month before those."""
    all_days = days.select("fecha").distinct()
    ranked = all_days.withColumn("k", F.row_number().over(Window.orderBy(F.desc("fecha"))))
    first = ranked.where(F.col("k") <= daily).select("fecha", F.lit("daily").alias("rule"))
    rest = ranked.where(F.col("k") > daily).select("fecha", F.expr("extract(YEAROFWEEK FROM fecha) * 100 + weekofyear(fecha)").alias("week"))
    rest = rest.withColumn("w", F.dense_rank().over(Window.orderBy(F.desc("week"))))
    weeks = rest.where(F.col("w") <= weekly).groupBy("week").agg(F.min("fecha").alias("fecha")).select("fecha", F.lit("weekly").alias("rule"))
    older = rest.where(F.col("w") > weekly).withColumn("m", F.dense_rank().over(Window.orderBy(F.desc(F.date_trunc("month", "fecha")))))
    months = older.where(F.col("m") <= monthly).groupBy("m").agg(F.min("fecha").alias("fecha")).select("fecha", F.lit("monthly").alias("rule"))
    return first.union(weeks).union(months)


def visitors_to_date(visits: DataFrame) -> DataFrame:
    """fecha, visitors, month_to_date of visits (user_id, fecha): a visitor counts in the month from the first day there on, so the running
    number is a sum over days, and a user is one row per day and month."""
    daily = visits.distinct()
    first = daily.groupBy("user_id", F.date_format("fecha", "yyyy-MM").alias("month")).agg(F.min("fecha").alias("fecha"))
    new = first.groupBy("fecha").agg(F.count("*").alias("new"))
    days = daily.groupBy("fecha").agg(F.count("user_id").alias("visitors")).join(new, "fecha", "left")
    so_far = F.sum(F.coalesce("new", F.lit(0))).over(Window.partitionBy(F.date_format("fecha", "yyyy-MM")).orderBy("fecha"))
    return days.select("fecha", "visitors", so_far.alias("month_to_date"))
