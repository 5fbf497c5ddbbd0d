"""Queries over ticks and daily series."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import BOOK, RATE, TICK, book, rate, tick
from ..operators import series as op
from ..registry import query
from ..session import table
from ..sources.tables import insert_absent, merge_fields

DAYS = "days AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS fecha FROM lineitem)"
GOOD_RATE = RATE + ", thin AS (SELECT * FROM rate WHERE isodow(fecha) <= 5)"


def days(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("fecha")).distinct()


def thin(spark, sf_dir):
    """Official rates: none on weekends."""
    return rate(spark, sf_dir).where("weekday(fecha) < 5")


@query("j03_as_of_backward", f"WITH {GOOD_RATE}, {DAYS} SELECT d.fecha, CASE WHEN date_diff('day', t.fecha, d.fecha) <= 11 THEN t.fecha END AS as_of, CASE WHEN date_diff('day', t.fecha, d.fecha) <= 11 THEN t.rate END AS rate FROM days d ASOF LEFT JOIN thin t ON d.fecha >= t.fecha")
def j03(spark, sf_dir):
    return op.as_of(days(spark, sf_dir), thin(spark, sf_dir), tolerance_days=11)


@query("j04_as_of_strictly_before", f"WITH {GOOD_RATE}, {DAYS} SELECT d.fecha, t.fecha AS as_of, t.rate FROM days d ASOF LEFT JOIN thin t ON d.fecha > t.fecha")
def j04(spark, sf_dir):
    return op.as_of(days(spark, sf_dir), thin(spark, sf_dir), strict=True)


@query("j05_nearest_day", f"WITH {GOOD_RATE}, {DAYS} SELECT d.fecha, arg_min(t.fecha, (abs(date_diff('day', t.fecha, d.fecha)), t.fecha)) AS nearest, arg_min(t.rate, (abs(date_diff('day', t.fecha, d.fecha)), t.fecha)) AS rate FROM days d, thin t GROUP BY d.fecha")
def j05(spark, sf_dir):
    return op.nearest(days(spark, sf_dir), thin(spark, sf_dir))


@query("j19_premium_over_official", f"WITH {BOOK}, {GOOD_RATE}, p AS (SELECT CAST(snapshot AS DATE) AS fecha, CAST(sum(price4 * size) AS DOUBLE) / sum(size) AS price FROM book WHERE merchant = 1 GROUP BY 1) SELECT p.fecha, price / t.rate - 1 AS premium FROM p ASOF LEFT JOIN thin t ON p.fecha >= t.fecha")
def j19(spark, sf_dir):
    prices = book(spark, sf_dir).where("merchant = 1").groupBy(F.to_date("snapshot").alias("fecha")).agg((F.sum(F.col("price4") * F.col("size")) / F.sum("size")).alias("price"))
    return prices.join(op.as_of(prices, thin(spark, sf_dir)), "fecha").select("fecha", (F.col("price") / F.col("rate") - 1).alias("premium"))


WEEKENDS = "(isodow(fecha) >= 6)"


@query("w09_weekends_redated", f"WITH {GOOD_RATE}, m AS (SELECT CASE WHEN {WEEKENDS} THEN CAST(fecha + CAST(8 - isodow(fecha) AS INTEGER) AS DATE) ELSE fecha END AS new, rate, row_number() OVER (PARTITION BY CASE WHEN {WEEKENDS} THEN CAST(fecha + CAST(8 - isodow(fecha) AS INTEGER) AS DATE) ELSE fecha END ORDER BY {WEEKENDS}, fecha) AS k FROM thin) SELECT new AS fecha, rate FROM m WHERE k = 1")
def w09(spark, sf_dir):
    return op.redated_weekends(thin(spark, sf_dir))


@query("w10_weekend_fill", f"""WITH {GOOD_RATE}, c AS (SELECT CAST(unnest(generate_series(min(fecha), max(fecha), INTERVAL 1 DAY)) AS DATE) AS fecha FROM thin), x AS (SELECT fecha FROM c WHERE {WEEKENDS} EXCEPT SELECT fecha FROM thin),
 w AS (SELECT * FROM thin WHERE NOT {WEEKENDS}) SELECT fecha, rate, 0 AS filled FROM thin UNION ALL SELECT x.fecha, w.rate, 1 FROM x ASOF JOIN w ON x.fecha > w.fecha""")
def w10(spark, sf_dir):
    return op.weekend_fill(thin(spark, sf_dir))


LOCAL = "(ts - INTERVAL 4 HOUR)"
CLOSES = TICK + f", closes AS (SELECT CAST({LOCAL} AS DATE) AS fecha, arg_max(cents, (ts, event_id)) AS cents FROM tick WHERE cents IS NOT NULL GROUP BY 1)"


@query("w06_daily_closes", f"WITH {CLOSES} SELECT * FROM closes")
def w06(spark, sf_dir):
    return op.closes(tick(spark, sf_dir))


@query("w07_last_value", f"WITH {TICK} SELECT event_type, arg_max(cents, (ts, event_id)) AS cents FROM tick WHERE cents IS NOT NULL GROUP BY event_type")
def w07(spark, sf_dir):
    return tick(spark, sf_dir).where("cents IS NOT NULL").groupBy("event_type").agg(F.max_by("cents", F.struct("ts", "event_id")).alias("cents"))


@query("w08_deltas", f"WITH {CLOSES} SELECT c.fecha, c.cents, c.cents - d.cents AS day_delta, c.cents - w.cents AS week_delta FROM closes c ASOF LEFT JOIN closes d ON c.fecha - 1 >= d.fecha ASOF LEFT JOIN closes w ON c.fecha - 7 >= w.fecha")
def w08(spark, sf_dir):
    return op.with_deltas(op.closes(tick(spark, sf_dir)))


@query("w03_last_of_hour", f"WITH {TICK} SELECT date_trunc('hour', ts) AS bucket, arg_max(ts, (ts, event_id)) AS ts, arg_max(cents, (ts, event_id)) AS cents FROM tick GROUP BY 1")
def w03(spark, sf_dir):
    return op.last_in_bucket(tick(spark, sf_dir), "hour")


@query("w03_last_of_day", f"WITH {TICK} SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) :: TIMESTAMP AS bucket, arg_max(ts, (ts, event_id)) AS ts, arg_max(cents, (ts, event_id)) AS cents FROM tick GROUP BY 1")
def w03_day(spark, sf_dir):
    return op.last_in_bucket(tick(spark, sf_dir), "day")


@query("w04_gaps", f'WITH {TICK}, g AS (SELECT ts AS start, lead(ts) OVER (ORDER BY ts) AS "end" FROM (SELECT DISTINCT ts FROM tick)) SELECT start, "end", CAST((epoch_us("end") - epoch_us(start) + 30000000) // 60000000 AS BIGINT) AS minutes FROM g WHERE epoch_us("end") - epoch_us(start) > 1200000000')
def w04(spark, sf_dir):
    return op.gaps(tick(spark, sf_dir))


@query("w27_candles", f"WITH {TICK} SELECT time_bucket(INTERVAL 30 MINUTE, ts) AS start, arg_min(cents, (ts, event_id)) AS open, max(cents) AS high, min(cents) AS low, arg_max(cents, (ts, event_id)) AS close, count(*) AS volume FROM tick GROUP BY 1 ORDER BY 1 DESC LIMIT 48")
def w27(spark, sf_dir):
    return op.candles(tick(spark, sf_dir))


@query("a07_hourly_means", f"WITH {TICK}, m AS (SELECT CAST(hour({LOCAL}) AS INTEGER) AS hour, CAST(sum(cents) AS DOUBLE) / count(cents) AS mean FROM tick GROUP BY 1) SELECT CAST(h AS INTEGER) AS hour, mean FROM range(24) r(h) LEFT JOIN m ON m.hour = h")
def a07(spark, sf_dir):
    return op.hourly_means(tick(spark, sf_dir))


@query("a08_week_matrix", f"WITH {TICK}, t AS (SELECT isodow({LOCAL}) - 1 AS weekday, hour({LOCAL}) AS hour, cents FROM tick) SELECT CAST(d AS INTEGER) AS weekday, " + ", ".join(f"CAST(coalesce(sum(cents) FILTER (hour = {h}), 0) AS BIGINT) AS h{h}" for h in range(24)) + " FROM range(7) r(d) LEFT JOIN t ON t.weekday = d GROUP BY d")
def a08(spark, sf_dir):
    return op.week_matrix(tick(spark, sf_dir))


@query("a09_latest_report", "SELECT o_orderkey, o_custkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)")
def a09(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("d"))
    return orders.join(F.broadcast(orders.agg(F.max("d").alias("d"))), "d").drop("d")  # one row


@query("w11_staleness", f"WITH {RATE} SELECT max(fecha) AS last, max(fecha) < DATE '2030-01-01' AS stale FROM rate")
def w11(spark, sf_dir):
    return rate(spark, sf_dir).agg(F.max("fecha").alias("last"), (F.max("fecha") < F.lit("2030-01-01").cast("date")).alias("stale"))


@query("w14_year_rollover", f"WITH {RATE}, p AS (SELECT fecha, month(fecha) AS m, lag(month(fecha)) OVER (ORDER BY fecha) AS b FROM rate) SELECT fecha, CAST((SELECT min(year(fecha)) FROM rate) + coalesce(sum(CAST(m < b AS INTEGER)) OVER (ORDER BY fecha), 0) AS INTEGER) AS inferred_year FROM p")
def w14(spark, sf_dir):
    rows = rate(spark, sf_dir).select("fecha", F.month("fecha").alias("m"))
    rows = rows.withColumn("fell", F.coalesce((F.col("m") < F.lag("m").over(Window.orderBy("fecha"))).cast("int"), F.lit(0)))
    start = F.year(F.min("fecha").over(Window.orderBy("fecha")))
    return rows.select("fecha", (start + F.sum("fell").over(Window.orderBy("fecha"))).cast("int").alias("inferred_year"))


@query("w15_rolling_volatility", f"WITH {CLOSES}, v AS (SELECT fecha, CASE WHEN count(*) OVER w >= 3 THEN stddev_samp(cents) OVER w END AS v FROM closes WINDOW w AS (ORDER BY fecha ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)) SELECT fecha, round(v, 4) AS volatility FROM v")
def w15(spark, sf_dir):
    order = Window.orderBy("fecha").rowsBetween(-5, 0)
    closes = op.closes(tick(spark, sf_dir))
    return closes.select("fecha", F.round(F.when(F.count("*").over(order) >= 3, F.stddev_samp("cents").over(order)), 4).alias("volatility"))


HOURS = f"{TICK}, h AS (SELECT date_trunc('hour', ts) AS hora, arg_max(cents, (ts, event_id)) AS cents FROM tick GROUP BY 1)"


@query("w15_volatility_per_hour", f"WITH {TICK} SELECT date_trunc('hour', ts) AS hora, count(*) AS n, round(stddev_samp(cents), 4) AS volatility FROM tick GROUP BY 1")
def w15_hour(spark, sf_dir):
    """Within each hour; an hour of one tick has none."""
    hours = tick(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").alias("hora")).agg(F.count("*").alias("n"), F.stddev_samp("cents").alias("v"))
    return hours.select("hora", "n", F.when(F.col("n") > 1, F.round("v", 4)).alias("volatility"))


@query("w15_volatility_of_snapshots", f"WITH {HOURS} SELECT hora, CASE WHEN count(*) OVER w >= 3 THEN round(stddev_samp(cents) OVER w, 4) END AS volatility FROM h WINDOW w AS (PARTITION BY CAST(hora AS DATE) ORDER BY hora ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)")
def w15_snapshots(spark, sf_dir):
    """Over the last six hourly snapshots of the day."""
    hours = tick(spark, sf_dir).groupBy(F.date_trunc("hour", "ts").alias("hora")).agg(F.max_by("cents", F.struct("ts", "event_id")).alias("cents"))
    order = Window.partitionBy(F.to_date("hora")).orderBy("hora").rowsBetween(-5, 0)
    return hours.select("hora", F.when(F.count("*").over(order) >= 3, F.round(F.stddev_samp("cents").over(order), 4)).alias("volatility"))


@query("w24_bounded_history", f"WITH {TICK} SELECT event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS k FROM tick) WHERE k <= 20")
def w24(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("event_type").orderBy(F.desc("ts"), F.desc("event_id")))
    return tick(spark, sf_dir).withColumn("k", k).where("k <= 20").select("event_type", "event_id")


@query("w25_level_anchoring", f"WITH {RATE}, a AS (SELECT 20000000 - arg_min(rate, (abs(date_diff('day', fecha, DATE '1999-05-02')), fecha)) AS shift FROM rate) SELECT fecha, rate + shift AS rate FROM rate, a")
def w25(spark, sf_dir):
    rows = rate(spark, sf_dir)
    key = F.struct(F.abs(F.datediff("fecha", F.lit("1999-05-02").cast("date"))), F.col("fecha"))
    shift = rows.agg((F.lit(20_000_000) - F.min_by("rate", key)).alias("shift"))
    return rows.join(F.broadcast(shift)).select("fecha", (F.col("rate") + F.col("shift")).alias("rate"))  # one row


@query("w26_change_pct", f"WITH {CLOSES}, p AS (SELECT *, lag(cents) OVER (ORDER BY fecha) AS b FROM closes) SELECT fecha, cents, CASE WHEN b > 0 THEN CAST((cents - b) * 100 AS DOUBLE) / b END AS pct FROM p")
def w26(spark, sf_dir):
    return op.change_pct(op.closes(tick(spark, sf_dir)))


@query("w29_daily_strike", f"WITH {TICK}, n AS (SELECT *, timezone('America/New_York', timezone('UTC', ts)) AS ny FROM tick) SELECT CAST(ny AS DATE) AS fecha, arg_min(cents, (abs(hour(ny) * 60 + minute(ny) - 900), ts, event_id)) AS cents FROM n GROUP BY 1")
def w29(spark, sf_dir):
    ny = F.from_utc_timestamp("ts", "America/New_York")
    rows = tick(spark, sf_dir).withColumn("ny", ny)
    off = F.abs(F.hour("ny") * 60 + F.minute("ny") - 900)
    return rows.groupBy(F.to_date("ny").alias("fecha")).agg(F.min_by("cents", F.struct(off, "ts", "event_id")).alias("cents"))


@query("w30_observation_deltas", f"WITH {RATE} SELECT fecha, rate, d1, d21 FROM (SELECT fecha, rate, rate - lag(rate, 1) OVER (ORDER BY fecha) AS d1, rate - lag(rate, 21) OVER (ORDER BY fecha) AS d21, row_number() OVER (ORDER BY fecha DESC) AS k FROM rate) WHERE k <= 1260")
def w30(spark, sf_dir):
    return op.observation_deltas(rate(spark, sf_dir))


@query("w20_retention", """WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders), r AS (SELECT fecha, row_number() OVER (ORDER BY fecha DESC) AS k FROM d), x AS (SELECT fecha, isoyear(fecha) * 100 + weekofyear(fecha) AS week FROM r WHERE k > 7),
 y AS (SELECT *, dense_rank() OVER (ORDER BY week DESC) AS w FROM x), z AS (SELECT *, dense_rank() OVER (ORDER BY date_trunc('month', fecha) DESC) AS m FROM y WHERE w > 4)
SELECT fecha, 'daily' AS rule FROM r WHERE k <= 7 UNION ALL SELECT min(fecha), 'weekly' FROM y WHERE w <= 4 GROUP BY week UNION ALL SELECT min(fecha), 'monthly' FROM z WHERE m <= 3 GROUP BY m""")
def w20(spark, sf_dir):
    return op.retention(table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha")))


@query("s12_field_merge", f"""WITH {RATE}, o AS (SELECT fecha, CASE WHEN day(fecha) % 5 = 0 THEN NULL ELSE rate END AS compra, rate + 5 AS venta FROM rate WHERE fecha < DATE '2000-01-01'),
 n AS (SELECT fecha, CASE WHEN day(fecha) % 7 = 0 THEN NULL ELSE rate END AS compra, CASE WHEN day(fecha) % 2 = 0 THEN rate + 5 ELSE rate + 6 END AS venta FROM rate WHERE fecha >= DATE '1998-01-01'), j AS (SELECT coalesce(o.fecha, n.fecha) AS fecha, coalesce(n.compra, o.compra) AS compra, coalesce(n.venta, o.venta) AS venta, o.fecha AS of, n.fecha AS nf, o.compra AS oc, o.venta AS ov FROM o FULL JOIN n ON o.fecha = n.fecha)
SELECT fecha, compra, venta, CASE WHEN of IS NULL THEN 'new' WHEN nf IS NULL THEN 'kept' WHEN compra IS NOT DISTINCT FROM oc AND venta IS NOT DISTINCT FROM ov THEN 'equal' ELSE 'updated' END AS verdict FROM j""")
def s12(spark, sf_dir):
    rows = rate(spark, sf_dir)
    old = rows.where("fecha < DATE '2000-01-01'").selectExpr("fecha", "if(day(fecha) % 5 = 0, NULL, rate) AS compra", "rate + 5 AS venta")
    new = rows.where("fecha >= DATE '1998-01-01'").selectExpr("fecha", "if(day(fecha) % 7 = 0, NULL, rate) AS compra", "if(day(fecha) % 2 = 0, rate + 5, rate + 6) AS venta")
    return merge_fields(old, new, ["fecha"], ["compra", "venta"])


@query("s11_insert_absent", f"WITH {RATE} SELECT fecha, rate FROM rate WHERE fecha < DATE '2000-01-01' UNION ALL SELECT fecha, rate + 1 FROM rate WHERE fecha >= DATE '2000-01-01'")
def s11(spark, sf_dir):
    rows = rate(spark, sf_dir)
    return insert_absent(rows.where("fecha < DATE '2000-01-01'"), rows.where("fecha >= DATE '1998-01-01'").withColumn("rate", F.col("rate") + 1), ["fecha"])


@query("p18_series_clip", f"WITH {RATE} SELECT fecha, rate, 0 AS latest FROM rate WHERE fecha BETWEEN DATE '1999-01-01' AND DATE '1999-12-31' UNION ALL SELECT max(fecha), arg_max(rate, fecha), 1 FROM rate")
def p18(spark, sf_dir):
    rows = rate(spark, sf_dir)
    clip = rows.where("fecha BETWEEN DATE '1999-01-01' AND DATE '1999-12-31'").withColumn("latest", F.lit(0))
    return clip.union(rows.agg(F.max("fecha"), F.max_by("rate", "fecha"), F.lit(1)))


@query("u01_union_of_feeds", f"WITH {RATE}, u AS (SELECT fecha, rate, NULL AS tco FROM rate WHERE year(fecha) < 1999 UNION ALL SELECT fecha, NULL, rate + 1 FROM rate WHERE year(fecha) >= 1998) SELECT fecha, CAST(max(rate) AS BIGINT) AS rate, CAST(max(tco) AS BIGINT) AS tco FROM u GROUP BY fecha")
def u01(spark, sf_dir):
    rows = rate(spark, sf_dir)
    feeds = rows.where("year(fecha) < 1999").unionByName(rows.where("year(fecha) >= 1998").selectExpr("fecha", "rate + 1 AS tco"), allowMissingColumns=True)
    return feeds.groupBy("fecha").agg(F.max("rate").alias("rate"), F.max("tco").alias("tco"))


@query("x10_visitor_sessions", f"""WITH {TICK}, g AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 1800000000 THEN 0 ELSE 1 END AS opens FROM tick WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
 s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g) SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def x10(spark, sf_dir):
    sessions = tick(spark, sf_dir).groupBy("user_id", F.session_window("ts", "30 minutes")).agg(F.count("*").alias("n"))
    return sessions.select("user_id", F.col("session_window.start").alias("start"), "n")


@query("a30_visitors_by_day", f"WITH {TICK} SELECT CAST({LOCAL} AS DATE) AS fecha, count(DISTINCT user_id) AS visitors, count(*) AS views FROM tick GROUP BY 1")
def a30(spark, sf_dir):
    return tick(spark, sf_dir).groupBy(F.to_date(op.local("ts")).alias("fecha")).agg(F.countDistinct("user_id").alias("visitors"), F.count("*").alias("views"))


@query("a30_visitors_to_date", f"WITH {TICK}, d AS (SELECT DISTINCT CAST({LOCAL} AS DATE) AS fecha, user_id FROM tick), days AS (SELECT fecha, count(*) AS visitors FROM d GROUP BY 1) SELECT fecha, visitors, (SELECT count(DISTINCT user_id) FROM d WHERE d.fecha <= days.fecha AND strftime(d.fecha, '%Y-%m') = strftime(days.fecha, '%Y-%m')) AS month_to_date FROM days")
def a30_month(spark, sf_dir):
    """Visitors of each day and different ones of its month so far."""
    return op.visitors_to_date(tick(spark, sf_dir).select("user_id", F.to_date(op.local("ts")).alias("fecha")))


@query("a32_market_breadth", f"""WITH {TICK}, d AS (SELECT user_id, CAST(ts AS DATE) AS fecha, arg_max(cents, (ts, event_id)) AS c FROM tick GROUP BY ALL), p AS (SELECT *, lag(c) OVER (PARTITION BY user_id ORDER BY fecha) AS b FROM d)
SELECT fecha, count(*) FILTER (c > b) AS up, count(*) FILTER (c < b) AS down, arg_max(user_id, (c - b, user_id)) AS best, arg_min(user_id, (c - b, user_id)) AS worst FROM p WHERE b IS NOT NULL GROUP BY fecha""")
def a32(spark, sf_dir):
    daily = tick(spark, sf_dir).groupBy("user_id", F.to_date("ts").alias("fecha")).agg(F.max_by("cents", F.struct("ts", "event_id")).alias("c"))
    moves = daily.withColumn("move", F.col("c") - F.lag("c").over(Window.partitionBy("user_id").orderBy("fecha"))).where("move IS NOT NULL")
    key = F.struct("move", "user_id")
    return moves.groupBy("fecha").agg(F.count_if(F.col("move") > 0).alias("up"), F.count_if(F.col("move") < 0).alias("down"), F.max_by("user_id", key).alias("best"), F.min_by("user_id", key).alias("worst"))


@query("t05_movers", f"""WITH {TICK}, s AS (SELECT user_id, count(*) AS volume, max(cents) - min(cents) AS move FROM tick GROUP BY 1), r AS (SELECT *, row_number() OVER (ORDER BY move DESC, user_id) AS k FROM s) SELECT user_id, volume, move FROM r WHERE k <= 5 OR user_id IN (1, 2)""")
def t05(spark, sf_dir):
    sums = tick(spark, sf_dir).groupBy("user_id").agg(F.count("*").alias("volume"), (F.max("cents") - F.min("cents")).alias("move"))
    top = sums.orderBy(F.desc("move"), "user_id").limit(5)
    pinned = sums.where("user_id IN (1, 2)").join(top, "user_id", "left_anti")
    return top.union(pinned.select(top.columns))


@query("a15_spend_ledger", f"""WITH {TICK}, m AS (SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS calls, CAST(sum(cents) AS BIGINT) AS spent FROM tick GROUP BY 1), r AS (SELECT *, coalesce(sum(spent) OVER (PARTITION BY substr(day, 1, 7) ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m)
SELECT day, calls, spent, CAST(before AS BIGINT) AS before, before < 200000 AS allowed FROM r""")
def a15(spark, sf_dir):
    days_ = tick(spark, sf_dir).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("day")).agg(F.count("*").alias("calls"), F.sum("cents").alias("spent"))
    past = Window.partitionBy(F.substring("day", 1, 7)).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    return days_.withColumn("before", F.coalesce(F.sum("spent").over(past), F.lit(0))).withColumn("allowed", F.col("before") < 200_000)


@query("a18_last_reading", f"WITH {TICK}, l AS (SELECT CAST(ts AS DATE) AS fecha, event_type, max(ts) AS ts FROM tick GROUP BY ALL) SELECT l.fecha, l.event_type, count(*) AS n FROM l JOIN tick t ON t.event_type = l.event_type AND t.ts = l.ts GROUP BY ALL")
def a18(spark, sf_dir):
    rows = tick(spark, sf_dir).select("event_type", "ts", F.to_date("ts").alias("fecha"))
    last = rows.groupBy("fecha", "event_type").agg(F.max("ts").alias("ts"))
    return rows.join(last, ["fecha", "event_type", "ts"]).groupBy("fecha", "event_type").agg(F.count("*").alias("n"))


@query("a36_severity_counts", f"WITH {TICK}, l AS (SELECT ts, '[' || upper(CASE WHEN event_type = 'error' THEN 'error' WHEN cents > 5000 THEN 'warn' ELSE 'info' END) || '] ' || event_type AS line FROM tick) SELECT regexp_extract(line, '^\\[([A-Z]+)\\]', 1) AS level, count(*) AS n FROM l WHERE ts > (SELECT max(ts) - INTERVAL 24 HOUR FROM tick) GROUP BY 1")
def a36(spark, sf_dir):
    rows = tick(spark, sf_dir)
    level = F.when(F.col("event_type") == "error", "error").when(F.col("cents") > 5000, "warn").otherwise("info")
    lines = rows.select("ts", F.concat(F.lit("["), F.upper(level), F.lit("] "), "event_type").alias("line"))
    last = F.broadcast(rows.agg((F.max("ts") - F.expr("INTERVAL 24 HOURS")).alias("since")))  # one row
    return lines.join(last, F.col("ts") > F.col("since")).groupBy(F.regexp_extract("line", r"^\[([A-Z]+)\]", 1).alias("level")).agg(F.count("*").alias("n"))


@query("a37_freshness", f"WITH {TICK}, c AS (SELECT CAST(unnest(generate_series(DATE '2023-12-30', DATE '2024-02-02', INTERVAL 1 DAY)) AS DATE) AS fecha), n AS (SELECT CAST(ts AS DATE) AS fecha, count(*) AS n FROM tick GROUP BY 1) SELECT fecha, coalesce(n, 0) AS n, CASE WHEN n IS NULL THEN 'missing' WHEN n < 100 THEN 'thin' ELSE 'ok' END AS status FROM c LEFT JOIN n USING (fecha)")
def a37(spark, sf_dir):
    days_ = spark.sql("SELECT explode(sequence(DATE '2023-12-30', DATE '2024-02-02')) AS fecha")
    counts = tick(spark, sf_dir).groupBy(F.to_date("ts").alias("fecha")).agg(F.count("*").alias("n"))
    status = F.when(F.col("n").isNull(), "missing").when(F.col("n") < 100, "thin").otherwise("ok")
    return days_.join(counts, "fecha", "left").select("fecha", F.coalesce("n", F.lit(0)).alias("n"), status.alias("status"))


@query("f33_session_open", f"WITH {TICK}, n AS (SELECT event_id, timezone('America/New_York', timezone('UTC', ts)) AS ny FROM tick) SELECT event_id, isodow(ny) <= 5 AND hour(ny) * 60 + minute(ny) >= 570 AND hour(ny) * 60 + minute(ny) < 960 AS open FROM n")
def f33(spark, sf_dir):
    ny = F.from_utc_timestamp("ts", "America/New_York")
    minute = F.hour(ny) * 60 + F.minute(ny)
    return tick(spark, sf_dir).select("event_id", ((F.weekday(ny) < 5) & (minute >= 570) & (minute < 960)).alias("open"))


@query("f17_local_time", f"WITH {TICK} SELECT event_id, strftime({LOCAL}, '%Y-%m-%d') AS fecha, strftime({LOCAL}, '%H:%M') AS hora FROM tick")
def f17(spark, sf_dir):
    return tick(spark, sf_dir).select("event_id", F.date_format(op.local("ts"), "yyyy-MM-dd").alias("fecha"), F.date_format(op.local("ts"), "HH:mm").alias("hora"))


@query("p02_lenient_casts", f"WITH {TICK} SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, TRY_CAST(event_type AS DOUBLE) AS bad FROM tick")
def p02(spark, sf_dir):
    return tick(spark, sf_dir).selectExpr("event_id", "try_cast(get_json_object(props, '$.k') AS INT) AS k", "try_cast(event_type AS DOUBLE) AS bad")


@query("p12_feed_window", f"WITH {TICK} SELECT event_id, coalesce(json_extract_string(props, '$.title'), event_type) AS title FROM tick WHERE CAST({LOCAL} AS DATE) > (SELECT max(CAST({LOCAL} AS DATE)) - 10 FROM tick)")
def p12(spark, sf_dir):
    rows = tick(spark, sf_dir).withColumn("fecha", F.to_date(op.local("ts")))
    last = F.broadcast(rows.agg(F.date_sub(F.max("fecha"), 10).alias("since")))  # one row
    return rows.join(last, F.col("fecha") > F.col("since")).select("event_id", F.coalesce(F.get_json_object("props", "$.title"), "event_type").alias("title"))


@query("m17_incident_categories", f"WITH {TICK} SELECT category, count(*) AS n FROM (SELECT CASE event_type WHEN 'view' THEN 'roadblock' WHEN 'click' THEN 'strike' WHEN 'error' THEN 'filtered' ELSE 'other' END AS category FROM tick) WHERE category <> 'filtered' GROUP BY 1")
def m17(spark, sf_dir):
    names = F.expr("try_element_at(map('view', 'roadblock', 'click', 'strike', 'error', 'filtered'), event_type)")
    category = F.coalesce(names, F.lit("other"))
    return tick(spark, sf_dir).groupBy(category.alias("category")).agg(F.count("*").alias("n")).where("category <> 'filtered'")


@query("m28_quote_freshness", f"WITH {TICK}, l AS (SELECT max(ts) AS now FROM tick) SELECT user_id, CASE WHEN max(ts) FILTER (event_type = 'view') >= any_value(now) - INTERVAL 24 HOUR AND max(ts) FILTER (event_type = 'click') >= any_value(now) - INTERVAL 24 HOUR THEN 'live' ELSE 'snapshot' END AS quote FROM tick, l GROUP BY user_id")
def m28(spark, sf_dir):
    rows = tick(spark, sf_dir)
    last = F.broadcast(rows.agg((F.max("ts") - F.expr("INTERVAL 24 HOURS")).alias("since")))  # one row
    side = lambda kind: F.max(F.when((F.col("event_type") == kind) & (F.col("ts") >= F.col("since")), 1))
    each = rows.join(last).groupBy("user_id").agg(side("view").alias("bid"), side("click").alias("ask"))
    return each.select("user_id", F.when(F.col("bid").isNotNull() & F.col("ask").isNotNull(), "live").otherwise("snapshot").alias("quote"))


@query("j12_source_cascade", f"""WITH {TICK}, q AS (SELECT user_id, event_type, max(ts) AS ts, arg_max(cents, (ts, event_id)) AS cents FROM tick GROUP BY ALL), f AS (SELECT * FROM q WHERE ts > (SELECT max(ts) - INTERVAL 72 HOUR FROM tick)),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END, event_type) AS k FROM f) SELECT user_id, event_type AS source, cents FROM r WHERE k = 1 UNION ALL SELECT DISTINCT user_id, 'dropped', NULL FROM tick WHERE user_id NOT IN (SELECT user_id FROM f)""")
def j12(spark, sf_dir):
    rows = tick(spark, sf_dir)
    quotes = rows.groupBy("user_id", "event_type").agg(F.max("ts").alias("ts"), F.max_by("cents", F.struct("ts", "event_id")).alias("cents"))
    last = F.broadcast(rows.agg((F.max("ts") - F.expr("INTERVAL 72 HOURS")).alias("since")))  # one row
    fresh = quotes.join(last, F.col("ts") > F.col("since"))
    priority = F.expr("CASE event_type WHEN 'purchase' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END")
    k = F.row_number().over(Window.partitionBy("user_id").orderBy(priority, "event_type"))
    chosen = fresh.withColumn("k", k).where("k = 1").select("user_id", F.col("event_type").alias("source"), "cents")
    dropped = rows.select("user_id").distinct().join(fresh, "user_id", "left_anti")
    return chosen.union(dropped.select("user_id", F.lit("dropped"), F.lit(None).cast("long")))


@query("s09_load_status", f"WITH {TICK} SELECT max(strftime(ts, '%Y-%m-%d')) FILTER (event_id % 10 <> 0) AS watermark, count(*) AS rows, count(DISTINCT strftime(ts, '%Y-%m-%d')) AS snapshots, count(*) FILTER (event_id % 10 = 0) AS pending FROM tick")
def s09(spark, sf_dir):
    day = F.date_format("ts", "yyyy-MM-dd")
    return tick(spark, sf_dir).agg(F.max(F.when(F.col("event_id") % 10 != 0, day)).alias("watermark"), F.count("*").alias("rows"), F.countDistinct(day).alias("snapshots"), F.count_if(F.col("event_id") % 10 == 0).alias("pending"))


@query("x05_gap_alarms", f"WITH {TICK}, g AS (SELECT ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (ORDER BY ts)) < 1200000000 THEN 0 ELSE 1 END AS opens FROM (SELECT DISTINCT ts FROM tick)), s AS (SELECT ts, sum(opens) OVER (ORDER BY ts) AS k FROM g) SELECT min(ts) AS start, max(ts) AS last, count(*) AS n FROM s GROUP BY k")
def x05(spark, sf_dir):
    return op.busy_spells(tick(spark, sf_dir), 20)
