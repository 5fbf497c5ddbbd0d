"""Queries of operators with all their parts: caps with what they evict, budgets, funnels that balance, quotes, ledgers, tables' fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import MACRO, NOTE, RATE, TICK, macro, note, rate, tick
from ..functions import text as fn
from ..functions import values
from ..operators import facts, relevance, rules
from ..operators import notes as op
from ..registry import query
from ..session import table
from ..sources import sinks
from .notes import FOLD, KEYWORDS, WORD


@query("m01_relevance_model")
def m01(spark, sf_dir):
    """The labels of documents train it; notes without a model get the keyword score."""
    rows = note(spark, sf_dir).select("id", "title", "body", "quality")
    fallback = rules.keyword_score(F.lower("title"), F.lit(""), ["trash"], ["license"], {"a": ["th", "er"]})
    scores, _ = relevance.scored(rows, F.concat_ws(" ", "title", "body"), "quality", fallback)
    return scores.select("id", F.col("probability").isNotNull().alias("by_model"), "score")


@query("m02_keyword_scores", f"WITH {NOTE}, t AS (SELECT id, portal, lower(coalesce(title, '')) AS t FROM note) SELECT id, CASE WHEN contains(t, 'trash') OR (coalesce(portal IN ('src0', 'src5'), false) AND NOT (contains(t, 'the') OR contains(t, 'der'))) THEN 0 WHEN contains(t, 'license') THEN 10 ELSE greatest(CAST(contains(t, 'th') AS INTEGER) + CAST(contains(t, 'er') AS INTEGER), CAST(contains(t, 'que') AS INTEGER) + CAST(contains(t, 'los') AS INTEGER) + CAST(contains(t, 'de') AS INTEGER)) END AS score FROM t")
def m02(spark, sf_dir):
    score = rules.keyword_score(F.lower(F.coalesce("title", F.lit(""))), F.col("portal"), ["trash"], ["license"], {"a": ["th", "er"], "b": ["que", "los", "de"]}, (["src0", "src5"], ["the", "der"]))
    return note(spark, sf_dir).select("id", score.alias("score"))


@query("p04_keywords_of_two_texts", f"WITH {NOTE}, f AS (SELECT id, {FOLD.format('title')} AS a, {FOLD.format('body')} AS b FROM note) SELECT id, nullif(concat_ws(',', " + ", ".join(f"CASE WHEN {WORD.format('a', k)} OR {WORD.format('b', k)} THEN '{k}' END" for k in sorted(KEYWORDS)) + "), '') AS hits FROM f")
def p04(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", fn.fold(F.concat_ws(" . ", "title", "body")).alias("folded"))  # once a note, not for each word
    return rows.select("id", F.array_join(op.keyword_hits(F.col("folded"), KEYWORDS), ",").alias("hits"))


@query("p05_fourteen_fields", "SELECT o_orderkey, concat_ws(',', " + ", ".join(f"CASE WHEN o_orderkey % {k + 2} = 0 THEN 'f{k:02}' END" for k in range(14)) + ") AS present, CAST(" + " OR ".join(f"o_orderkey % {k + 2} = 0" for k in range(14)) + " AS INTEGER) AS has_any FROM orders")
def p05(spark, sf_dir):
    names = [f"f{k:02}" for k in range(14)]
    rows = table(spark, sf_dir, "orders").select("o_orderkey", *[F.when(F.col("o_orderkey") % (k + 2) == 0, F.col("o_totalprice")).alias(n) for k, n in enumerate(names)])
    rows = rows.withColumn("fields", facts.sparse_fields(names))
    return rows.select("o_orderkey", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("present"), (F.size("fields") > 0).cast("int").alias("has_any"))


ROTATED = NOTE + ", c AS (SELECT id, fecha, score10, id % 3 = 0 AS inc, row_number() OVER (PARTITION BY fecha ORDER BY score10 DESC, CAST(id % 3 = 0 AS INTEGER) DESC, CASE WHEN id % 3 = 0 THEN id ELSE 0 END DESC, id) <= 10 AS kept FROM note)"


@query("w18_daily_rotation", f"WITH {ROTATED} SELECT id, fecha, CASE WHEN kept THEN 'kept' WHEN inc THEN 'evicted' ELSE 'left out' END AS fate FROM c")
def w18(spark, sf_dir):
    inc = (F.col("id") % 3 == 0).cast("int")
    rows = note(spark, sf_dir).select("id", "fecha", "score10", inc.alias("incumbent"), (inc * F.col("id")).alias("newest"))
    return op.rotated_cap(rows, 10).select("id", "fecha", "fate")


@query("w19_lane_budget", f"WITH {TICK}, d AS (SELECT *, CAST(ts - INTERVAL 4 HOUR AS DATE) AS day FROM tick), u AS (SELECT event_type, day, count(*) AS used FROM d WHERE cents < 500 GROUP BY ALL), r AS (SELECT d.*, row_number() OVER (PARTITION BY event_type, day ORDER BY ts, event_id) AS k FROM d WHERE cents IS NULL OR cents >= 500) SELECT event_id FROM r LEFT JOIN u USING (event_type, day) WHERE k <= 5 - coalesce(used, 0)")
def w19(spark, sf_dir):
    """Small ticks have used a part of the day's budget already."""
    rows = tick(spark, sf_dir).withColumn("day", F.to_date(F.col("ts") - F.expr("INTERVAL 4 HOURS")))
    used = rows.where("cents < 500").groupBy("event_type", "day").agg(F.count("*").alias("used"))
    return op.lane_budget(rows.where("cents IS NULL OR cents >= 500"), used, 5, "event_type", "day", ["ts", "event_id"]).select("event_id")


@query("a13_balanced_funnel", f"WITH {NOTE}, e AS (SELECT CASE WHEN coalesce(quality = 0, false) THEN 'low quality' WHEN coalesce(length(title) < 15, false) THEN 'short title' WHEN coalesce(score10 < 33, false) THEN 'below cut' ELSE 'kept' END AS stage FROM note) SELECT stage, count(*) AS n, (SELECT count(*) FROM note) AS total FROM e GROUP BY stage UNION ALL SELECT 'unaccounted', 0, (SELECT count(*) FROM note)")
def a13(spark, sf_dir):
    return op.funnel(note(spark, sf_dir), [("low quality", F.col("quality") == 0), ("short title", F.length("title") < 15), ("below cut", F.col("score10") < 33)])


EXITS = [("duplicate", "id % 11 = 0"), ("quality", "quality = 0"), ("short", "length(title) < 15"), ("cut", "score10 < 33"), ("evicted", "portal = 'src3'")]


@query("u05_exit_log", f"WITH {NOTE}, u AS (" + " UNION ALL ".join(f"SELECT id AS url, fecha, '{name}' AS reason, {k} AS k FROM note WHERE {cond}" for k, (name, cond) in enumerate(EXITS)) + ") SELECT url, fecha, arg_max(reason, k) AS reason FROM u WHERE fecha > DATE '2024-02-07' - 30 GROUP BY url, fecha")
def u05(spark, sf_dir):
    rows = note(spark, sf_dir).withColumnRenamed("id", "url")
    return op.exit_log({name: rows.where(cond.replace("id %", "url %")) for name, cond in EXITS}, "2024-02-07")


QUOTES = TICK + ", q AS (SELECT event_id, user_id, ts, CASE event_type WHEN 'view' THEN 'snapshot-eod' WHEN 'click' THEN 'primary' ELSE 'venue' END AS source, CASE WHEN event_id % 4 <> 0 THEN cents END AS bid, cents + 5 AS ask FROM tick), f AS (SELECT *, contains(source, 'snapshot') OR (bid IS NOT NULL AND ask IS NOT NULL AND epoch_us(TIMESTAMP '2024-01-30 12:00:00') - epoch_us(ts) <= 1800000000) AS fresh FROM q)"


def quotes(spark, sf_dir):
    source = F.when(F.col("event_type") == "view", "snapshot-eod").when(F.col("event_type") == "click", "primary").otherwise("venue")
    rows = tick(spark, sf_dir).select("event_id", F.col("user_id").alias("key"), "ts", source.alias("source"), F.when(F.col("event_id") % 4 != 0, F.col("cents")).alias("bid"), (F.col("cents") + 5).alias("ask"))
    return op.fresh_quotes(rows, F.lit("2024-01-30 12:00:00").cast("timestamp"))


@query("m28_fresh_quotes", f"WITH {QUOTES} SELECT event_id, fresh FROM f")
def m28(spark, sf_dir):
    return quotes(spark, sf_dir).select("event_id", "fresh")


@query("j12_cascade_of_sources", f"WITH {QUOTES} SELECT user_id AS key, arg_min(source, (CASE source WHEN 'primary' THEN 1 WHEN 'venue' THEN 2 ELSE 3 END, -epoch_us(ts))) AS source, arg_min(ts, (CASE source WHEN 'primary' THEN 1 WHEN 'venue' THEN 2 ELSE 3 END, -epoch_us(ts))) AS ts FROM f WHERE fresh GROUP BY user_id")
def j12(spark, sf_dir):
    return op.source_cascade(quotes(spark, sf_dir), ["primary", "venue"]).select("key", "source", "ts")


@query("a15_spend_cap", f"WITH {TICK}, m AS (SELECT event_id, cents, coalesce(sum(coalesce(cents, 0)) OVER (PARTITION BY strftime(ts, '%Y-%m') ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS spent FROM tick) SELECT event_id, spent < 2000000 AS allowed FROM m")
def a15(spark, sf_dir):
    rows = tick(spark, sf_dir).select(F.col("event_id").alias("id"), "ts", F.date_format("ts", "yyyy-MM").alias("month"), F.coalesce("cents", F.lit(0)).alias("cost"))
    return op.spend(rows, 2_000_000).select(F.col("id").alias("event_id"), "allowed")


LEVEL = "CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'view' THEN 'INFO' ELSE 'NOTE' END"


@query("a36_log_levels", f"WITH {TICK}, l AS (SELECT {LEVEL} AS level, date_trunc('second', ts) AS ts FROM tick) SELECT level, count(*) AS n FROM l WHERE level IN ('ERROR', 'INFO') AND epoch_us(TIMESTAMP '2024-01-20 00:00:00') - epoch_us(ts) BETWEEN 0 AND 86400000000 GROUP BY level")
def a36(spark, sf_dir):
    level = F.when(F.col("event_type") == "error", "ERROR").when(F.col("event_type") == "view", "INFO").otherwise("NOTE")
    lines = tick(spark, sf_dir).select(F.concat_ws(" ", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), level, F.lit("worker"), "props").alias("line"))
    return op.log_levels(lines, F.lit("2024-01-20 00:00:00").cast("timestamp"))


@query("m17_categories_by_map", f"WITH {TICK} SELECT CASE event_type WHEN 'view' THEN 'works' WHEN 'click' THEN 'weather' ELSE 'other' END AS category, count(*) AS n FROM tick WHERE event_type <> 'error' GROUP BY 1")
def m17(spark, sf_dir):
    rows = tick(spark, sf_dir).select(facts.categories(F.col("event_type"), {"view": "works", "click": "weather"}, ["error", ""]).alias("category"))
    return rows.where("category IS NOT NULL").groupBy("category").agg(F.count("*").alias("n"))


@query("a16_clipped_active_days", "WITH r AS (SELECT o_orderpriority AS category, o_custkey % 50 AS cell, CAST(o_orderdate AS DATE) AS a, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 9 AS INTEGER) END AS b FROM orders), m AS (SELECT CAST(max(o_orderdate) AS DATE) AS last FROM orders), c AS (SELECT category, cell, greatest(a, DATE '1996-01-01') AS a, least(coalesce(b, last), last) AS b FROM r, m), d AS (SELECT DISTINCT category, cell, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM c WHERE a <= b) SELECT category, cell, count(*) AS days FROM d GROUP BY ALL")
def a16(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    rows = orders.select(F.col("o_orderpriority").alias("category"), (F.col("o_custkey") % 50).alias("cell"), day.alias("start"), F.when(F.col("o_orderstatus") != "O", F.date_add(day, (F.col("o_orderkey") % 9).cast("int"))).alias("end"))
    last = orders.agg(F.max(day).alias("last"))
    return facts.active_days(rows.crossJoin(F.broadcast(last)), ["category", "cell"], "1996-01-01", F.col("last"))  # one row


@query("j06_crosswalk_quarantine", "WITH n AS (SELECT n_nationkey, n_regionkey, 'R' || n_nationkey % 20 AS key FROM nation), u AS (SELECT n_regionkey, key, min(n_nationkey) AS k FROM n GROUP BY ALL HAVING count(*) = 1), s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS code, s_nationkey % 5 AS region, 'R' || s_nationkey % 20 AS key FROM supplier) SELECT s_suppkey, coalesce(n.n_nationkey, u.k) AS nation, coalesce(n.n_nationkey, u.k) IS NULL AS quarantined FROM s LEFT JOIN n ON n.n_nationkey = s.code LEFT JOIN u ON u.n_regionkey = s.region AND u.key = s.key")
def j06(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("target"), F.col("n_regionkey").alias("region"), F.concat(F.lit("R"), F.col("n_nationkey") % 20).alias("name"))
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "if(s_suppkey % 2 = 0, s_nationkey, NULL) AS code", "CAST(s_nationkey % 5 AS BIGINT) AS region", "concat('R', s_nationkey % 20) AS name")
    good, bad = facts.crosswalk(rows, nations.select(F.col("target").alias("code"), "target"), nations.withColumn("region", F.col("region").cast("long")))
    found = good.select("s_suppkey", F.col("target").alias("nation"), F.lit(False).alias("quarantined"))
    return found.union(bad.select("s_suppkey", F.lit(None).cast(good.schema["target"].dataType), F.lit(True)))


PRINT = ["l_orderkey", "l_partkey", "l_linenumber", "l_returnflag"]


@query("a33_table_fingerprint", "WITH t AS (SELECT " + ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), 'NULL') AS {c}" for c in PRINT) + " FROM lineitem) SELECT " + ", ".join(f"CAST(sum(CAST('0x' || substr(md5({c}), 1, 12) AS BIGINT)) % (CAST(1 AS HUGEINT) << 60) AS BIGINT) AS {c}" for c in PRINT) + f", CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(PRINT)})), 1, 12) AS BIGINT)) % (CAST(1 AS HUGEINT) << 60) AS BIGINT) AS whole, count(*) AS n FROM t")
def a33(spark, sf_dir):
    return facts.fingerprint(table(spark, sf_dir, "lineitem"), PRINT)


@query("w26_change_of_rate", f"WITH {RATE}, p AS (SELECT fecha, rate, lag(rate) OVER (ORDER BY fecha) AS before FROM rate) SELECT fecha, rate, CASE WHEN before > 0 THEN CAST((rate - before) * 100 AS DOUBLE) / before END AS pct FROM p")
def w26(spark, sf_dir):
    from ..operators.series import change_pct

    return change_pct(rate(spark, sf_dir), "rate")


#: Every column of lineitem in a form that both engines write alike: money in cents, shares in hundredths, times to the second.
EVERY = {c: (c, c) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")}
EVERY |= {c: (f"CAST(round({c} * 100) AS BIGINT)",) * 2 for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
EVERY |= {"l_shipdate": ("date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss')", "strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')")}
WHOLE = "SELECT " + ", ".join(f"{sql} AS {c}" for c, (_, sql) in EVERY.items()) + " FROM lineitem"


@query("a33_whole_table_fingerprint", "WITH t AS (SELECT " + ", ".join(f"coalesce('=' || CAST({c} AS VARCHAR), 'NULL') AS {c}" for c in EVERY) + f" FROM ({WHOLE})) SELECT " + ", ".join(f"CAST(sum(CAST('0x' || substr(md5({c}), 1, 12) AS BIGINT)) % (CAST(1 AS HUGEINT) << 60) AS BIGINT) AS {c}" for c in EVERY) + f", CAST(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(EVERY)})), 1, 12) AS BIGINT)) % (CAST(1 AS HUGEINT) << 60) AS BIGINT) AS whole, count(*) AS n FROM t")
def a33_whole(spark, sf_dir):
    """All columns of the table."""
    return facts.fingerprint(table(spark, sf_dir, "lineitem").selectExpr(*[f"{expr} AS {c}" for c, (expr, _) in EVERY.items()]), list(EVERY))


@query("w23_all_series", f"WITH {MACRO}, s AS (SELECT slug, max(periodo) >= '1999-01' AS live, slug = 'building' AS national, count(*) AS span FROM macro GROUP BY slug) SELECT slug, CAST(row_number() OVER (ORDER BY live DESC, national DESC, span DESC, slug) AS INTEGER) AS place FROM s")
def w23(spark, sf_dir):
    """Every segment's series, the national one first."""
    series = macro(spark, sf_dir).groupBy("slug").agg((F.max("periodo") >= "1999-01").alias("live"), F.count("*").alias("span"))
    order = Window.orderBy(F.desc("live"), F.desc(F.col("slug") == "building"), F.desc("span"), "slug")  # a row per series
    return series.select("slug", F.row_number().over(order).alias("place"))


@query("s25_shrink_guard_by_type", f"WITH {TICK}, g AS (SELECT event_type, count(*) FILTER (ts < TIMESTAMP '2024-01-12') AS n_new, count(*) AS n_old FROM tick GROUP BY 1) SELECT event_type, n_new, n_old, CASE WHEN n_new < 0.3 * n_old OR n_new < 10 THEN 'refused' ELSE 'ok' END AS verdict FROM g")
def s25(spark, sf_dir):
    """Each type's rows up to a day against all of them."""
    rows = tick(spark, sf_dir)
    return sinks.shrink_guard_by(rows.where("ts < TIMESTAMP_NTZ '2024-01-12 00:00:00'"), rows, "event_type", 10, 0.3)


SUNDAY = "make_timestamp(year(t), {m}, 31, 0, 0, 0) - to_days(CAST(dayofweek(make_date(year(t), {m}, 31)) AS INTEGER))"


@query("f34_all_hours", f"WITH r AS (SELECT o_orderkey, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) + to_days(3653) AS t FROM orders) SELECT o_orderkey, t - CASE WHEN t >= {SUNDAY.format(m=3)} + to_hours(3) AND t < {SUNDAY.format(m=10)} + to_hours(3) THEN to_hours(2) ELSE to_hours(1) END AS utc FROM r")
def f34(spark, sf_dir):
    """All orders: an hour that the change of clocks skips counts as the one after it, one that it repeats as the first of both."""
    local = F.expr("o_orderdate + make_dt_interval(3653, CAST(o_orderkey % 24 AS INT))")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", local.alias("t"))
    return rows.select("o_orderkey", values.zoned_time(F.date_format("t", "dd/MM/yy HH:mm:ss")).cast("timestamp_ntz").alias("utc"))
