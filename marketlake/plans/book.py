"""Queries over the order book."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import BOOK, book
from ..operators import book as op
from ..registry import query

GOOD = BOOK + ", good AS (SELECT * FROM book WHERE merchant = 1)"
WALK = GOOD + """,
levels AS (SELECT snapshot, side, price4, CAST(sum(greatest(size, 0)) AS BIGINT) AS size, max(CAST(size <= 0 AS INTEGER)) AS ends FROM good GROUP BY ALL),
walked AS (SELECT snapshot, side, price4, size, coalesce(sum(size) OVER past, 0) AS before, coalesce(max(ends) OVER past, 0) AS ended, sum(size) OVER (PARTITION BY snapshot, side) AS total
 FROM levels WINDOW past AS (PARTITION BY snapshot, side ORDER BY CASE WHEN side = 'BUY' THEN price4 ELSE -price4 END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
vwaps AS (SELECT snapshot, side, """ + ", ".join(
    f"CAST(sum(price4 * take_{p}) AS DOUBLE) / nullif(sum(take_{p}), 0) / 10000.0 AS vwap_{p}" for p in (5, 10, 25, 50)
) + " FROM (SELECT *, " + ", ".join(f"CASE WHEN ended = 1 THEN 0 ELSE greatest(0, least(size * 100, total * {p} - before * 100)) END AS take_{p}" for p in (5, 10, 25, 50)) + " FROM walked) GROUP BY ALL)"


@query("w01_vwap_by_depth", f"WITH {WALK} SELECT * FROM vwaps")
def w01(spark, sf_dir):
    return op.vwap_by_depth(op.verified(book(spark, sf_dir)))


@query("w02_spread_by_depth", f"WITH {WALK} SELECT snapshot, " + ", ".join(f"max(CASE WHEN side = 'BUY' THEN nullif(vwap_{p}, 0) END) - max(CASE WHEN side = 'SELL' THEN nullif(vwap_{p}, 0) END) AS spread_{p}" for p in (5, 10, 25, 50)) + " FROM vwaps GROUP BY snapshot")
def w02(spark, sf_dir):
    return op.spreads(op.vwap_by_depth(op.verified(book(spark, sf_dir))))


@query("a01_snapshot_summary", f"WITH {BOOK} SELECT snapshot, side, count(*) AS n, min(price4) AS lowest, max(price4) AS highest, CAST(sum(size) AS BIGINT) AS depth FROM book GROUP BY ALL")
def a01(spark, sf_dir):
    return op.summary(book(spark, sf_dir))


@query("a02_depth_ratio", f"""WITH {GOOD}, s AS (SELECT snapshot, CAST(coalesce(sum(size) FILTER (side = 'BUY'), 0) AS BIGINT) AS buy_depth, CAST(coalesce(sum(size) FILTER (side = 'SELL'), 0) AS BIGINT) AS sell_depth,
 count(*) FILTER (side = 'BUY') AS n_buy, count(*) FILTER (side = 'SELL') AS n_sell FROM good GROUP BY snapshot) SELECT *, CAST(sell_depth AS DOUBLE) / nullif(buy_depth, 0) AS ratio FROM s""")
def a02(spark, sf_dir):
    return op.depth_ratio(op.verified(book(spark, sf_dir)))


@query("a03_concentration", f"""WITH {GOOD}, t AS (SELECT snapshot, side, trader, sum(size) AS depth FROM good GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY snapshot, side ORDER BY depth DESC, trader NULLS FIRST) AS k FROM t)
SELECT snapshot, side, CAST(sum(CASE WHEN k <= 5 THEN depth ELSE 0 END) * 100 AS DOUBLE) / nullif(sum(depth), 0) AS share_pct FROM r GROUP BY ALL""")
def a03(spark, sf_dir):
    return op.concentration(op.verified(book(spark, sf_dir)))


BANKS = "['B' || CAST(trader % 7 AS VARCHAR), CASE WHEN ad_id % 3 = 0 THEN 'BANK' ELSE 'B' || CAST(ad_id % 5 AS VARCHAR) END]"


@query("a04_coverage_by_bank", f"""WITH {GOOD}, x AS (SELECT snapshot, side, size, unnest({BANKS}) AS bank FROM good), e AS (SELECT snapshot, side, bank, count(*) AS n, CAST(sum(size) AS BIGINT) AS depth FROM x WHERE bank <> 'BANK' GROUP BY ALL),
 t AS (SELECT snapshot, side, sum(size) AS total FROM good GROUP BY ALL) SELECT e.*, CAST(depth * 100 AS DOUBLE) / nullif(total, 0) AS pct FROM e JOIN t USING (snapshot, side)""")
def a04(spark, sf_dir):
    banks = F.expr("array(concat('B', trader % 7), if(ad_id % 3 = 0, 'BANK', concat('B', ad_id % 5)))")
    return op.coverage(op.verified(book(spark, sf_dir)), banks)


TRADERS = f"""WITH {GOOD}, e AS (SELECT side, trader, count(*) AS n, CAST(sum(size) AS BIGINT) AS depth, CAST(sum(price4 * size) AS DOUBLE) / nullif(sum(size), 0) / 10000.0 AS vwap, min(ad_id) AS first_ad FROM good GROUP BY ALL),
 t AS (SELECT *, CAST(depth * 100 AS DOUBLE) / nullif(sum(depth) OVER (PARTITION BY side), 0) AS share_pct FROM e)"""


@query("a05_traders", f"{TRADERS} SELECT * FROM t")
def a05(spark, sf_dir):
    return op.traders(op.verified(book(spark, sf_dir)))


@query("t01_top_traders", f"{TRADERS}, r AS (SELECT *, CAST(row_number() OVER (PARTITION BY side ORDER BY depth DESC, trader) AS INTEGER) AS rank FROM t) SELECT * FROM r WHERE rank <= 10")
def t01(spark, sf_dir):
    return op.top_traders(op.verified(book(spark, sf_dir)))


@query("a06_population_audit", f"WITH {BOOK} SELECT side, merchant, count(*) AS n, count(*) FILTER (trader IS NULL) AS no_trader, count(*) FILTER (size <= 0) AS no_size FROM book GROUP BY ALL")
def a06(spark, sf_dir):
    return book(spark, sf_dir).groupBy("side", "merchant").agg(F.count("*").alias("n"), F.count_if(F.expr("trader IS NULL")).alias("no_trader"), F.count_if(F.expr("size <= 0")).alias("no_size"))


@query("p07_verified_population", f"WITH {GOOD} SELECT snapshot, count(*) AS n, count(DISTINCT trader) AS n_traders FROM good GROUP BY snapshot")
def p07(spark, sf_dir):
    return op.verified(book(spark, sf_dir)).groupBy("snapshot").agg(F.count("*").alias("n"), F.countDistinct("trader").alias("n_traders"))


@query("w16_price_outliers", f"""WITH {GOOD}, m AS (SELECT snapshot, side, CAST(sum(price4 * size) AS DOUBLE) / nullif(sum(size), 0) AS mean4 FROM good GROUP BY ALL)
SELECT snapshot, side, flag, count(*) AS n FROM (SELECT snapshot, side, CASE WHEN abs(price4 - mean4) * 100 >= 20 * mean4 THEN 'hard' WHEN abs(price4 - mean4) * 100 >= 15 * mean4 THEN 'soft' ELSE 'ok' END AS flag FROM good JOIN m USING (snapshot, side)) GROUP BY ALL""")
def w16(spark, sf_dir):
    return op.outliers(op.verified(book(spark, sf_dir))).groupBy("snapshot", "side", "flag").agg(F.count("*").alias("n"))


MEMBERS = BOOK + """, m AS (SELECT DISTINCT snapshot, side, trader FROM book), o AS (SELECT snapshot, lag(snapshot) OVER (ORDER BY snapshot) AS previous FROM (SELECT DISTINCT snapshot FROM book)),
 c AS (SELECT o.snapshot, side, trader FROM m JOIN o ON m.snapshot = o.previous)"""


@query("w05_membership_flow", f"""WITH {MEMBERS}, j AS (SELECT coalesce(m.snapshot, c.snapshot) AS snapshot, coalesce(m.side, c.side) AS side, m.snapshot AS now, c.snapshot AS was FROM m FULL JOIN c ON m.snapshot = c.snapshot AND m.side = c.side AND m.trader IS NOT DISTINCT FROM c.trader),
 g AS (SELECT snapshot, side, count(now) AS n, count(*) FILTER (now IS NOT NULL AND was IS NULL) AS new, count(*) FILTER (now IS NULL) AS gone FROM j GROUP BY ALL)
SELECT g.snapshot, side, n, CASE WHEN previous IS NULL THEN 0 ELSE new END AS new, CASE WHEN previous IS NULL THEN 0 ELSE gone END AS gone FROM g JOIN o USING (snapshot)""")
def w05(spark, sf_dir):
    return op.flow(book(spark, sf_dir))


@query("j14_membership_diff", f"""WITH {MEMBERS} SELECT snapshot, side, trader, 'new' AS change FROM (SELECT m.* FROM m JOIN o USING (snapshot) WHERE previous IS NOT NULL EXCEPT SELECT * FROM c)
UNION ALL SELECT snapshot, side, trader, 'gone' FROM (SELECT * FROM c EXCEPT SELECT * FROM m)""")
def j14(spark, sf_dir):
    rows = book(spark, sf_dir)
    members = rows.select("snapshot", "side", "trader").distinct()
    order = op.snapshots(rows).where("previous IS NOT NULL")
    carried = members.withColumnRenamed("snapshot", "previous").join(order, "previous").select("snapshot", "side", "trader")
    later = members.join(order.select("snapshot"), "snapshot", "left_semi")
    keys = ["snapshot", "side", "trader"]
    new = later.join(carried, keys, "left_anti").withColumn("change", F.lit("new"))
    return new.union(carried.join(members, keys, "left_anti").withColumn("change", F.lit("gone")))


@query("u02_trader_difference", f"""WITH {BOOK}, a AS (SELECT trader, size FROM book WHERE side = 'BUY'), b AS (SELECT trader, size FROM book WHERE side = 'SELL')
SELECT trader, size, 'first only' AS kind FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT trader, size, 'second only' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def u02(spark, sf_dir):
    rows = book(spark, sf_dir)
    a, b = rows.where("side = 'BUY'").select("trader", "size"), rows.where("side = 'SELL'").select("trader", "size")
    return a.subtract(b).withColumn("kind", F.lit("first only")).union(b.subtract(a).withColumn("kind", F.lit("second only")))


@query("a39_price_deciles", f"WITH {GOOD}, q AS (SELECT side, quantile_cont(price4, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]) AS v FROM good GROUP BY side) SELECT side, CAST(i AS INTEGER) AS decile, round(CAST(v[i + 1] AS DOUBLE), 2) AS price4 FROM q, range(0, 11) r(i)")
def a39(spark, sf_dir):
    return op.price_deciles(op.verified(book(spark, sf_dir))).withColumn("price4", F.round("price4", 2))


@query("a11_columnar_pack", f"WITH {WALK} SELECT side, list(snapshot ORDER BY snapshot) AS snapshots, list(vwap_10 ORDER BY snapshot) AS values FROM vwaps GROUP BY side")
def a11(spark, sf_dir):
    return op.columnar(op.vwap_by_depth(op.verified(book(spark, sf_dir))), "vwap_10")


@query("a12_dictionary_codes", f"WITH {BOOK} SELECT trader, row_number() OVER (ORDER BY first, trader) - 1 AS code FROM (SELECT trader, min(snapshot) AS first FROM book GROUP BY trader)")
def a12(spark, sf_dir):
    return op.dictionary(book(spark, sf_dir))


@query("a12_row_offsets", f"WITH {BOOK} SELECT snapshot, CAST(sum(n) OVER (ORDER BY snapshot) - n AS BIGINT) AS offset, n FROM (SELECT snapshot, count(*) AS n FROM book GROUP BY snapshot)")
def a12b(spark, sf_dir):
    return op.row_offsets(book(spark, sf_dir))


@query("t02_latest_summaries", f"WITH {BOOK} SELECT snapshot, side, count(*) AS n, min(price4) AS lowest, max(price4) AS highest, CAST(sum(size) AS BIGINT) AS depth FROM book GROUP BY ALL ORDER BY snapshot DESC, side LIMIT 6")
def t02(spark, sf_dir):
    return op.summary(book(spark, sf_dir)).orderBy(F.desc("snapshot"), "side").limit(6)


@query("a19_weighted_mean_check", f"""WITH {GOOD}, c AS (SELECT snapshot, CAST(sum(price4 * size) AS DOUBLE) / nullif(sum(size), 0) AS computed FROM good WHERE side = 'SELL' GROUP BY snapshot),
 p AS (SELECT snapshot, CAST(sum(price4) AS DOUBLE) / count(*) AS published FROM good WHERE side = 'SELL' AND snapshot >= '1999' GROUP BY snapshot)
SELECT snapshot, CASE WHEN computed IS NULL THEN 'published only' WHEN published IS NULL THEN 'computed only' WHEN abs(computed - published) <= 0.01 * computed THEN 'ok' ELSE 'differs' END AS status FROM c FULL JOIN p USING (snapshot)""")
def a19(spark, sf_dir):
    sells = op.verified(book(spark, sf_dir)).where("side = 'SELL'")
    computed = sells.groupBy("snapshot").agg((F.sum(F.col("price4") * F.col("size")) / F.nullif(F.sum("size"), F.lit(0))).alias("computed"))
    published = sells.where("snapshot >= '1999'").groupBy("snapshot").agg((F.sum("price4") / F.count("*")).alias("published"))
    status = F.when(F.col("computed").isNull(), "published only").when(F.col("published").isNull(), "computed only").when(F.abs(F.col("computed") - F.col("published")) <= 0.01 * F.col("computed"), "ok").otherwise("differs")
    return computed.join(published, "snapshot", "full").select("snapshot", status.alias("status"))


#: Rows of a task that counts by key.
KEYS = 500_000


@query("a35_conflicting_keys", f"WITH {BOOK} SELECT ad_id, line, count(*) AS n, count(DISTINCT price4) AS n_prices FROM book GROUP BY ALL HAVING count(DISTINCT price4) > 1")
def a35(spark, sf_dir):
    rows = book(spark, sf_dir).select("ad_id", "line", "price4")
    # nearly every row has a key of its own: dealt out by key first, a task holds the keys of some KEYS rows and nothing is moved twice
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // KEYS))
    each = rows.repartition(n, "ad_id", "line").groupBy("ad_id", "line").agg(F.count("*").alias("n"), F.countDistinct("price4").alias("n_prices"))
    return each.where("n_prices > 1")


@query("s10_keyed_replace", f"WITH {BOOK} SELECT ad_id, line, snapshot, side, price4, size, trader FROM (SELECT *, row_number() OVER (PARTITION BY ad_id, line ORDER BY snapshot DESC, price4 DESC, size DESC, trader DESC, side DESC) AS k FROM book) WHERE k = 1")
def s10(spark, sf_dir):
    from ..sources.tables import keyed_replace

    rows = book(spark, sf_dir).select("ad_id", "line", "snapshot", "side", "price4", "size", "trader")
    old, new = rows.where("snapshot < '1999'"), rows.where("snapshot >= '1999'")
    return keyed_replace(old, new, ["ad_id", "line"], ["snapshot", "price4", "size", "trader", "side"])
