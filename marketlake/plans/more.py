"""Queries on snapshots as nested documents, keys and sets, calendars of items, and rule ladders."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import MACRO, NOTE, TICK, macro, note, tick
from ..operators import notes as notes_op
from ..registry import query
from ..session import table


@query("s02_file_by_stem", f"WITH {TICK}, f AS (SELECT event_id // 2 AS stem, CASE WHEN event_id % 2 = 0 THEN '.json' ELSE '.json.gz' END AS ext, user_id % 2 AS root FROM tick) SELECT stem, arg_min(ext, (ext <> '.json.gz', root)) AS ext FROM f GROUP BY stem")
def s02(spark, sf_dir):
    files = tick(spark, sf_dir).select(F.expr("event_id DIV 2").alias("stem"), F.when(F.col("event_id") % 2 == 0, ".json").otherwise(".json.gz").alias("ext"), (F.col("user_id") % 2).alias("root"))
    return files.groupBy("stem").agg(F.min_by("ext", F.struct(F.col("ext") != ".json.gz", "root")).alias("ext"))


@query("s06_above_watermark", f"WITH {TICK} SELECT strftime(ts, '%Y-%m-%d') AS stem, count(*) AS n FROM tick WHERE strftime(ts, '%Y-%m-%d') > '2024-01-20' GROUP BY 1")
def s06(spark, sf_dir):
    rows = tick(spark, sf_dir).withColumn("stem", F.date_format("ts", "yyyy-MM-dd"))
    return rows.where("stem > '2024-01-20'").groupBy("stem").agg(F.count("*").alias("n"))


@query("s20_valid_mirror", "SELECT DISTINCT substr(md5(CAST(doc_id AS VARCHAR)), 1, CASE WHEN doc_id % 5 = 0 THEN 15 ELSE 16 END) AS id FROM labels WHERE doc_id % 5 <> 0")
def s20(spark, sf_dir):
    ids = table(spark, sf_dir, "labels").select(F.expr("substr(md5(CAST(doc_id AS STRING)), 1, if(doc_id % 5 = 0, 15, 16))").alias("id"))
    return ids.where(F.col("id").rlike("^[0-9a-f]{16}$")).distinct()


@query("p05_sparse_fields", f"WITH {TICK} SELECT event_id, concat_ws(',', CASE WHEN cents > 3000 THEN 'max' END, CASE WHEN user_id % 2 = 0 THEN 'min' END) AS present, CAST(cents > 3000 OR user_id % 2 = 0 AS INTEGER) AS has_any FROM tick")
def p05(spark, sf_dir):
    fields = F.create_map(F.lit("max"), F.when(F.col("cents") > 3000, F.col("cents")), F.lit("min"), F.when(F.col("user_id") % 2 == 0, F.col("user_id")))
    rows = tick(spark, sf_dir).select("event_id", F.map_filter(fields, lambda k, v: v.isNotNull()).alias("fields"))
    return rows.select("event_id", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("present"), (F.size("fields") > 0).cast("int").alias("has_any"))


@query("p08_plausible_rates", f"WITH {TICK} SELECT event_id, CASE WHEN cents BETWEEN 400 AND 3000 AND cents % 100 <> 0 THEN cents END AS rate, CASE WHEN cents > 0 AND cents < 10000 THEN cents END AS deposit FROM tick")
def p08(spark, sf_dir):
    c = F.col("cents")
    return tick(spark, sf_dir).select("event_id", F.when(c.between(400, 3000) & (c % 100 != 0), c).alias("rate"), F.when((c > 0) & (c < 10000), c).alias("deposit"))


@query("p13_wide_offers", "SELECT p_partkey, plan, offer FROM (SELECT p_partkey, nullif(p_size % 3, 0) AS mn_30, nullif(p_size % 5, 0) AS mn_60, p_size AS me_30 FROM part) UNPIVOT (offer FOR plan IN (mn_30, mn_60, me_30))")
def p13(spark, sf_dir):
    wide = table(spark, sf_dir, "part").selectExpr("p_partkey", "nullif(p_size % 3, 0) AS mn_30", "nullif(p_size % 5, 0) AS mn_60", "p_size AS me_30")
    return wide.unpivot(["p_partkey"], ["mn_30", "mn_60", "me_30"], "plan", "offer").where("offer IS NOT NULL")


@query("j06_crosswalk", "WITH n AS (SELECT n_nationkey, n_regionkey, 'R' || n_nationkey % 20 AS key FROM nation), u AS (SELECT n_regionkey, key, min(n_nationkey) AS k FROM n GROUP BY ALL HAVING count(*) = 1), s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN s_nationkey END AS code, s_nationkey % 5 AS region, 'R' || s_nationkey % 20 AS key FROM supplier) SELECT s_suppkey, coalesce(n.n_nationkey, u.k) AS nation FROM s LEFT JOIN n ON n.n_nationkey = s.code LEFT JOIN u ON u.n_regionkey = s.region AND u.key = s.key")
def j06(spark, sf_dir):
    names = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey", F.concat(F.lit("R"), F.col("n_nationkey") % 20).alias("key"))
    unique = names.groupBy(F.col("n_regionkey").alias("region"), "key").agg(F.count("*").alias("n"), F.min("n_nationkey").alias("k")).where("n = 1").drop("n")
    rows = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "if(s_suppkey % 2 = 0, s_nationkey, NULL) AS code", "s_nationkey % 5 AS region", "concat('R', s_nationkey % 20) AS key")
    first = rows.join(F.broadcast(names.select(F.col("n_nationkey").alias("code"), F.col("n_nationkey").alias("by_code"))), "code", "left")  # 25 rows
    return first.join(F.broadcast(unique), ["region", "key"], "left").select("s_suppkey", F.coalesce("by_code", "k").alias("nation"))  # 25 rows at most


@query("j13_outstanding", "WITH b(name, issue, maturity) AS (VALUES ('a', DATE '1996-01-01', DATE '1999-01-01'), ('b', DATE '1998-06-01', DATE '2001-06-01')), d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS fecha FROM orders) SELECT fecha, name FROM d JOIN b ON issue <= fecha AND fecha < maturity")
def j13(spark, sf_dir):
    bonds = spark.sql("SELECT * FROM VALUES ('a', DATE '1996-01-01', DATE '1999-01-01'), ('b', DATE '1998-06-01', DATE '2001-06-01') AS t(name, issue, maturity)")
    days = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha")).distinct()
    return days.join(F.broadcast(bonds), (F.col("issue") <= F.col("fecha")) & (F.col("fecha") < F.col("maturity"))).select("fecha", "name")  # contractual terms


@query("j16_seen_with_ttl", f"WITH {TICK}, p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS before FROM tick) SELECT event_id, before IS NOT NULL AND epoch_us(ts) - epoch_us(before) <= 604800000000 AS seen FROM p")
def j16(spark, sf_dir):
    """Every tick, and whether its user and type were seen in the seven days before it."""
    return notes_op.seen_within(tick(spark, sf_dir), ["user_id", "event_type"], ["ts", "event_id"], 7).select("event_id", "seen")


@query("j17_existing_ids", f"WITH {NOTE} SELECT id, id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL) AS collides FROM note")
def j17(spark, sf_dir):
    known = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id")).distinct().withColumn("there", F.lit(True))
    return note(spark, sf_dir).select("id").join(known, "id", "left").select("id", F.coalesce("there", F.lit(False)).alias("collides"))


@query("j20_labels_with_fallback", "WITH l(slug, label) AS (VALUES ('building', 'Edificios'), ('furniture', 'Muebles')), s AS (SELECT DISTINCT lower(c_mktsegment) AS slug FROM customer) SELECT slug, coalesce(label, upper(substr(slug, 1, 1)) || substr(slug, 2)) AS label FROM s LEFT JOIN l USING (slug)")
def j20(spark, sf_dir):
    labels = spark.sql("SELECT * FROM VALUES ('building', 'Edificios'), ('furniture', 'Muebles') AS t(slug, label)")
    slugs = table(spark, sf_dir, "customer").select(F.lower("c_mktsegment").alias("slug")).distinct()
    return slugs.join(F.broadcast(labels), "slug", "left").select("slug", F.coalesce("label", F.initcap("slug")).alias("label"))  # a fixed list


@query("w19_lane_cap", f"WITH {TICK}, r AS (SELECT event_id, row_number() OVER (PARTITION BY event_type, CAST(ts - INTERVAL 4 HOUR AS DATE) ORDER BY ts, event_id) AS k FROM tick) SELECT event_id FROM r WHERE k <= 5")
def w19(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("event_type", F.to_date(F.col("ts") - F.expr("INTERVAL 4 HOURS"))).orderBy("ts", "event_id"))
    return tick(spark, sf_dir).withColumn("k", k).where("k <= 5").select("event_id")


@query("w22_cluster_principal", f"WITH {NOTE} SELECT id % 97 AS cluster, arg_max(id, (score10, length(body), -id)) AS id FROM note GROUP BY 1")
def w22(spark, sf_dir):
    return note(spark, sf_dir).groupBy((F.col("id") % 97).alias("cluster")).agg(F.max_by("id", F.struct("score10", F.length("body"), -F.col("id"))).alias("id"))


@query("w23_series_selection", f"WITH {MACRO}, s AS (SELECT slug, max(periodo) >= '1999-01' AS live, slug = 'building' AS national, count(*) AS span FROM macro WHERE slug <> 'machinery' OR periodo < '1997-01' GROUP BY slug) SELECT slug, CAST(row_number() OVER (ORDER BY live DESC, national DESC, span DESC, slug) AS INTEGER) AS place FROM s")
def w23(spark, sf_dir):
    series = macro(spark, sf_dir).where("slug <> 'machinery' OR periodo < '1997-01'").groupBy("slug").agg((F.max("periodo") >= "1999-01").alias("live"), F.count("*").alias("span"))
    order = Window.orderBy(F.desc("live"), F.desc(F.col("slug") == "building"), F.desc("span"), "slug")  # a row per series
    return series.select("slug", F.row_number().over(order).alias("place"))


@query("w28_first_of_period", f"WITH {TICK} SELECT strftime(ts, '%Y-%m-%d') AS period, arg_min(event_id, (ts, event_id)) AS event_id FROM tick GROUP BY 1")
def w28(spark, sf_dir):
    return tick(spark, sf_dir).groupBy(F.date_format("ts", "yyyy-MM-dd").alias("period")).agg(F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("w31_section_labels", f"WITH {NOTE}, r AS (SELECT id, lang, row_number() OVER (PARTITION BY fecha, lang ORDER BY score10 DESC, id) AS k FROM note) SELECT id, CASE WHEN lang = 'fr' THEN 'lane' WHEN k = 1 THEN 'lead' WHEN k <= 6 THEN 'top' ELSE 'rest' END AS section FROM r")
def w31(spark, sf_dir):
    k = F.row_number().over(Window.partitionBy("fecha", "lang").orderBy(F.desc("score10"), "id"))
    rows = note(spark, sf_dir).select("id", "lang", k.alias("k"))
    return rows.select("id", F.when(F.col("lang") == "fr", "lane").when(F.col("k") == 1, "lead").when(F.col("k") <= 6, "top").otherwise("rest").alias("section"))


@query("t04_retry_candidates", f"WITH {NOTE}, a AS (SELECT id, score10, quality, CAST(count(*) OVER (PARTITION BY coalesce(body, '')) AS BIGINT) AS attempts FROM note) SELECT id FROM a WHERE quality IS NULL AND attempts < 3 ORDER BY score10 DESC, id LIMIT 5")
def t04(spark, sf_dir):
    """A text's rows stand for the attempts at it."""
    rows = note(spark, sf_dir)
    attempts = rows.groupBy(F.md5(F.coalesce("body", F.lit(""))).alias("key")).agg(F.count("*").alias("attempts"))
    return notes_op.retry_candidates(rows.withColumn("key", F.md5(F.coalesce("body", F.lit("")))).join(attempts, "key", "left"), "quality IS NULL", 3, 5).select("id")


@query("t06_latest_link", "SELECT regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host, arg_max(page_id, (CAST(regexp_extract(url, '/([0-9]+)', 1) AS BIGINT), page_id)) AS page_id FROM pages WHERE regexp_matches(url, '/[0-9]+') GROUP BY 1")
def t06(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").where(F.col("url").rlike("/[0-9]+")).select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"), F.regexp_extract("url", "/([0-9]+)", 1).cast("long").alias("n"))
    return rows.groupBy("host").agg(F.max_by("page_id", F.struct("n", "page_id")).alias("page_id"))


@query("u05_union_of_exits", f"WITH {NOTE}, u AS (SELECT id, fecha, 'quality' AS salida FROM note WHERE quality = 0 UNION ALL SELECT id, fecha, 'short' FROM note WHERE length(title) < 15 UNION ALL SELECT id, fecha, 'cut' FROM note WHERE score10 < 33) SELECT id, max(salida) AS salida FROM u WHERE fecha >= DATE '2024-01-08' GROUP BY id")
def u05(spark, sf_dir):
    rows = note(spark, sf_dir)
    exits = [("quality", "quality = 0"), ("short", "length(title) < 15"), ("cut", "score10 < 33")]
    parts = [rows.where(cond).select("id", "fecha", F.lit(name).alias("salida")) for name, cond in exits]
    log = parts[0].unionByName(parts[1]).unionByName(parts[2]).where("fecha >= DATE '2024-01-08'")
    return log.groupBy("id").agg(F.max("salida").alias("salida"))


@query("u06_same_keys", "SELECT (SELECT count(*) FROM (SELECT c_custkey FROM customer EXCEPT SELECT o_custkey FROM orders)) AS only_first, (SELECT count(*) FROM (SELECT o_custkey FROM orders EXCEPT SELECT c_custkey FROM customer)) AS only_second")
def u06(spark, sf_dir):
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")).distinct().withColumn("a", F.lit(1))
    b = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).distinct().withColumn("b", F.lit(1))
    return a.join(b, "k", "full").agg(F.count_if(F.col("b").isNull()).alias("only_first"), F.count_if(F.col("a").isNull()).alias("only_second"))


@query("f15_serial_dates", "SELECT o_orderkey, CASE WHEN o_orderkey % 60000 BETWEEN 30000 AND 50000 THEN CAST(DATE '1899-12-30' + CAST(o_orderkey % 60000 AS INTEGER) AS DATE) END AS fecha FROM orders")
def f15(spark, sf_dir):
    n = (F.col("o_orderkey") % 60000).cast("int")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.when(n.between(30000, 50000), F.date_add(F.lit("1899-12-30").cast("date"), n)).alias("fecha"))


@query("m02_keyword_fallback", f"WITH {NOTE} SELECT id, CASE WHEN contains(lower(title), 'trash') THEN 0 WHEN contains(lower(title), 'license') THEN 10 ELSE least(CAST(contains(lower(title), 'th') AS INTEGER) + CAST(contains(lower(title), 'er') AS INTEGER), 10) END AS score FROM note")
def m02(spark, sf_dir):
    t = F.lower("title")
    topics = F.contains(t, F.lit("th")).cast("int") + F.contains(t, F.lit("er")).cast("int")
    score = F.when(F.contains(t, F.lit("trash")), 0).when(F.contains(t, F.lit("license")), 10).otherwise(F.least(topics, F.lit(10)))
    return note(spark, sf_dir).select("id", score.alias("score"))


@query("m19_response_validity", "SELECT conv_id, turn, role = 'assistant' AND length(trim(text)) > 0 AND NOT regexp_matches(lower(text), '^(sorry|lo siento|n/a)') AS valid, md5(text) AS text_md5 FROM conversations")
def m19(spark, sf_dir):
    valid = (F.col("role") == "assistant") & (F.length(F.trim("text")) > 0) & ~F.lower("text").rlike("^(sorry|lo siento|n/a)")
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", valid.alias("valid"), F.md5("text").alias("text_md5"))
