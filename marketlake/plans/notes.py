"""Queries over notes, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import NOTE, note
from ..functions import text as fn
from ..operators import notes as op
from ..registry import query
from ..session import table

FOLD = "trim(regexp_replace(translate(lower({0}), '%s', '%s'), '[ \\t\\n\\r]+', ' ', 'g'))" % (fn.MARKED, fn.PLAIN)
WORD = "regexp_matches({0}, '(^|[^0-9a-z]){1}([^0-9a-z]|$)')"
RULES = {"economy": (["the", "der"], ["and", "und"]), "politics": (["les", "que"], ["de", "la"]), "energy": (["para", "los"], ["el", "en"])}
EXCLUDE = ["erthe", "estion"]
KEYWORDS = ["the", "der", "les", "para", "token", "license"]


@query("f01_fold", f"WITH {NOTE} SELECT id, {FOLD.format('title')} AS folded FROM note")
def f01(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.fold(F.col("title")).alias("folded"))


@query("f02_slug", f"WITH {NOTE} SELECT id, trim(regexp_replace({FOLD.format('title')}, '[^a-z0-9]+', '_', 'g'), '_') AS slug FROM note")
def f02(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.slug(F.col("title")).alias("slug"))


@query("f03_name_key", f"SELECT n_nationkey, regexp_replace({FOLD.format("regexp_replace(n_name || ' (Region ' || n_regionkey || ')', '\\s*\\([^()]*\\)\\s*$', '')")}, '[^a-z0-9]', '', 'g') AS name_key FROM nation")
def f03(spark, sf_dir):
    name = F.concat("n_name", F.lit(" (Region "), F.col("n_regionkey").cast("string"), F.lit(")"))
    return table(spark, sf_dir, "nation").select("n_nationkey", fn.name_key(name).alias("name_key"))


@query("f07_url_key", """WITH a AS (SELECT page_id, regexp_replace(lower(trim(url)), '#.*$', '') AS u FROM pages), b AS (SELECT page_id, regexp_replace(regexp_extract(u, '^([^?]*)', 1), '/+$', '') AS path, list_filter(string_split(regexp_extract(u, '[?](.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=&]*|fbclid|gclid|mc_cid|mc_eid)(=|$)')) AS kept FROM a),
 c AS (SELECT page_id, path || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS url FROM b) SELECT page_id, url, substr(md5(url), 1, 16) AS id FROM c""")
def f07(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", fn.url_key(F.col("url")).alias("url"))
    return rows.withColumn("id", F.substring(F.md5("url"), 1, 16))


@query("f08_html_text", "SELECT page_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&#[0-9]+;|&[0-9A-Za-z_]+;', ' ', 'g'), '[ \\t\\n\\r]+', ' ', 'g'))) AS text_md5 FROM pages")
def f08(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.md5(fn.html_text(F.col("html"))).alias("text_md5"))


@query("f09_cut_at_word", f"WITH {NOTE}, t AS (SELECT id, trim(body) AS t FROM note), h AS (SELECT id, t, substr(t, 1, 40) AS head, regexp_extract(substr(t, 1, 40), '(?s)^(.*) [^ ]*$', 1) AS words FROM t) SELECT id, CASE WHEN length(t) <= 40 THEN t ELSE regexp_replace(CASE WHEN length(words) >= 20 THEN words ELSE head END, '[ ,;:.]+$', '') || '…' END AS short FROM h")
def f09(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.cut_at_word(F.col("body"), 40, "…").alias("short"))


@query("f14_spanish_number", "WITH t AS (SELECT o_orderkey, CAST(o_orderkey % 900 AS VARCHAR) || '.' || lpad(CAST(o_custkey % 1000 AS VARCHAR), 3, '0') || ',' || CAST(o_orderkey % 10 AS VARCHAR) || CASE WHEN o_orderkey % 11 = 0 THEN 'x' ELSE '' END AS s FROM orders) SELECT o_orderkey, CASE WHEN regexp_matches(s, '^-?[0-9.]*,?[0-9]+$') THEN CAST(replace(replace(s, '.', ''), ',', '.') AS DOUBLE) END AS value FROM t")
def f14(spark, sf_dir):
    s = F.expr("concat(o_orderkey % 900, '.', lpad(CAST(o_custkey % 1000 AS STRING), 3, '0'), ',', o_orderkey % 10, if(o_orderkey % 11 = 0, 'x', ''))")
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.spanish_number(s).alias("value"))


@query("f29_url_host", "SELECT page_id, regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host FROM pages")
def f29(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_extract("url", "^[a-z]+://([^/]+)", 1).alias("host"))


@query("p04_keyword_scan", f"WITH {NOTE}, f AS (SELECT id, {FOLD.format('title')} AS t FROM note) SELECT id, nullif(concat_ws(',', " + ", ".join(f"CASE WHEN {WORD.format('t', k)} THEN '{k}' END" for k in sorted(KEYWORDS)) + "), '') AS hits FROM f")
def p04(spark, sf_dir):
    return note(spark, sf_dir).select("id", F.array_join(op.keyword_hits(fn.fold(F.col("title")), KEYWORDS), ",").alias("hits"))


SCORES = ", ".join("(CASE WHEN {s} > 0 THEN {s} * 10 + {w} ELSE 0 END) AS s{k}".format(k=k, s="(" + " + ".join(f"CAST({WORD.format('t', x)} AS INTEGER)" for x in strong) + ")", w="(" + " + ".join(f"CAST({WORD.format('t', x)} AS INTEGER)" for x in weak) + ")") for k, (strong, weak) in enumerate(RULES.values()))
VETO = " OR ".join(WORD.format("t", x) for x in EXCLUDE)


@query("m05_topic_classifier", f"""WITH {NOTE}, f AS (SELECT id, {FOLD.format('title')} AS t FROM note), s AS (SELECT id, {SCORES}, {VETO} AS veto FROM f), b AS (SELECT *, greatest(s0, s1, s2) AS best FROM s)
SELECT id, CASE WHEN best = 0 OR veto THEN NULL WHEN s0 = best THEN 'economy' WHEN s1 = best THEN 'politics' ELSE 'energy' END AS topic, CAST(CASE WHEN best = 0 OR veto THEN 0 ELSE best END AS INTEGER) AS topic_score FROM b""")
def m05(spark, sf_dir):
    return op.classify(note(spark, sf_dir).select("id", "title"), "title", RULES, EXCLUDE).select("id", "topic", "topic_score")


CAPPED = NOTE + ", c AS (SELECT id, fecha, score10, row_number() OVER (PARTITION BY fecha ORDER BY score10 DESC, CAST(id % 3 = 0 AS INTEGER) DESC, id DESC) <= 10 AS kept FROM note)"


@query("w18_daily_cap", f"WITH {CAPPED} SELECT id, fecha, kept FROM c")
def w18(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", "fecha", "score10", (F.col("id") % 3 == 0).cast("int").alias("incumbent"))
    return op.daily_cap(rows, 10).select("id", "fecha", "kept")


@query("w21_representatives", f"""WITH {NOTE}, n AS (SELECT *, id % 97 AS cluster, length(portal) % 3 AS tier FROM note), r AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY tier, score10 DESC, id) AS k FROM n)
SELECT r.cluster, r.id, max(n.score10) AS best, coalesce(string_agg(DISTINCT n.portal, ',' ORDER BY n.portal) FILTER (n.portal <> r.portal), '') AS also_in FROM r JOIN n USING (cluster) WHERE k = 1 GROUP BY r.cluster, r.id""")
def w21(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", "portal", "score10", (F.col("id") % 97).alias("cluster"), (F.length("portal") % 3).alias("tier"))
    return op.representatives(rows, "cluster", "tier")


@query("a13_funnel", f"WITH {NOTE}, e AS (SELECT *, CASE WHEN quality = 0 THEN 'low quality' WHEN length(title) < 15 THEN 'short title' WHEN score10 < 33 THEN 'below cut' ELSE 'kept' END AS stage FROM note) SELECT stage, count(*) AS n, (SELECT count(*) FROM note) AS total FROM e GROUP BY stage")
def a13(spark, sf_dir):
    stage = F.when(F.col("quality") == 0, "low quality").when(F.length("title") < 15, "short title").when(F.col("score10") < 33, "below cut").otherwise("kept")
    counts = note(spark, sf_dir).groupBy(stage.alias("stage")).agg(F.count("*").alias("n"))
    return counts.withColumn("total", F.sum("n").over(Window.partitionBy()))  # a row per stage


@query("a14_discards_by_portal", f"WITH {NOTE}, e AS (SELECT portal, CASE WHEN quality = 0 THEN 'low quality' WHEN length(title) < 15 THEN 'short title' WHEN score10 < 33 THEN 'below cut' ELSE 'kept' END AS reason FROM note) SELECT reason, portal, count(*) AS n FROM e GROUP BY ROLLUP (reason, portal)")
def a14(spark, sf_dir):
    reason = F.when(F.col("quality") == 0, "low quality").when(F.length("title") < 15, "short title").when(F.col("score10") < 33, "below cut").otherwise("kept")
    return note(spark, sf_dir).select(reason.alias("reason"), "portal").rollup("reason", "portal").agg(F.count("*").alias("n"))


@query("m07_institutional_boost", f"WITH {NOTE} SELECT id, CASE WHEN portal IN ('src1', 'src2') AND score10 >= 67 THEN least(score10 + 10, 100) ELSE score10 END AS boosted FROM note")
def m07(spark, sf_dir):
    boosted = F.when(F.col("portal").isin("src1", "src2") & (F.col("score10") >= 67), F.least(F.col("score10") + 10, F.lit(100))).otherwise(F.col("score10"))
    return note(spark, sf_dir).select("id", boosted.alias("boosted"))


@query("f23_bands", f"WITH {NOTE} SELECT id, CASE WHEN score10 >= 80 THEN 'high' WHEN score10 >= 70 THEN 'medium' ELSE 'low' END AS impact FROM note")
def f23(spark, sf_dir):
    return note(spark, sf_dir).select("id", F.when(F.col("score10") >= 80, "high").when(F.col("score10") >= 70, "medium").otherwise("low").alias("impact"))


@query("t03_feed_order", f"WITH {NOTE} SELECT id, row_number() OVER (ORDER BY fecha DESC, score10 DESC, id) AS place FROM note")
def t03(spark, sf_dir):
    return op.feed_places(note(spark, sf_dir)).select("id", "place")


@query("j02_hidden_ids", f"WITH {NOTE} SELECT id, portal FROM note WHERE id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1 AND doc_id IS NOT NULL)")
def j02(spark, sf_dir):
    hidden = table(spark, sf_dir, "labels").where("toxic = 1").select(F.col("doc_id").alias("id"))
    return note(spark, sf_dir).select("id", "portal").join(hidden, "id", "left_anti")


@query("a34_set_version", "SELECT substr(sha256(string_agg(CAST(doc_id AS VARCHAR), ',' ORDER BY CAST(doc_id AS VARCHAR))), 1, 16) AS version FROM (SELECT DISTINCT doc_id FROM labels WHERE toxic = 1)")
def a34(spark, sf_dir):
    # the hidden set, which people keep by hand
    ids = F.array_join(F.array_sort(F.collect_set(F.col("doc_id").cast("string"))), ",")
    return table(spark, sf_dir, "labels").where("toxic = 1").agg(F.substring(F.sha2(ids, 256), 1, 16).alias("version"))


@query("p10_section_labels", "WITH c AS (SELECT conv_id, turn, role, CASE WHEN role = 'user' THEN text END AS head FROM conversations), d AS (SELECT conv_id, turn, max(head) AS head FROM c GROUP BY ALL) SELECT conv_id, turn, last_value(head IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS section FROM d")
def p10(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("head"))
    rows = rows.groupBy("conv_id", "turn").agg(F.max("head").alias("head"))
    order = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    return rows.select("conv_id", "turn", F.last("head", ignorenulls=True).over(order).alias("section"))


@query("a29_items_per_conversation", "SELECT conv_id, count(*) AS n, count(DISTINCT role) AS roles FROM conversations GROUP BY conv_id")
def a29(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("n"), F.countDistinct("role").alias("roles"))


@query("p11_url_schemes", "SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https?://') AND NOT regexp_matches(url, '/(sponsored|ads)/')")
def p11(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", "url").where(F.col("url").rlike("^https?://") & ~F.col("url").rlike("/(sponsored|ads)/"))


@query("s22_link_harvest", """WITH a AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, '<a href="([^"]+)"', 1))) AS link FROM pages), r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY link) AS k FROM a) SELECT page_id, link FROM r WHERE k <= 40""")
def s22(spark, sf_dir):
    links = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('<a href="([^"]+)"'), F.lit(1)))).alias("link"))
    return links.withColumn("k", F.row_number().over(Window.partitionBy("page_id").orderBy("link"))).where("k <= 40").drop("k")
