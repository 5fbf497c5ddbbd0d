"""Queries over macro facts, trade records and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import MACRO, TRADE, macro, trade
from ..operators import facts as op
from ..registry import query
from ..session import table
from ..sources.tables import overlay

SLUGS = ["automobile", "building", "furniture", "household", "machinery"]
#: Weights of the index that the contributions are of.
WEIGHTS = {"automobile": 5, "building": 3, "furniture": 2, "household": 4, "machinery": 1}
WIDE = MACRO + ", wide AS (SELECT periodo, " + ", ".join(f"CAST(sum(valor) FILTER (slug = '{s}') AS BIGINT) AS {s}" for s in SLUGS) + " FROM macro GROUP BY periodo)"


@query("a10_dense_series", f"WITH {WIDE} SELECT * FROM wide")
def a10(spark, sf_dir):
    return op.dense(macro(spark, sf_dir), SLUGS)


@query("p14_wide_to_long", f"WITH {WIDE} SELECT periodo, slug, valor FROM wide UNPIVOT (valor FOR slug IN ({', '.join(SLUGS)}))")
def p14(spark, sf_dir):
    return op.long(op.dense(macro(spark, sf_dir), SLUGS), "periodo", SLUGS)


@query("a27_contributions", f"""WITH {MACRO}, w(slug, weight) AS (VALUES {", ".join(f"('{s}', {w})" for s, w in WEIGHTS.items())}), m AS (SELECT *, CAST(substr(periodo, 1, 4) AS INTEGER) * 12 + CAST(substr(periodo, 6, 2) AS INTEGER) AS n FROM macro JOIN w USING (slug)), t AS (SELECT n, sum(valor * weight) AS total FROM m GROUP BY n)
SELECT a.periodo, a.slug, CAST(CAST(a.weight * (a.valor - b.valor) * 100 AS BIGINT) AS DOUBLE) / CAST(t.total AS DOUBLE) AS contribution FROM m a JOIN m b ON b.n = a.n - 12 AND b.slug = a.slug JOIN t ON t.n = a.n - 12""")
def a27(spark, sf_dir):
    rows = macro(spark, sf_dir)
    weights = F.create_map(*[F.lit(x) for pair in WEIGHTS.items() for x in pair])
    weighted = rows.withColumn("weight", weights[F.col("slug")])
    totals = weighted.groupBy("periodo").agg(F.sum(F.col("weight") * F.col("valor")).alias("total"))
    return op.contributions(weighted, totals)


@query("j11_official_over_provisional", f"WITH {MACRO}, o AS (SELECT * FROM macro WHERE substr(periodo, 6, 2) <> '06'), p AS (SELECT periodo, slug, valor + 1 AS valor FROM macro WHERE substr(periodo, 6, 2) IN ('05', '06')) SELECT *, 0 AS provisional FROM o UNION ALL SELECT p.*, 1 FROM p ANTI JOIN o USING (periodo, slug)")
def j11(spark, sf_dir):
    rows = macro(spark, sf_dir)
    provisional = rows.where("substr(periodo, 6, 2) IN ('05', '06')").withColumn("valor", F.col("valor") + 1)
    return overlay(rows.where("substr(periodo, 6, 2) <> '06'"), provisional, ["periodo", "slug"])


@query("u04_period_axis", f"WITH {MACRO} SELECT periodo FROM macro WHERE slug = 'building' UNION SELECT periodo FROM macro WHERE slug = 'furniture'")
def u04(spark, sf_dir):
    rows = macro(spark, sf_dir)
    return rows.where("slug = 'building'").select("periodo").union(rows.where("slug = 'furniture'").select("periodo")).distinct()


@query("p17_metric_slug_split", f"WITH {MACRO}, x AS (SELECT periodo, CASE WHEN substr(periodo, 6, 2) = '01' THEN 'var_12m_' ELSE 'indice_' END || slug AS indicador FROM macro) SELECT regexp_extract(indicador, '^(indice|var_12m|var_mensual)_(.*)$', 1) AS metric, regexp_extract(indicador, '^(indice|var_12m|var_mensual)_(.*)$', 2) AS slug, count(*) AS n FROM x GROUP BY ALL")
def p17(spark, sf_dir):
    name = F.concat(F.when(F.substring("periodo", 6, 2) == "01", "var_12m_").otherwise("indice_"), "slug")
    part = lambda k: F.regexp_extract(name, "^(indice|var_12m|var_mensual)_(.*)$", k)
    return macro(spark, sf_dir).groupBy(part(1).alias("metric"), part(2).alias("slug")).agg(F.count("*").alias("n"))


@query("a20_trade_cube", f"WITH {TRADE} SELECT label, country, CAST(sum(fob) AS BIGINT) AS fob, CAST(sum(kg) AS BIGINT) AS kg FROM trade GROUP BY CUBE (label, country)")
def a20(spark, sf_dir):
    return trade(spark, sf_dir).cube("label", "country").agg(F.sum("fob").alias("fob"), F.sum("kg").alias("kg"))


@query("a21_top_destinations", f"""WITH {TRADE}, s AS (SELECT label, country, sum(fob) AS fob FROM trade GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY fob DESC, country) AS k FROM s)
SELECT label, CASE WHEN k <= 5 THEN country ELSE 'OTHERS' END AS country, CAST(sum(fob) AS BIGINT) AS fob FROM r GROUP BY ALL""")
def a21(spark, sf_dir):
    return op.top_with_others(trade(spark, sf_dir), "label", "country", "fob", 5)


@query("a22_completeness", f"WITH {TRADE}, y AS (SELECT CAST(substr(month, 1, 4) AS INTEGER) AS year, count(DISTINCT month) AS months FROM trade GROUP BY 1) SELECT year, months, months = 12 AS complete, (SELECT max(year) FROM y WHERE months = 12) AS base_year FROM y")
def a22(spark, sf_dir):
    years = trade(spark, sf_dir).groupBy(F.substring("month", 1, 4).cast("int").alias("year")).agg(F.countDistinct("month").alias("months"))
    base = F.max(F.when(F.col("months") == 12, F.col("year"))).over(Window.partitionBy())  # a row per year
    return years.select("year", "months", (F.col("months") == 12).alias("complete"), base.alias("base_year"))


@query("a23_modal_label", f"WITH {TRADE}, c AS (SELECT code, label, count(*) AS n FROM trade GROUP BY ALL) SELECT code, arg_min(label, (-n, label)) AS label FROM c GROUP BY code")
def a23(spark, sf_dir):
    return op.modal(trade(spark, sf_dir), "code", "label")


@query("a24_unit_value", f"WITH {TRADE} SELECT month, label, CASE WHEN sum(kg) > 0 THEN CAST(sum(fob) AS DOUBLE) / sum(kg) END AS unit_value FROM trade WHERE label IN ('ECONOMY', 'SMALL') GROUP BY ALL")
def a24(spark, sf_dir):
    rows = trade(spark, sf_dir).where(F.col("label").isin("ECONOMY", "SMALL"))
    return rows.groupBy("month", "label").agg(F.when(F.sum("kg") > 0, F.sum("fob") / F.sum("kg")).alias("unit_value"))


@query("a38_colour_scale", f"WITH {TRADE}, s AS (SELECT label, month, sum(kg) AS kg FROM trade GROUP BY ALL) SELECT label, month, CAST(kg AS BIGINT) AS kg, CAST(min(kg) OVER (PARTITION BY label) AS BIGINT) AS lo, CAST(max(kg) OVER (PARTITION BY label) AS BIGINT) AS hi FROM s")
def a38(spark, sf_dir):
    sums = trade(spark, sf_dir).groupBy("label", "month").agg(F.sum("kg").alias("kg"))
    by = Window.partitionBy("label")
    return sums.withColumns({"lo": F.min("kg").over(by), "hi": F.max("kg").over(by)})


@query("a40_seasonality", f"WITH {TRADE} SELECT CAST(substr(month, 6, 2) AS INTEGER) AS m, CAST(substr(month, 1, 4) AS INTEGER) AS year, CAST(sum(kg) AS BIGINT) AS kg FROM trade GROUP BY ALL")
def a40(spark, sf_dir):
    part = lambda at, n: F.substring("month", at, n).cast("int")
    return trade(spark, sf_dir).groupBy(part(6, 2).alias("m"), part(1, 4).alias("year")).agg(F.sum("kg").alias("kg"))


PREFIXES = [("first", ["000000000"], ["0000000007"]), ("tens", ["00000000"], []), ("rest", ["0"], [])]


@query("j09_prefix_rules", f"WITH {TRADE} SELECT CASE WHEN starts_with(code, '000000000') AND NOT starts_with(code, '0000000007') THEN 'first' WHEN starts_with(code, '00000000') THEN 'tens' WHEN starts_with(code, '0') THEN 'rest' END AS rule, count(*) AS n, count(DISTINCT code) AS codes FROM trade GROUP BY 1")
def j09(spark, sf_dir):
    return trade(spark, sf_dir).groupBy(op.first_prefix_rule("code", PREFIXES).alias("rule")).agg(F.count("*").alias("n"), F.countDistinct("code").alias("codes"))


@query("j18_export_share", f"WITH {TRADE}, e AS (SELECT label, sum(fob) AS e FROM trade WHERE country = 'NATION_1' GROUP BY 1), t AS (SELECT label, sum(fob) AS t FROM trade GROUP BY 1) SELECT label, CAST(e AS DOUBLE) / nullif(t, 0) AS share FROM e JOIN t USING (label)")
def j18(spark, sf_dir):
    rows = trade(spark, sf_dir)
    exports = rows.where("country = 'NATION_1'").groupBy("label").agg(F.sum("fob").alias("e"))
    return exports.join(rows.groupBy("label").agg(F.sum("fob").alias("t")), "label").select("label", (F.col("e") / F.nullif("t", F.lit(0))).alias("share"))


@query("j01_dimension_lookup", "SELECT s_suppkey, coalesce(n_name, 'UNKNOWN') AS nation FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey")
def j01(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return table(spark, sf_dir, "supplier").join(F.broadcast(nations), "s_nationkey", "left").select("s_suppkey", F.coalesce("n_name", F.lit("UNKNOWN")).alias("nation"))  # 25 rows


@query("j07_unique_prefix", "WITH p AS (SELECT DISTINCT CAST(p_size AS VARCHAR) AS name FROM part), m AS (SELECT a.name AS short, b.name AS long_name FROM p a JOIN p b ON starts_with(b.name, a.name) AND a.name <> b.name) SELECT short, min(long_name) AS match FROM m GROUP BY short HAVING count(*) = 1")
def j07(spark, sf_dir):
    names = table(spark, sf_dir, "part").select(F.col("p_size").cast("string").alias("full")).distinct()
    # each name is filed under all its proper prefixes, so that the match is by equality
    prefixes = names.select("full", F.explode(F.sequence(F.lit(1), F.greatest(F.length("full") - 1, F.lit(1)))).alias("n")).select("full", F.expr("substr(full, 1, n)").alias("short")).where("short <> full")
    return prefixes.join(names.select(F.col("full").alias("short")), "short").groupBy("short").agg(F.count("*").alias("n"), F.min("full").alias("match")).where("n = 1").drop("n")


POLYGONS = [("north", 0, [(0, 5), (10, 5), (10, 10), (5, 7), (0, 10)]), ("south", 1, [(0, 0), (10, 0), (10, 6), (0, 6)])]
EDGES = [(name, order, float(a[0]), float(a[1]), float(b[0]), float(b[1])) for name, order, ring in POLYGONS for a, b in zip(ring, [*ring[1:], ring[0]], strict=True)]


@query("j08_point_in_polygon", "WITH e(name, ord, x1, y1, x2, y2) AS (VALUES " + ", ".join(f"('{n}', {o}, CAST({a} AS DOUBLE), CAST({b} AS DOUBLE), CAST({c} AS DOUBLE), CAST({d} AS DOUBLE))" for n, o, a, b, c, d in EDGES) + """), p AS (SELECT c_custkey AS id, (c_custkey % 113) / 10.0 :: DOUBLE AS x, (c_custkey % 107) / 10.0 :: DOUBLE AS y FROM customer),
 h AS (SELECT id, name, ord FROM p, e WHERE (y1 > y) <> (y2 > y) AND x < (x2 - x1) * (y - y1) / (y2 - y1) + x1 GROUP BY ALL HAVING count(*) % 2 = 1), f AS (SELECT id, arg_min(name, ord) AS name FROM h GROUP BY id) SELECT name, count(*) AS n FROM p LEFT JOIN f USING (id) GROUP BY name""")
def j08(spark, sf_dir):
    edges = spark.createDataFrame(EDGES, "name string, order int, x1 double, y1 double, x2 double, y2 double")
    points = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), ((F.col("c_custkey") % 113) / 10.0).alias("x"), ((F.col("c_custkey") % 107) / 10.0).alias("y"))
    return op.in_polygon(points, edges).groupBy("name").agg(F.count("*").alias("n"))


@query("a16_active_days", "WITH r AS (SELECT o_orderpriority AS category, o_custkey % 50 AS cell, CAST(o_orderdate AS DATE) AS a FROM orders), d AS (SELECT DISTINCT category, cell, CAST(unnest(generate_series(a, a + 4, INTERVAL 1 DAY)) AS DATE) AS day FROM r) SELECT category, cell, count(*) AS days FROM d WHERE day <= DATE '2000-12-31' GROUP BY ALL")
def a16(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category"), (F.col("o_custkey") % 50).alias("cell"), F.to_date("o_orderdate").alias("a"))
    days = rows.select("category", "cell", F.explode(F.sequence("a", F.date_add("a", 4))).alias("day")).where("day <= DATE '2000-12-31'")
    return days.groupBy("category", "cell").agg(F.countDistinct("day").alias("days"))


@query("p06_quality_tiers", "WITH s AS (SELECT o_custkey, count(*) AS n, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS done FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN coalesce(n, 0) >= 12 AND coalesce(done, 0) >= 0.3 THEN 'A' WHEN coalesce(n, 0) >= 6 THEN 'B' ELSE 'C' END AS tier FROM customer LEFT JOIN s ON o_custkey = c_custkey")
def p06(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("done"))
    n, done = F.coalesce("n", F.lit(0)), F.coalesce("done", F.lit(0.0))
    tier = F.when((n >= 12) & (done >= 0.3), "A").when(n >= 6, "B").otherwise("C")
    return table(spark, sf_dir, "customer").select("c_custkey").join(sums, "c_custkey", "left").select("c_custkey", tier.alias("tier"))


@query("a28_coverage_by_year", "WITH d AS (SELECT year(o_orderdate) AS y, count(DISTINCT CAST(o_orderdate AS DATE)) AS present FROM orders GROUP BY 1) SELECT CAST(y AS INTEGER) AS year, present, greatest(0, 365 - present) AS missing FROM d")
def a28(spark, sf_dir):
    years = table(spark, sf_dir, "orders").groupBy(F.year("o_orderdate").alias("year")).agg(F.countDistinct(F.to_date("o_orderdate")).alias("present"))
    return years.withColumn("missing", F.greatest(F.lit(0), 365 - F.col("present")))


@query("a31_attribution_share", "SELECT p_type, p_brand, count(*) AS n, CAST(sum(CASE WHEN p_size > 25 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS share FROM part GROUP BY ROLLUP (p_type, p_brand)")
def a31(spark, sf_dir):
    return table(spark, sf_dir, "part").rollup("p_type", "p_brand").agg(F.count("*").alias("n"), (F.sum(F.when(F.col("p_size") > 25, 1).otherwise(0)) / F.count("*")).alias("share"))


@query("f25_code_clean", "SELECT p_partkey, lpad(regexp_replace(CAST(p_partkey AS VARCHAR) || '.0', '\\.0$', ''), 10, '0') AS code FROM part")
def f25(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.lpad(F.regexp_replace(F.concat(F.col("p_partkey").cast("string"), F.lit(".0")), r"\.0$", ""), 10, "0").alias("code"))


@query("f26_month_axis", "WITH b AS (SELECT date_trunc('month', min(o_orderdate)) AS a, date_trunc('month', max(o_orderdate)) AS b FROM orders) SELECT strftime(unnest(generate_series(a, b, INTERVAL 1 MONTH)), '%Y-%m') AS month FROM b")
def f26(spark, sf_dir):
    ends = table(spark, sf_dir, "orders").agg(F.trunc(F.to_date(F.min("o_orderdate")), "month").alias("a"), F.trunc(F.to_date(F.max("o_orderdate")), "month").alias("b"))
    months = ends.select(F.explode(F.expr("sequence(a, b, INTERVAL 1 MONTH)")).alias("m"))
    return months.select(F.date_format("m", "yyyy-MM").alias("month"))


@query("f27_day_count_30_360", "SELECT o_orderkey, (2005 - year(o_orderdate)) * 360 + (6 - month(o_orderdate)) * 30 + (15 - least(day(o_orderdate), 30)) AS days FROM orders")
def f27(spark, sf_dir):
    days = (2005 - F.year("o_orderdate")) * 360 + (6 - F.month("o_orderdate")) * 30 + (15 - F.least(F.dayofmonth("o_orderdate"), F.lit(30)))
    return table(spark, sf_dir, "orders").select("o_orderkey", days.cast("long").alias("days"))


@query("a33_content_fingerprint")
def a33(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem")
    return rows.agg(*[F.bit_xor(F.xxhash64(F.lit(c), c)).alias(c) for c in rows.columns], F.bit_xor(F.xxhash64(*rows.columns)).alias("whole"), F.count("*").alias("n"))
