"""Queries on text and value functions, HTML sources and workbook grids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import NOTE, note
from ..functions import text as fn
from ..functions import values as val
from ..operators import facts
from ..registry import query
from ..session import table
from ..sources import documents as docs
from .notes import FOLD

PAIRS = [("th", "7h"), ("7he", "THE"), ("er", "3r"), ("qu", "kw")]


@query("f04_replaced_pairs", f"WITH {NOTE} SELECT id, replace(replace(replace(replace(title, 'th', '7h'), '7he', 'THE'), 'er', '3r'), 'qu', 'kw') AS title FROM note")
def f04(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.replaced(F.col("title"), PAIRS).alias("title"))


@query("f05_word_and_prefix", f"WITH {NOTE}, f AS (SELECT id, {FOLD.format('title')} AS t FROM note) SELECT id, regexp_matches(t, '(^|[^0-9a-z])the([^0-9a-z]|$)') AS word, regexp_matches(t, '(^|[^0-9a-z])ing') AS prefix FROM f")
def f05(spark, sf_dir):
    t = fn.fold(F.col("title"))
    return note(spark, sf_dir).select("id", fn.has_word(t, "the").alias("word"), fn.has_prefix(t, "ing").alias("prefix"))


@query("f06_spanish_word", f"WITH {NOTE} SELECT id, regexp_matches(title, '(?i)(^|[^{fn.LETTERS}])la([^{fn.LETTERS}]|$)') AS found FROM note")
def f06(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.has_spanish_word(F.col("title"), "la").alias("found"))


@query("f10_sentences")
def f10(spark, sf_dir):
    parts = fn.sentences(F.col("body"))
    return note(spark, sf_dir).select("id", F.size(parts).alias("n"), F.md5(F.array_join(parts, "\n")).alias("parts_md5"))


@query("f11_summary")
def f11(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.summary(F.col("body")).alias("summary"))


@query("f12_page_image")
def f12(spark, sf_dir):
    """Every second page is given a picture's tag in the place of its style."""
    tag = F.when(F.col("page_id") % 2 == 0, '<meta name="twitter:image" content="//img.example.org/t.png"><meta content=" /p/a.png " property="og:image">').otherwise("")
    html = F.concat(tag, "html")
    return table(spark, sf_dir, "pages").select("page_id", fn.page_image(html, F.col("url")).alias("image"))


FORMS = "CASE o_orderkey % 5 WHEN 0 THEN strftime(d, '%Y-%m-%d') WHEN 1 THEN strftime(d, '%d/%m/%Y') WHEN 2 THEN day(d) || ' de ' || list_extract(['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre','octubre','noviembre','diciembre'], month(d)) || ' de ' || year(d) WHEN 3 THEN day(d) || '-' || list_extract(['ene','feb','mar','abr','may','jun','jul','ago','sep','oct','nov','dic'], month(d)) || '-' || year(d) ELSE 'no date' END"


@query("f13_any_date", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 <> 4 THEN CAST(o_orderdate AS DATE) END AS fecha FROM orders")
def f13(spark, sf_dir):
    d = F.col("o_orderdate")
    names = lambda words: F.element_at(F.array(*[F.lit(w) for w in words]), F.month(d))
    k = F.col("o_orderkey") % 5
    text = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "dd/MM/yyyy")).when(k == 2, F.concat_ws(" de ", F.dayofmonth(d), names(fn.MONTHS), F.year(d)))
    text = text.when(k == 3, F.concat_ws("-", F.dayofmonth(d), names(fn.SHORT_MONTHS), F.year(d))).otherwise("no date")
    return table(spark, sf_dir, "orders").select("o_orderkey", fn.any_date(F.concat(F.lit("Al "), text, F.lit(" .")), 1900).alias("fecha"))


@query("f16_period_labels", "SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(year(o_orderdate) AS VARCHAR) WHEN 1 THEN year(o_orderdate) || '-Q' || quarter(o_orderdate) END AS periodo, o_orderkey % 3 = 0 AND o_orderkey % 2 = 0 AS preliminary FROM orders")
def f16(spark, sf_dir):
    k, y = F.col("o_orderkey"), F.year("o_orderdate").cast("string")
    roman = F.element_at(F.array(*[F.lit(q) for q in ("I", "II", "III", "IV")]), F.quarter("o_orderdate"))
    label = F.when(k % 3 == 0, F.concat(y, F.when(k % 2 == 0, " (p)").otherwise(""))).when(k % 3 == 1, F.concat(roman, F.lit(" Trimestre"))).otherwise("TOTAL")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", label.alias("label"), F.year("o_orderdate").alias("year"))
    return rows.select("o_orderkey", fn.period_of_label(F.col("label"), F.col("year")).alias("periodo"), fn.is_preliminary(F.col("label")).alias("preliminary"))


@query("f18_epoch_of_url", "SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN make_timestamp((epoch_us(ts) // 1000000) * 1000000) END AS published FROM events")
def f18(spark, sf_dir):
    seconds = F.expr("unix_micros(CAST(ts AS TIMESTAMP)) DIV 1000000")
    url = F.concat(F.lit("https://a.example.org/x_"), seconds, F.when(F.col("event_id") % 3 == 0, "/2").otherwise(""))
    return table(spark, sf_dir, "events").select("event_id", fn.epoch_of_url(url).cast("timestamp_ntz").alias("published"))


PUBLISHERS = ["src1", "src2", "El Diario"]
ALIASES = {"thething": ["the thing", "the th"], "ofthe": ["of the"]}


@query("f19_dedupe_key", f"WITH {NOTE}, c AS (SELECT id, trim(regexp_replace(regexp_replace(title || ' - El Diario | ' || portal, '(?i)\\s*[-–—|]\\s*(src1|src2|El Diario)\\s*$', ''), '(?i)\\s*[-–—|]\\s*(src1|src2|El Diario)\\s*$', '')) AS t FROM note) SELECT id, t AS title_key FROM c")
def f19(spark, sf_dir):
    title = F.concat("title", F.lit(" - El Diario | "), "portal")
    return note(spark, sf_dir).select("id", fn.without_publisher(title, PUBLISHERS).alias("title_key"))


@query("f19_folded_aliases")
def f19b(spark, sf_dir):
    return note(spark, sf_dir).select("id", fn.dedupe_key(F.col("title"), PUBLISHERS, ALIASES).alias("title_key"))


@query("f22_formats", """SELECT o_orderkey, CASE WHEN abs(d) < 0.005 THEN '=0.00 BOB' WHEN d > 0 THEN '+' || printf('%.2f', d) || ' BOB' ELSE '-' || printf('%.2f', -d) || ' BOB' END AS delta, CASE WHEN n >= 1000000 THEN 'Bs ' || replace(printf('%.1f', n / 1000000.0), '.', ',') || ' M' WHEN n >= 1000 THEN 'Bs ' || printf('%.0f', n / 1000.0) || ' mil' ELSE 'Bs ' || CAST(n AS VARCHAR) END AS short, format('{:,}', n) AS visits,
 CASE WHEN d > 0 THEN '+' ELSE '' END || replace(printf('%.2f', d), '.', ',') || '%' AS pct FROM (SELECT o_orderkey, (o_custkey % 41 - 20) / 4.0 :: DOUBLE AS d, o_orderkey * 37 AS n FROM orders)""")
def f22(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", ((F.col("o_custkey") % 41 - 20) / 4).alias("d"), (F.col("o_orderkey") * 37).alias("n"))
    return rows.select("o_orderkey", val.delta_text(F.col("d"), F.lit(0.0)).alias("delta"), val.short_amount(F.col("n")).alias("short"), val.visits_text(F.col("n")).alias("visits"), val.percent_text(F.col("d")).alias("pct"))


@query("f24_units", "SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN round(p_retailprice * 0.02, 2) WHEN 'ECONOMY' THEN round(p_retailprice * 0.5, 2) ELSE round(p_retailprice, 2) END AS price, CASE p_type WHEN 'PROMO' THEN 'kg' WHEN 'ECONOMY' THEN 'kg' ELSE 'unit' END AS price_unit FROM part")
def f24(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    kinds = parts.select(F.col("p_type").alias("unit")).distinct()
    mass = F.col("unit").isin("PROMO", "ECONOMY")
    units = kinds.select("unit", F.when(~mass, "unit").alias("own_unit"), F.when(mass, 0.001).alias("lo"), F.when(mass, 1.0).alias("hi"))
    rows = parts.select("p_partkey", "p_type", "p_retailprice", F.when(F.col("p_type") == "PROMO", 0.02).when(F.col("p_type") == "ECONOMY", 0.5).alias("factor"))
    return val.normalised_units(rows, units, "p_type", "p_retailprice", "factor").select("p_partkey", "price", "price_unit")


@query("f30_names", "SELECT c_custkey, array_to_string(list_filter(['Ana Rojas', 'Luz ' || upper(substr(c_mktsegment, 1, 1)) || lower(substr(c_mktsegment, 2)), CASE WHEN c_custkey % 2 = 0 THEN 'Eva de Paz' ELSE 'solo' END], lambda x: x <> 'solo'), ';') AS names FROM customer")
def f30(spark, sf_dir):
    text = F.concat(F.lit(" Ana  Rojas, Luz "), F.initcap("c_mktsegment"), F.when(F.col("c_custkey") % 2 == 0, " y Eva de Paz.").otherwise(", solo;"))
    return table(spark, sf_dir, "customer").select("c_custkey", F.array_join(fn.names(text), ";").alias("names"))


@query("f31_ring_lines", "SELECT 'S' || s_suppkey AS name, [s_suppkey :: DOUBLE, s_suppkey + 1.0 :: DOUBLE, NULL, s_nationkey :: DOUBLE] AS lon, [0.0 :: DOUBLE, 1.0 :: DOUBLE, NULL, 2.0 :: DOUBLE] AS lat FROM supplier")
def f31(spark, sf_dir):
    p = lambda x, y: F.array(x.cast("double"), F.lit(y))
    rings = F.array(F.array(p(F.col("s_suppkey"), 0.0), p(F.col("s_suppkey") + 1, 1.0)), F.array(p(F.col("s_nationkey"), 2.0)))
    return val.ring_lines(table(spark, sf_dir, "supplier").select(F.concat(F.lit("S"), "s_suppkey").alias("name"), rings.alias("rings")))


CLASSES = {"indices": ["BRAND#11", "BRAND#12"], "forex": ["BRAND#13"]}
NAMES = {"BRAND#13": "Thirteen", "BRAND#21": "Twenty-one"}


@query("f32_symbols", "SELECT p_partkey, CASE WHEN upper(p_brand) IN ('BRAND#11', 'BRAND#12') THEN 'indices' WHEN upper(p_brand) = 'BRAND#13' THEN 'forex' WHEN p_size % 2 = 0 THEN 'crypto' ELSE 'stocks' END AS class, CASE upper(p_brand) WHEN 'BRAND#13' THEN 'Thirteen' WHEN 'BRAND#21' THEN 'Twenty-one' ELSE p_brand || '-x' END AS name FROM part")
def f32(spark, sf_dir):
    venue = F.when(F.col("p_size") % 2 == 1, "xyz")
    return table(spark, sf_dir, "part").select("p_partkey", val.symbol_class(F.col("p_brand"), venue, CLASSES).alias("class"), val.display_name(F.concat("p_brand", F.lit("-x")), NAMES).alias("name"))


BERLIN = "o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))"
SUNDAY = "make_timestamp(year({t}), {m}, 31, 0, 0, 0) - to_days(CAST(dayofweek(make_date(year({t}), {m}, 31)) AS INTEGER))"


@query("f34_zoned_time", f"WITH r AS (SELECT o_orderkey, {BERLIN} + to_days(3653) AS t FROM orders) SELECT o_orderkey, t - CASE WHEN t >= {SUNDAY.format(t='t', m=3)} + to_hours(3) AND t < {SUNDAY.format(t='t', m=10)} + to_hours(2) THEN to_hours(2) ELSE to_hours(1) END AS utc FROM r WHERE NOT (t >= {SUNDAY.format(t='t', m=10)} + to_hours(2) AND t < {SUNDAY.format(t='t', m=10)} + to_hours(3)) AND NOT (t >= {SUNDAY.format(t='t', m=3)} + to_hours(2) AND t < {SUNDAY.format(t='t', m=3)} + to_hours(3))")
def f34(spark, sf_dir):
    """The clock on the order's day ten years later; the hours that the change of clocks skips or repeats have no one answer and are
    left out."""
    local = F.expr("o_orderdate + make_dt_interval(3653, CAST(o_orderkey % 24 AS INT))")
    rows = table(spark, sf_dir, "orders").select("o_orderkey", local.alias("t"))
    last = lambda m: F.date_sub(F.make_date(F.year("t"), F.lit(m), F.lit(31)), F.dayofweek(F.make_date(F.year("t"), F.lit(m), F.lit(31))) - 1)
    turn = (F.to_date("t") == last(3)) | (F.to_date("t") == last(10))
    sure = rows.where(~(turn & (F.hour("t") == 2)))
    return sure.select("o_orderkey", val.zoned_time(F.date_format("t", "dd/MM/yy HH:mm:ss")).cast("timestamp_ntz").alias("utc"))


# ---- HTML sources: rows are written into the page from its own id ----


def tables_of(spark, sf_dir):
    """pages with an HTML table of two dated rates and a transposed one, built from the page's id."""
    k = F.col("page_id")
    number = lambda x: F.concat((x % 30).cast("string"), F.lit(","), F.lpad((x % 100).cast("string"), 2, "0"))
    row_wise = F.concat(F.lit("<table><tr><th>Fecha</th><th>TC</th></tr><tr><td>"), F.lit("26/06/2026"), F.lit("</td><td> "), number(k), F.lit("</td></tr><tr><td>27 de junio de 2026</td><td>"), F.when(k % 3 == 0, "—").otherwise(number(k + 7)), F.lit("</td></tr></table>"))
    across = F.concat(F.lit("<table><tr><th>Banco</th><th>30-dic</th><th>2-ene</th></tr><tr><td>A</td><td>1,00</td><td>1,00</td></tr><tr><td>Promedio ponderado</td><td>"), number(k), F.lit("</td><td>"), number(k + 3), F.lit("</td></tr></table>"))
    return table(spark, sf_dir, "pages").select("page_id", "url", "html", row_wise.alias("row_wise"), across.alias("across"))


NUMBER = "CAST(({x}) % 30 AS DOUBLE) + (({x}) % 100) / 100.0 :: DOUBLE"


@query("s21_html_tables", f"SELECT page_id, DATE '2026-06-26' AS fecha, round({NUMBER.format(x='page_id')}, 2) AS value FROM pages UNION ALL SELECT page_id, DATE '2026-06-27', round({NUMBER.format(x='page_id + 7')}, 2) FROM pages WHERE page_id % 3 <> 0")
def s21(spark, sf_dir):
    rows = docs.html_rows(tables_of(spark, sf_dir), html="row_wise")
    return docs.dated_values(rows).withColumn("value", F.round("value", 2))


@query("s21_transposed_tables", f"SELECT page_id, DATE '2025-12-30' AS fecha, round({NUMBER.format(x='page_id')}, 2) AS value FROM pages UNION ALL SELECT page_id, DATE '2026-01-02', round({NUMBER.format(x='page_id + 3')}, 2) FROM pages")
def s21b(spark, sf_dir):
    rows = docs.html_rows(tables_of(spark, sf_dir), html="across")
    return docs.transposed_values(rows, "promedio").withColumn("value", F.round("value", 2))


@query("s23_card_pairs", "SELECT page_id, DATE '2026-06-29' AS fecha, round(9 + (page_id % 90) / 100.0 :: DOUBLE, 2) AS value FROM pages UNION ALL SELECT page_id, DATE '2026-06-30', round(10 + (page_id % 90) / 100.0 :: DOUBLE, 2) FROM pages WHERE page_id % 2 = 0")
def s23(spark, sf_dir):
    cents = F.lpad((F.col("page_id") % 90).cast("string"), 2, "0")
    two = F.col("page_id") % 2 == 0
    card = F.concat(F.lit('<article><p>29 de Junio, 2026</p><b class="tc-num">9,'), cents, F.lit("</b>"), F.when(two, '<time datetime="2026-06-30">x</time>').otherwise(""), F.lit('<b class="tc-num"> 10,'), cents, F.lit(" </b></article>"))
    return table(spark, sf_dir, "pages").select("page_id", F.inline(docs.card_pairs(card, "tc-num"))).withColumn("value", F.round("value", 2))


@query("s22_heading_links")
def s22(spark, sf_dir):
    """Links of the page's navigation, put into headings."""
    html = F.regexp_replace(F.regexp_replace("html", "<li>", "<h2>"), "</li>", "</h2>")
    return docs.heading_links(table(spark, sf_dir, "pages").withColumn("html", html), least=4)


# ---- Grids: sheets of a year's months, from the orders ----


def grid(spark, sf_dir):
    """One sheet for each customer: months down, a total row, a footer; number is the order value in the month."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.month("o_orderdate").alias("row"), F.round(F.col("o_totalprice") * 100).cast("long").alias("c"))
    sums = orders.groupBy("sheet", "row").agg(F.sum("c").alias("number"))
    names = F.element_at(F.array(*[F.lit(m.upper()) for m in fn.MONTHS]), F.col("row"))
    months = sums.select("sheet", "row", F.lit(0).alias("col"), names.alias("text"), F.lit(None).cast("long").alias("number")).union(sums.select("sheet", "row", F.lit(1), F.lit(None).cast("string"), "number"))
    sheets = sums.groupBy("sheet").agg(F.sum("number").alias("number"))
    more = [(13, "PROM. ANUAL", True), (14, "Fuente: INE", False), (15, "ENERO", True)]
    for row, text, valued in more:
        months = months.union(sheets.select("sheet", F.lit(row), F.lit(0), F.lit(text), F.lit(None).cast("long")))
        if valued:
            months = months.union(sheets.select("sheet", F.lit(row), F.lit(1), F.lit(None).cast("string"), "number"))
    return months


@query("p09_month_rows", "SELECT o_custkey AS sheet, CAST(month(o_orderdate) AS INTEGER) AS month, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS number FROM orders GROUP BY ALL")
def p09(spark, sf_dir):
    return docs.month_rows(grid(spark, sf_dir)).where("col = 1").select("sheet", "month", "number")


def year_sheets(spark, sf_dir):
    """One sheet for each customer: each year and its quarters down, in order."""
    days = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.year("o_orderdate").alias("y"), F.quarter("o_orderdate").alias("q")).distinct()
    roman = F.concat(F.element_at(F.array(*[F.lit(q) for q in ("I", "II", "III", "IV")]), F.col("q")), F.lit(" Trimestre"))
    years = days.select("sheet", (F.col("y") * 10).alias("row"), F.concat(F.col("y"), F.when(F.col("y") % 2 == 0, "(p)").otherwise("")).alias("text")).distinct()
    cells = years.union(days.select("sheet", F.col("y") * 10 + F.col("q"), roman)).union(days.select("sheet", F.lit(99990), F.lit("Fuente: x")).distinct())
    return cells.select("sheet", "row", F.lit(0).alias("col"), "text")


@query("w12_carried_years", "WITH d AS (SELECT DISTINCT o_custkey AS sheet, year(o_orderdate) AS y, quarter(o_orderdate) AS q FROM orders) SELECT sheet, CAST(y AS VARCHAR) AS periodo, y % 2 = 0 AS preliminary FROM (SELECT DISTINCT sheet, y FROM d) UNION ALL SELECT sheet, y || '-Q' || q, y % 2 = 0 FROM d")
def w12(spark, sf_dir):
    return docs.year_rows(year_sheets(spark, sf_dir)).select("sheet", "periodo", "preliminary")


@query("p15_two_band_header", "WITH d AS (SELECT DISTINCT o_custkey AS sheet, strftime(o_orderdate, '%Y-%m') AS periodo FROM orders) SELECT * FROM d")
def p15(spark, sf_dir):
    months = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).distinct()
    name = F.element_at(F.array(*[F.lit(m.capitalize()) for m in fn.MONTHS]), F.col("m"))
    below = months.select("sheet", F.lit(6).alias("row"), (F.col("y") * 20 + F.col("m")).alias("col"), name.alias("text"))
    # a year stands over its first month only
    above = months.groupBy("sheet", "y").agg(F.min("m").alias("m")).select("sheet", F.lit(5), F.col("y") * 20 + F.col("m"), F.col("y").cast("string"))
    return docs.two_band_periods(below.union(above), 5, 6).select("sheet", "periodo")


@query("w13_joined_labels", "WITH c AS (SELECT conv_id, turn, role, max(length(text)) AS n FROM conversations GROUP BY ALL), o AS (SELECT conv_id, turn, role || turn AS label, n % 3 <> 0 AS valued FROM c QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role) = 1), l AS (SELECT *, lag(label) OVER w AS bl, lag(valued) OVER w AS bv FROM o WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) SELECT conv_id AS sheet, CAST(turn AS INTEGER) AS row, CASE WHEN bv = false THEN bl || ' ' || label ELSE label END AS label FROM l WHERE valued")
def w13(spark, sf_dir):
    from ..sources.tables import latest

    each = table(spark, sf_dir, "conversations").groupBy("conv_id", "turn", "role").agg(F.max(F.length("text")).alias("n"))
    one = latest(each, ["conv_id", "turn"], [F.asc("role")])
    rows = one.select(F.col("conv_id").alias("sheet"), F.col("turn").cast("int").alias("row"), F.concat("role", F.col("turn").cast("string")).alias("label"), (F.col("n") % 3 != 0).alias("valued"))
    return docs.joined_labels(rows)


@query("p16_placeholder_rows", "SELECT o_custkey AS sheet, CAST(strftime(o_orderdate, '%Y-%m') AS VARCHAR) AS periodo, count(*) AS n, count(CASE WHEN o_orderkey % 4 <> 0 THEN 1 END) AS n_valued FROM orders GROUP BY ALL")
def p16(spark, sf_dir):
    """Rows without a value stand for periods that exist; reading drops them."""
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("sheet"), F.date_format("o_orderdate", "yyyy-MM").alias("periodo"), F.when(F.col("o_orderkey") % 4 != 0, F.col("o_totalprice")).alias("valor"))
    every = rows.groupBy("sheet", "periodo").agg(F.count("*").alias("n"))
    read = rows.where("valor IS NOT NULL").groupBy("sheet", "periodo").agg(F.count("*").alias("n_valued"))
    return every.join(read, ["sheet", "periodo"], "left").select("sheet", "periodo", "n", F.coalesce("n_valued", F.lit(0)).alias("n_valued"))


@query("a26_index_weights", "SELECT unnest(['automobile', 'building', 'furniture', 'household', 'machinery']) AS part, unnest([0.1, 0.2, 0.3, 0.15, 0.25] :: DOUBLE[]) AS weight")
def a26(spark, sf_dir):
    from ..bindings import macro
    from .facts import SLUGS

    wide = facts.dense(macro(spark, sf_dir).withColumn("valor", F.col("valor") / 1_000_000), SLUGS)
    total = sum((F.col(s) * w for s, w in zip(SLUGS, (0.1, 0.2, 0.3, 0.15, 0.25), strict=True)), F.lit(0.0))
    return facts.index_weights(wide.withColumn("total", total), SLUGS, "total").withColumn("weight", F.round("weight", 6))


OPEN = """r AS (SELECT CAST(o_orderdate AS DATE) AS fecha, o_orderdate AS ts, o_custkey AS id FROM orders), p AS (SELECT c_custkey AS id, -10 - (c_custkey % 40) / 10.0 :: DOUBLE AS lat, -60 - c_nationkey / 10.0 :: DOUBLE AS lon, 'T' || c_custkey % 7 AS section FROM customer)"""


def incidents(spark, sf_dir):
    """readings (fecha, ts, open), places and sections: an order opens its customer's incident for the day."""
    orders = table(spark, sf_dir, "orders").select(F.to_date("o_orderdate").alias("fecha"), F.col("o_custkey").alias("id"))
    readings = orders.groupBy("fecha").agg(F.collect_set("id").alias("open")).withColumn("ts", F.col("fecha"))  # the day's open incidents, one reading
    places = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), (F.lit(-10) - (F.col("c_custkey") % 40) / 10).alias("lat"), (F.lit(-60) - F.col("c_nationkey") / 10).alias("lon"), F.concat(F.lit("T"), F.col("c_custkey") % 7).alias("section"))
    sections = places.groupBy("lat", "lon").agg(F.min("section").alias("section"))
    return readings, places.drop("section"), sections


@query("a17_open_days", f"WITH {OPEN}, s AS (SELECT lat, lon, min(section) AS section FROM p GROUP BY ALL), x AS (SELECT DISTINCT fecha, r.id, round(p.lat, 0) AS clat, round(p.lon, 0) AS clon, s.section FROM r JOIN p USING (id) JOIN s ON s.lat = p.lat AND s.lon = p.lon), v AS (SELECT clat, clon, section, count(*) AS n FROM x GROUP BY ALL) SELECT clat AS lat, clon AS lon, count(DISTINCT fecha) AS days, (SELECT arg_min(section, (-n, section)) FROM v WHERE v.clat = x.clat AND v.clon = x.clon) AS section FROM x GROUP BY clat, clon")
def a17(spark, sf_dir):
    return facts.open_days(*incidents(spark, sf_dir), decimals=0)


@query("j15_located_incidents", f"WITH {OPEN}, s AS (SELECT lat, lon, min(section) AS section FROM p GROUP BY ALL) SELECT DISTINCT p.id, p.lat, p.lon, s.section FROM r JOIN p USING (id) JOIN s ON s.lat = p.lat AND s.lon = p.lon WHERE fecha = (SELECT max(fecha) FROM r)")
def j15(spark, sf_dir):
    return facts.located(*incidents(spark, sf_dir))


@query("p06_merchant_tiers", "WITH s AS (SELECT o_custkey, count(*) AS orders, avg(CASE WHEN o_orderstatus = 'F' THEN 1.0 ELSE 0.0 END) AS completed, CAST(sum(round(o_totalprice * 100)) AS BIGINT) AS size FROM orders GROUP BY 1) SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' AND coalesce(orders, 0) >= 12 AND coalesce(completed, 0) >= 0.3 AND coalesce(size, 0) >= 10000000 THEN 'A' WHEN c_mktsegment <> 'BUILDING' OR coalesce(orders, 0) >= 14 THEN 'B' ELSE 'C' END AS tier FROM customer LEFT JOIN s ON o_custkey = c_custkey")
def p06(spark, sf_dir):
    sums = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("orders"), F.avg(F.when(F.col("o_orderstatus") == "F", 1.0).otherwise(0.0)).alias("completed"), F.sum(F.round(F.col("o_totalprice") * 100).cast("long")).alias("size"))
    rows = table(spark, sf_dir, "customer").join(sums, "c_custkey", "left").withColumn("merchant", (F.col("c_mktsegment") != "BUILDING").cast("int"))
    return rows.select("c_custkey", facts.tiers(12, 0.3, 10_000_000, 14).alias("tier"))
