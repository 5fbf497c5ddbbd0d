"""Text and value functions on constructed cases."""

import datetime

from pyspark.sql import functions as F

from marketlake.functions import text as fn
from marketlake.functions import values as val


def each(spark, f, *values):
    rows = [(k, *(v if isinstance(v, tuple) else (v,))) for k, v in enumerate(values)]
    names = ["k", *"abc"[: len(rows[0]) - 1]]
    df = spark.createDataFrame(rows, ", ".join(f"{n} {'int' if n == 'k' else 'string'}" for n in names))
    return [r[0] for r in df.orderBy("k").select(f(*[F.col(n) for n in names[1:]])).collect()]


def test_sentences_keep_abbreviations_and_initials(spark):
    got = each(spark, fn.sentences, "El BCB subió. La tasa bajó a Bs. 40, etc. El dato! ¿Qué? Sí.", "El Dr. J. Paz habló (art. 5). Luego calló.", "", None, "sin punto. minúscula sigue")
    assert got == [["El BCB subió.", "La tasa bajó a Bs. 40, etc. El dato!", "¿Qué?", "Sí."], ["El Dr. J. Paz habló (art. 5).", "Luego calló."], [], [], ["sin punto. minúscula sigue"]]


def test_summary(spark):
    long = "Uno dos tres. " + "Cuatro cinco seis siete ocho nueve. " + "Diez once."
    got = each(spark, lambda t: fn.summary(t, 40), "corto", long, "palabra " * 20, None)
    assert got == ["corto", "Uno dos tres.", "palabra palabra palabra palabra palabra", None]
    assert each(spark, lambda t: fn.summary(t, 55), long) == ["Uno dos tres. Cuatro cinco seis siete ocho nueve."]


def test_cut_at_word(spark):
    assert each(spark, lambda t: fn.cut_at_word(t, 10, "…"), "abc def, ghi jkl", "a bcdefghijklmnop", "short") == ["abc def…", "a bcdefghi…", "short"]


def test_cut_leaves_a_stop_before_a_line_end(spark):
    assert each(spark, lambda t: fn.cut_at_word(t, 10, "…"), "abcd ef.\n ghijkl", "abcd ef.\n, ghijkl") == ["abcd ef.\n…", "abcd ef.\n…"]
    assert each(spark, lambda t: fn.cut_at_word(t, 10, "…"), "\u00a0abc \u3000") == ["abc"]


def test_fixed_places_equal_printf(spark):
    import random

    rng = random.Random(5)
    values = [1.25, 1.35, 5.55, 1.15, 0.05, 0.25, 0.15, 0.95, 9.96, -2.25, 0.0, -0.004, 1e-20, 0.125, 0.375, 123456.75, *(rng.randrange(10**9) * 50_000 / 1e6 for _ in range(300)), *(rng.uniform(-100, 100) for _ in range(200))]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", val.fixed(F.col("v"), 1), val.fixed(F.col("v"), 2)).collect()
    assert [tuple(r)[1:] for r in rows] == [(f"{r.v:.1f}", f"{r.v:.2f}") for r in rows]
    million = spark.createDataFrame([(5_550_000,), (9_250_000,)], "n long").select(val.short_amount(F.col("n"))).collect()
    assert [r[0] for r in million] == ["Bs 5,5 M", "Bs 9,2 M"]


def test_dates_in_every_form(spark):
    d = datetime.date(2026, 6, 26)
    got = each(spark, fn.any_date, "al 2026-06-26", "26/06/2026", "26-06-2026", "26 de Junio de 2026", "26-jun-2026", "1999-01-01", "31/02/2026", "mañana", None)
    assert got == [d] * 5 + [None] * 4


def test_urls(spark):
    got = each(spark, fn.url_key, "HTTP://A.b/C/?utm_source=x&q=1&fbclid=2#top", "http://a.b/", "http://a.b/c//", "http://a.b/c?ref=1&mc_eid=2")
    assert got == ["http://a.b/c?q=1", "http://a.b", "http://a.b/c", "http://a.b/c?ref=1"]
    got = each(spark, fn.absolute_url, ("/x", "https://h/a/b"), ("y.png", "https://h/a/b?q"), ("//c/z", "https://h/a"), ("http://o/", "https://h"), ("", "https://h"), ("p", "https://h"))
    assert got == ["https://h/x", "https://h/a/y.png", "https://c/z", "http://o/", None, "https://h/p"]
    assert each(spark, fn.epoch_of_url, "https://a/x_1700000000", "https://a/pais/2") == [datetime.datetime(2023, 11, 14, 22, 13, 20), None]


def test_page_image_order_and_layouts(spark):
    got = each(
        spark, fn.page_image, ('<meta name="twitter:image" content="/t.png"><META content=" /o.png " property="og:image">', "https://h/a"),
        ("<meta property='og:image' content=''><meta property='og:image:secure_url' content='//s/x.png'>", "https://h/a"), ("<p>none</p>", "https://h"), (None, "https://h"),
    )
    assert got == ["https://h/o.png", "https://s/x.png", None, None]


def test_dedupe_key_and_amounts(spark):
    key = lambda t: fn.dedupe_key(t, ["El Diario", "Bolivia"], {"eeuu": ["estados unidos", "estados unidos de américa"]})
    assert each(spark, key, "Acuerdo con Estados Unidos de América - El Diario - Bolivia", "Los Estados Unidos | otro") == ["Acuerdo con eeuu", "Los eeuu | otro"]
    assert each(spark, fn.amounts, "Crédito de $us 40 millones y 1.500 mil, no 7 milagros", "Un MILLÓN o 2 millón", None) == [["1500_mil", "40_millon"], ["2_millon"], None]


def test_words_and_labels(spark):
    assert each(spark, lambda t: fn.has_spanish_word(t, "marte"), "marte2026", "martes", "Marte.", "ámarte") == [True, False, True, False]
    assert each(spark, fn.names, "Ana Rojas, Luz Paz y Eva de la Cruz e Iván Díaz", "solo", "x Y") == [["Ana Rojas", "Luz Paz", "Eva de la Cruz", "Iván Díaz"], [], []]
    assert each(spark, lambda t: fn.period_of_label(t, F.lit(2024)), "2022p)", "2024 (p)", "III Trimestre", "iv trimestre", "TOTAL", None) == ["2022", "2024", "2024-Q3", "2024-Q4", None, None]
    assert each(spark, lambda t, u: fn.opinion(t, u, ["/opinion/"], [r"^\s*opini[oó]n\s*[:|-]"]), ("OPINIÓN: x", None), ("x", "http://a/OPINION/b"), ("la opinión", "http://a")) == [True, True, False]


def test_value_formats(spark):
    df = spark.createDataFrame([(25_000_000.0, 0.004), (18_500.0, -1.236), (12.5, None), (7.0, 0.5)], "v double, d double")
    rows = df.select(val.short_amount(F.col("v")), val.delta_text(F.col("d"), F.lit(0.0)), val.volume_text(F.col("v") * 1000), val.percent_text(F.col("d"))).collect()
    assert [tuple(r) for r in rows] == [("Bs 25,0 M", "=0.00 BOB", "US$ 25,0 B", "+0,00%"), ("Bs 18 mil", "-1.24 BOB", "US$ 19 M", "-1,24%"), ("Bs 12,50", "—", "US$ 13 K", "—"), ("Bs 7", "+0.50 BOB", "US$ 7 K", "+0,50%")]


def test_units_guard(spark):
    import pytest

    units = spark.createDataFrame([("lb", None, 2.0, 2.5), ("head", "head", None, None)], "unit string, own_unit string, lo double, hi double")
    rows = spark.createDataFrame([("lb", 3.0, 2.2), ("head", 50.0, None)], "u string, price_in double, f double")
    assert [tuple(r) for r in val.normalised_units(rows, units, "u", "price_in", "f").select("price", "price_unit").collect()] == [(6.6, "kg"), (50.0, "head")]
    with pytest.raises(Exception, match="no good factor"):
        val.normalised_units(spark.createDataFrame([("lb", 3.0, 22.0)], rows.schema), units, "u", "price_in", "f").collect()
