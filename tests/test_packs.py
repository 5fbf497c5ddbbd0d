"""Rule packs: the library's own on cases, and those that a user loads."""

import json

import pytest
from pyspark.sql import functions as F

from marketlake.operators import packs, rules

CASES = [
    ("El equipo ganó la liga", "", False, "deportes", 0.15), ("Se obliga al pago", "", False, None, 0.5), ("Gran GOL", "", False, "deportes", 0.15), ("Golpe de mercado", "", False, None, 0.5),
    ("Viaje a Marte", "", False, "intl", 0.25), ("El martes", "", False, None, 0.5), ("La luna", "sobre La Paz", False, None, 0.5), ("La onu", "", True, "intl", 0.25), ("onu2026", "", False, "intl", 0.25),
    ("Todos", "arremete contra la banca", False, None, 0.5), ("Arremete contra", "", False, "chisme", 0.15), ("contrabando de  arroz", "", False, "contrabando_alim", 0.25), ("contrabando de oro", "", False, None, 0.5),
    ("Columna", "", True, "opinion", 0.35), ("Feminicidio y marihuana", "", True, "crimen", 0.15), ("Cainco y Anapo", "", False, None, 0.65), ("cainco, CAINCO", "", False, None, 0.5), ("Cainco, ibce y el tipo de cambio", "", False, None, 0.78),
]


def test_the_editorial_scale_on_its_cases(spark):
    rows = spark.createDataFrame([(k, t, b, o) for k, (t, b, o, _, _) in enumerate(CASES)], "k int, title string, body string, opinion boolean")
    scale = packs.scale(packs.own_pack("editorial"))
    text = F.lower(F.concat_ws(" ", "title", "body"))
    rows = rows.withColumn("name", rules.penalty(scale, text, F.col("title"), F.col("opinion")))
    rows = rows.withColumn("score", rules.adjusted(scale, F.lit(0.5), F.col("name"), text, F.lit("Otro")))
    for r in rows.collect():
        assert (r.name, round(r.score, 6)) == CASES[r.k][3:], CASES[r.k]


def test_bonuses_are_capped_and_portals_count(spark):
    scale = packs.scale(packs.own_pack("editorial"))
    row = spark.range(1).select(rules.adjusted(scale, F.lit(0.9), F.lit(None).cast("string"), F.lit("cainco e ibce por el tipo de cambio"), F.lit("El Deber")).alias("a"), rules.adjusted(scale, F.lit(0.5), F.lit(None).cast("string"), F.lit("nada"), F.lit("La Razón")).alias("b")).first()
    assert row.a == 1.0 and abs(row.b - 0.55) < 1e-12


def test_tags_of_filings(spark):
    found, sections, most = packs.tag_rules(packs.own_pack("filings"))
    texts = ["Pago del CUPÓN 3", "Designó a un gerente a.i.", "Designa auditor", "Designado", "Junta General: emisión de bonos, capital de operaciones, dividendos", "emisión de sonido", None]
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, text string")
    tags = {r.k: r.tags for r in rows.select("k", rules.tags(F.col("text"), F.lit("Cartas de Autorización"), found, sections, most).alias("tags")).collect()}
    assert tags == {0: ["cupon", "tramite"], 1: ["personal", "tramite"], 2: ["personal", "tramite"], 3: ["tramite"], 4: ["emision", "junta", "dividendos", "tramite"], 5: ["tramite"], 6: ["tramite"]}


def test_categories_of_incidents(spark):
    pack = packs.own_pack("incidents")
    rows = spark.createDataFrame([(e,) for e in ["derrumbe", "inundacion", "ningun evento", "", "algo nuevo", "bloqueo", None]], "event string")
    assert [r.c for r in rows.select(packs.category(pack, F.col("event")).alias("c")).collect()] == ["derrumbe", "clima", None, None, "otro", "otro", None]


def test_a_users_pack_is_loaded_and_slips_are_errors(spark, tmp_path):
    own = packs.own_pack("editorial")
    own["penalties"] = [{"name": "c++", "factor": 0.1, "words": ["c++"]}]
    (tmp_path / "mine.json").write_text(json.dumps(own))
    scale = packs.scale(packs.load_pack(spark, f"file://{tmp_path}/mine.json"))
    rows = spark.createDataFrame([("about c++ today",), ("abc++",), ("c++x",)], "t string")
    assert [r.n for r in rows.select(rules.penalty(scale, F.col("t"), F.col("t"), F.lit(False)).alias("n")).collect()] == ["c++", None, None]
    with pytest.raises(ValueError, match="unknown fields: word"):
        packs.scale({"penalties": [{"name": "x", "factor": 1, "word": ["typo"]}]})
    with pytest.raises(ValueError, match="flag"):
        packs.scale({"penalties": [{"name": "x", "factor": 1}, {"name": "y", "factor": 1}]})
    with pytest.raises(ValueError, match="without words"):
        packs.tag_rules({"tags": [{"name": "x"}]})
    with pytest.raises(ValueError, match="two categories"):
        packs.category({"categories": {"a": ["x"], "b": ["x"]}}, F.lit("x"))


def test_export_files_with_and_without_header(spark, tmp_path):
    from marketlake.sources import documents as docs

    (tmp_path / "a.txt").write_bytes("GESTION|MES|NANDINA|PAIS|FOB\n2018.0|1|1201900000.0|  España |10.5\n2018|2|801210000|Perú|x\n".encode("latin-1"))
    (tmp_path / "b.txt").write_bytes("2019|3|0801210000|PERÚ|7\n2019|3|80A|PERÚ|1\n".encode("latin-1"))
    rows = docs.export_rows(spark, str(tmp_path), 5).select(docs.whole("c0").alias("y"), docs.code("c2").alias("c"), "c3", docs.whole("c4").alias("v"))
    assert sorted((r.y, r.c or "", r.c3, r.v) for r in rows.collect()) == [(2018, "0801210000", "PERÚ", 0), (2018, "1201900000", "ESPAÑA", 10), (2019, "", "PERÚ", 1), (2019, "0801210000", "PERÚ", 7)]
