"""Queries with the library's rule packs, over texts of the given tables with phrases that the rules are about."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..bindings import NOTE, TRADE, note, trade
from ..operators import packs, rules
from ..registry import query
from ..session import table
from ..sources import documents as docs
from ..sources.folders import shared_folder

#: Put before the notes' titles by their ids, so that each rule meets texts that it is about and others that only look so.
PHRASES = [
    "El equipo ganó la liga", "Se obliga al pago", "Gran gol de ayer", "Golpe de mercado", "Viaje a Marte de la ONU", "Nuevo martes de bolsa", "La luna sobre La Paz", "Contrabando de  arroz en la frontera",
    "Cainco y Anapo piden diésel", "Suben las reservas internacionales", "Ministro arremete contra la banca", "Hallan marihuana", "Feminicidio en la zona", "Sin nada que decir", "Expocruz, ibce y el tipo de cambio", "onu2026 en Bolivia",
]
PORTALS = ["El Deber", "Correo del Sur", "Los Tiempos"]


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sql_has(text: str, entry: dict) -> str:
    """SQL: whether a text has one of an entry's words; word borders as a look at the characters around, which RE2 does by classes."""
    edge_before, edge_after = r"(^|[^\pL])", r"([^\pL]|$)"
    plain = lambda t: "".join(rf"\{c}" if not (c.isalnum() or c.isspace()) else c for c in t)
    parts = [plain(t) for t in entry.get("terms", ())] + [edge_before + plain(t) + edge_after for t in entry.get("words", ())]
    parts += [plain(t) + edge_after for t in entry.get("ends", ())] + [f"(?:{p})" for p in entry.get("patterns", ())]
    return f"regexp_matches({text}, {quoted('(?i)' + '|'.join(parts))})"


EDITORIAL, INCIDENTS, FILINGS = (packs.own_pack(n) for n in ("editorial", "incidents", "filings"))


def penalised(text: str, title: str, flag: str) -> str:
    out = []
    for p in EDITORIAL["penalties"]:
        hit = flag if packs.pattern(p) is None else sql_has(title if p.get("title_only") else text, p)
        unless = f" AND NOT {sql_has(text, p['unless'])}" if "unless" in p else ""
        out.append(f"WHEN {hit}{unless} THEN {quoted(p['name'])}")
    return f"CASE {' '.join(out)} END"


FACTORS = "CASE name " + " ".join(f"WHEN {quoted(p['name'])} THEN {p['factor']}" for p in EDITORIAL["penalties"]) + " END"
SCALED = f"""WITH {NOTE}, n AS (SELECT id, [{', '.join(map(quoted, PHRASES))}][1 + id % {len(PHRASES)}] || ' ' || coalesce(title, '') AS title, body, [{', '.join(map(quoted, PORTALS))}][1 + id % 3] AS portal, id % 7 = 0 AS opinion, score10 / 101.0 :: DOUBLE AS model FROM note),
 t AS (SELECT *, lower(title || ' ' || coalesce(body, '')) AS text FROM n), p AS (SELECT *, {penalised('text', 'title', 'opinion')} AS name,
 len(list_distinct(regexp_extract_all(text, {quoted('(' + packs.pattern(EDITORIAL['institutions']) + ')')}))) AS institutions, {sql_has('text', EDITORIAL['keywords'])} AS fx FROM t),
 b AS (SELECT *, CASE WHEN institutions >= 2 THEN least(model * 1.3 :: DOUBLE, 1) ELSE model END AS b1 FROM p), c AS (SELECT *, CASE WHEN fx THEN least(b1 * 1.2 :: DOUBLE, 1) ELSE b1 END AS b2 FROM b)"""


@query("m03_editorial_pack", f"{SCALED} SELECT id, name AS penalised_by, round(CASE WHEN name IS NOT NULL THEN model * ({FACTORS}) :: DOUBLE ELSE least(b2 * CASE portal WHEN 'El Deber' THEN 1.15 WHEN 'Correo del Sur' THEN 1.1 ELSE 1.0 END :: DOUBLE, 1) END, 6) AS score FROM c")
def m03(spark, sf_dir):
    """The editorial scale of the pack on all notes."""
    scale = packs.scale(EDITORIAL)
    at = lambda values, k: F.get(F.array(*[F.lit(v) for v in values]), (F.col("id") % k).cast("int"))
    rows = note(spark, sf_dir).select("id", F.concat_ws(" ", at(PHRASES, len(PHRASES)), F.coalesce("title", F.lit(""))).alias("title"), "body", at(PORTALS, 3).alias("portal"), (F.col("id") % 7 == 0).alias("opinion"), (F.col("score10") / 101.0).alias("model"))
    rows = rows.withColumn("text", F.lower(F.concat(F.col("title"), F.lit(" "), F.coalesce("body", F.lit("")))))
    rows = rows.withColumn("penalised_by", rules.penalty(scale, F.col("text"), F.col("title"), F.col("opinion")))
    return rows.select("id", "penalised_by", F.round(rules.adjusted(scale, F.col("model"), F.col("penalised_by"), F.col("text"), F.col("portal")), 6).alias("score"))


EVENTS = ["Derrumbe", "Inundación", "Bloqueo por motivos sociales", "Ningún evento", "Rehabilitación", "Evento nuevo", "Caída de rocas", "Plataforma húmeda", "", "bloqueo"]
FOLDED = ["derrumbe", "inundacion", "bloqueo por motivos sociales", "ningun evento", "rehabilitacion", "evento nuevo", "caida de rocas", "plataforma humeda", "", "bloqueo"]
OF = {name: group for group, names in INCIDENTS["categories"].items() for name in names}


@query("m17_incident_pack", "SELECT category, count(*) AS n FROM (SELECT CASE event_id % 10 " + " ".join(f"WHEN {k} THEN {quoted(OF.get(e, 'otro'))}" for k, e in enumerate(FOLDED) if e not in INCIDENTS["filtered"]) + " END AS category FROM events) GROUP BY category")
def m17(spark, sf_dir):
    """Categories of incidents by the pack; what is no incident has none."""
    from ..functions.text import fold

    name = F.get(F.array(*[F.lit(e) for e in EVENTS]), (F.col("event_id") % 10).cast("int"))
    return table(spark, sf_dir, "events").select(packs.category(INCIDENTS, fold(name)).alias("category")).groupBy("category").agg(F.count("*").alias("n"))


FILED = ["Pago del cupón N° 3 y dividendos", "Designó a un gerente a.i.", "Designa auditor", "Junta General sobre emisión de bonos, capital de operaciones y dividendos", "Nada que informar", "Desembolso del préstamo de dinero", "Patrimonio autónomo"]
SECTIONS = ["Hechos Relevantes", "Resoluciones Administrativas", "Cartas de Autorización"]


@query("m13_filing_tags_pack", f"WITH t AS (SELECT doc_id, [{', '.join(map(quoted, FILED))}][1 + doc_id % {len(FILED)}] || ' ' || coalesce(text, '') AS text, [{', '.join(map(quoted, SECTIONS))}][1 + doc_id % 3] AS section FROM documents), f AS (SELECT *, list_filter([" + ", ".join(f"CASE WHEN {sql_has('text', t)} THEN {quoted(t['name'])} END" for t in FILINGS["tags"]) + "], lambda x: x IS NOT NULL)[1:3] AS found FROM t) SELECT doc_id, array_to_string(CASE WHEN starts_with(section, 'Resoluciones Administrativas') THEN list_append(found, 'resolucion') WHEN starts_with(section, 'Cartas') THEN list_append(found, 'tramite') ELSE found END, ',') AS tags FROM f")
def m13(spark, sf_dir):
    """Tags of filings by the pack, on texts that begin with a filing's phrase."""
    found, sections, most = packs.tag_rules(FILINGS)
    at = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values)).cast("int"))
    text = F.concat(at(FILED), F.lit(" "), F.coalesce("text", F.lit("")))
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(rules.tags(text, at(SECTIONS), found, sections, most), ",").alias("tags"))


@query("s13_export_files", f"WITH {TRADE} SELECT CAST(substr(month, 1, 4) AS INTEGER) AS year, country, code, CAST(sum(fob) AS BIGINT) AS fob, CAST(sum(kg) AS BIGINT) AS kg FROM trade GROUP BY ALL")
def s13(spark, sf_dir):
    """A folder of Latin-1 export files for each year: 1995's has no header, and odd years write whole numbers with a decimal."""
    root = shared_folder(spark, "exports")
    rows = trade(spark, sf_dir).withColumn("year", F.substring("month", 1, 4).cast("int"))
    odd = F.col("year") % 2 == 1
    number = lambda c: F.concat(F.col(c).cast("string"), F.when(odd, ".0").otherwise(""))
    lines = rows.select("year", number("year").alias("GESTION"), F.substring("month", 6, 2).alias("MES"), F.concat(F.col("code").cast("long").cast("string"), F.when(odd, ".0").otherwise("")).alias("NANDINA"), F.concat(F.lit(" Año "), "country").alias("des_Pais"), number("fob").alias("FOB"), number("kg").alias("KG"))
    for where, header in (("year <> 1995", True), ("year = 1995", False)):
        lines.where(where).write.mode("append").option("sep", "|").option("encoding", "ISO-8859-1").option("header", header).partitionBy("year").csv(root)
    found = docs.export_rows(spark, root, 6)
    made = found.select(docs.whole("c0").cast("int").alias("year"), F.replace(F.trim("c3"), F.lit("AÑO "), F.lit("")).alias("country"), docs.code("c2").alias("code"), docs.whole("c4").alias("fob"), docs.whole("c5").alias("kg"))
    return made.groupBy("year", "country", "code").agg(F.sum("fob").alias("fob"), F.sum("kg").alias("kg"))
