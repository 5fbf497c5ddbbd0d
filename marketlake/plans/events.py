"""Queries on same-event notes and on rule tables over notes, pages and conversations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..bindings import NOTE, note
from ..functions import text as fn
from ..operators import events as ev
from ..operators import notes as op
from ..operators import rules
from ..registry import query
from ..session import table
from .notes import FOLD, KEYWORDS, WORD

HITS = "list_filter([{}], lambda x: x IS NOT NULL)".format(", ".join(f"CASE WHEN {WORD.format(FOLD.format('coalesce(title, {})'.format(chr(39) * 2)), k)} THEN '{k}' END" for k in sorted(KEYWORDS)))
AMOUNTS = "list_sort(list_distinct(list_transform(range(1, len(regexp_extract_all({t}, '{p}', 1)) + 1), lambda i: replace(replace(regexp_extract_all({t}, '{p}', 1)[i], '.', ''), ',', '') || '_' || substr(regexp_extract_all({t}, '{p}', 2)[i], 1, 6))))".replace("{p}", r"([0-9][0-9.,]*) *(mill?on(?:es)?|mil)\b")
EVENTS = NOTE + f""", toks AS (SELECT id, fecha, portal, score10, list_sort(list_distinct(list_filter(string_split_regex(lower(coalesce(title, '')), '\\s+'), lambda x: x <> ''))) AS tokens, {HITS} AS entities, {AMOUNTS.replace('{t}', FOLD.format("coalesce(title, '')"))} AS amounts FROM note)"""
SIM = "CASE WHEN len(a.tokens) > 0 AND len(b.tokens) > 0 THEN len(list_intersect(a.tokens, b.tokens)) :: DOUBLE / greatest(len(a.tokens), len(b.tokens)) ELSE 0 END"


def events(spark, sf_dir):
    rows = note(spark, sf_dir)
    hits = F.coalesce(op.keyword_hits(fn.fold(F.coalesce("title", F.lit(""))), KEYWORDS), F.array().cast("array<string>"))
    return rows.select("id", "fecha", "portal", "score10", F.col("score10").alias("score"), ev.tokens(F.col("title")).alias("tokens"), hits.alias("entities"), fn.amounts(F.coalesce("title", F.lit(""))).alias("amounts"))


@query("j10_repeated_notes", f"""WITH {EVENTS}, d AS (SELECT DISTINCT fecha, tokens, entities, amounts FROM toks), h AS (SELECT b.fecha, b.tokens, b.entities, b.amounts, {SIM} AS sim, len(list_intersect(a.entities, b.entities)) > 0 AS e, len(list_intersect(a.amounts, b.amounts)) > 0 AS m FROM d a JOIN d b ON date_diff('day', a.fecha, b.fecha) BETWEEN 1 AND 7
 AND least(len(a.tokens), len(b.tokens)) >= 0.5 * greatest(len(a.tokens), len(b.tokens))), g AS (SELECT DISTINCT fecha, tokens, entities, amounts FROM h WHERE sim >= 0.7 OR (sim >= 0.5 AND e) OR (sim >= 0.62 AND m))
SELECT id, EXISTS (SELECT 1 FROM g WHERE g.fecha = t.fecha AND g.tokens = t.tokens AND g.entities = t.entities AND g.amounts = t.amounts) AS repeated FROM toks t""")
def j10(spark, sf_dir):
    return ev.repeated(events(spark, sf_dir))


@query("m10_near_duplicate_groups")
def m10(spark, sf_dir):
    """Titles alone, over all days."""
    none = F.array().cast("array<string>")
    rows = events(spark, sf_dir).withColumns({"entities": none, "amounts": none})
    return ev.greedy_groups(rows, [], title=0.55, with_entity=0.55, with_amount=0.55)


@query("m11_same_event_groups")
def m11(spark, sf_dir):
    return ev.greedy_groups(events(spark, sf_dir), ["fecha"])


@query("u03_shared_entities", f"WITH {EVENTS}, p AS (SELECT id, entities, lag(entities) OVER (PARTITION BY portal, fecha ORDER BY id) AS before FROM toks) SELECT id, coalesce(len(list_intersect(entities, before)) > 0, false) AS shared FROM p")
def u03(spark, sf_dir):
    before = F.lag("entities").over(Window.partitionBy("portal", "fecha").orderBy("id"))
    rows = events(spark, sf_dir).select("id", "entities", before.alias("before"))
    return rows.select("id", F.coalesce(F.arrays_overlap("entities", "before"), F.lit(False)).alias("shared"))


@query("f20_amounts", f"SELECT doc_id, array_to_string({AMOUNTS.replace('{t}', FOLD.format('text'))}, ',') AS amounts FROM documents")
def f20(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(fn.amounts(F.col("text")), ",").alias("amounts"))


@query("f21_title_similarity", f"WITH {EVENTS}, p AS (SELECT id, tokens, lag(tokens) OVER (PARTITION BY portal ORDER BY id) AS before FROM toks) SELECT id, CASE WHEN len(tokens) > 0 AND len(before) > 0 THEN len(list_intersect(tokens, before)) :: DOUBLE / greatest(len(tokens), len(before)) ELSE 0 END AS similarity FROM p")
def f21(spark, sf_dir):
    before = F.lag("tokens").over(Window.partitionBy("portal").orderBy("id"))
    rows = events(spark, sf_dir).select("id", "tokens", F.coalesce(before, F.array().cast("array<string>")).alias("before"))
    return rows.select("id", ev.overlap(F.col("tokens"), F.col("before")).alias("similarity"))


SCALE = rules.Scale(
    penalties=(
        rules.Penalty("sports", 0.3, "token|golf"), rules.Penalty("crime", 0.3, "passport"), rules.Penalty("gossip", 0.3, "secret", title_only=True),
        rules.Penalty("smuggling", 0.5, "card number"), rules.Penalty("drugs", 0.5, "license"), rules.Penalty("abroad", 0.5, "phone", unless="the"), rules.Penalty("opinion", 0.7),
    ),
    institutions="bank|market|trade|river", institutions_factor=1.3, keywords="price|rate", keywords_factor=1.2, portals={"src1": 1.15, "src2": 1.10},
)
EXCLUDED, ANCHORS = ["lorem", "viagra"], ["the", "der", "les", "los"]
TOPICS = [rules.Topic("economy", ("price", "bank"), ("and", "und"), ("mar", "tra")), rules.Topic("energy", ("river", "water"), ("para", "el"), ("en",)), rules.Topic("politics", ("people", "house"), ("de", "la"), ("gov", "par"), ("token",))]


def scored(spark, sf_dir):
    """Notes with a score in place of a model's, an opinion flag by portal, and their topic."""
    rows = note(spark, sf_dir).withColumns({"model_score": F.col("score10") / 100, "opinion": F.col("portal").isin("src3")})
    rows = rows.withColumn("folded", fn.fold(F.concat_ws(" . ", "title", "body")))  # once a note, not for each word
    return rows.withColumn("t", rules.topic_of(F.col("folded"), TOPICS)).withColumns({"topic": F.col("t.topic"), "topic_hits": F.col("t.hits")}).drop("t")


def has(column: str, pattern: str) -> str:
    return f"coalesce(regexp_matches({column}, '(?i){pattern}'), false)"


def within(words) -> str:
    return "(" + " OR ".join(f"contains(txt, '{w}')" for w in words) + ")"


def word(w: str) -> str:
    return WORD.format("fold", w)


def stem(w: str) -> str:
    return f"regexp_matches(fold, '(^|[^0-9a-z]){w}')"


def hits_sql(t: rules.Topic) -> tuple[str, str]:
    strong = "(" + " + ".join(f"CAST({word(w)} AS INTEGER)" for w in t.strong) + ")"
    weak = "(" + " + ".join(f"CAST({word(w)} AS INTEGER)" for w in t.weak) + ")"
    gate = "(" + " OR ".join(stem(w) for w in t.context) + ")"
    veto = "(" + " OR ".join(f"contains(fold, '{w}')" for w in t.veto) + ")" if t.veto else "false"
    return f"CASE WHEN {veto} THEN 0 ELSE {strong} * 10 + CASE WHEN {gate} THEN {weak} ELSE 0 END END", strong


TOPIC_SQL = NOTE + f""", f AS (SELECT *, {FOLD.format("concat_ws(' . ', title, body)")} AS fold, lower(concat_ws(' ', title, body)) AS txt FROM note),
 h AS (SELECT *, """ + ", ".join(f"{hits_sql(t)[0]} AS h{k}, {hits_sql(t)[1]} AS s{k}" for k, t in enumerate(TOPICS)) + """ FROM f),
 tp AS (SELECT *, list_max([""" + ", ".join(f"{{'hits': h{k}, 'strong': s{k}, 'o': {-k}, 'topic': '{t.name}'}}" for k, t in enumerate(TOPICS)) + """]) AS best FROM h),
 sc AS (SELECT *, CASE WHEN best.hits > 0 THEN best.topic END AS topic, coalesce(best.hits, 0) AS topic_hits, score10 / 100.0 :: DOUBLE AS model_score, coalesce(portal = 'src3', false) AS opinion FROM tp)"""
GATED = TOPIC_SQL + f""", g AS (SELECT *, {within(EXCLUDED)} AS out_, {within(ANCHORS)} OR topic IS NOT NULL AS in_ FROM sc),
 pe AS (SELECT *, CASE WHEN out_ OR NOT in_ THEN NULL WHEN {has('txt', 'token|golf')} THEN 'sports' WHEN {has('txt', 'passport')} THEN 'crime' WHEN {has('title', 'secret')} THEN 'gossip' WHEN {has('txt', 'card number')} THEN 'smuggling' WHEN {has('txt', 'license')} THEN 'drugs' WHEN {has('txt', 'phone')} AND NOT {has('txt', 'the')} THEN 'abroad' WHEN opinion THEN 'opinion' END AS penalised_by FROM g),
 b1 AS (SELECT *, CASE WHEN len(list_distinct(regexp_extract_all(txt, '(bank|market|trade|river)', 1))) >= 2 THEN least(model_score * 1.3 :: DOUBLE, 1.0) ELSE model_score END AS v1 FROM pe),
 b2 AS (SELECT *, CASE WHEN {has('txt', '(price|rate)')} THEN least(v1 * 1.2 :: DOUBLE, 1.0) ELSE v1 END AS v2 FROM b1),
 b3 AS (SELECT *, CASE WHEN portal = 'src1' THEN least(v2 * 1.15 :: DOUBLE, 1.0) WHEN portal = 'src2' THEN least(v2 * 1.1 :: DOUBLE, 1.0) ELSE v2 END AS v3 FROM b2),
 ad AS (SELECT *, CASE WHEN out_ OR NOT in_ THEN NULL WHEN penalised_by IN ('sports', 'crime', 'gossip') THEN model_score * 0.3 :: DOUBLE WHEN penalised_by IN ('smuggling', 'drugs', 'abroad') THEN model_score * 0.5 :: DOUBLE WHEN penalised_by = 'opinion' THEN model_score * 0.7 :: DOUBLE ELSE v3 END AS adjusted_score FROM b3),
 di AS (SELECT *, CASE WHEN out_ THEN 'excluded word' WHEN NOT in_ THEN 'no anchor' WHEN coalesce(adjusted_score < 0.33, true) AND NOT coalesce(portal = 'src4', false) THEN 'below threshold' END AS discarded_by FROM ad)"""


@query("m03_editorial_scale", f"WITH {GATED} SELECT id, penalised_by, round(adjusted_score, 6) AS adjusted_score FROM di")
def m03(spark, sf_dir):
    rows = rules.evaluated(scored(spark, sf_dir), SCALE, EXCLUDED, ANCHORS, floor_portal="src4")
    return rows.select("id", "penalised_by", F.round("adjusted_score", 6).alias("adjusted_score"))


@query("m04_evaluation_cascade", f"WITH {GATED} SELECT id, discarded_by, CASE WHEN discarded_by IS NOT NULL THEN 0.0 :: DOUBLE WHEN portal = 'src4' THEN greatest(floor(adjusted_score * 100 + 0.5 :: DOUBLE + 1e-9 :: DOUBLE) / 10, 9.0 :: DOUBLE) ELSE floor(adjusted_score * 100 + 0.5 :: DOUBLE + 1e-9 :: DOUBLE) / 10 END AS score, 1 AS rules_version FROM di")
def m04(spark, sf_dir):
    rows = rules.evaluated(scored(spark, sf_dir), SCALE, EXCLUDED, ANCHORS, floor_portal="src4")
    return rows.select("id", "discarded_by", "score", "rules_version")


@query("m05_topic_rules", f"WITH {TOPIC_SQL} SELECT id, topic, topic_hits FROM sc")
def m05(spark, sf_dir):
    return scored(spark, sf_dir).select("id", "topic", "topic_hits")


NAMES = {"Bank": ["bank", "banks"], "River": ["river", "water"], "House": ["house", "home"], "Market": ["market", "trade"]}


@query("m06_entities", f"WITH {TOPIC_SQL} SELECT id, array_to_string(list_filter([" + ", ".join(f"CASE WHEN {' OR '.join(word(a) for a in NAMES[n])} THEN '{n}' END" for n in sorted(NAMES)) + "], lambda x: x IS NOT NULL), ',') AS entities FROM sc")
def m06(spark, sf_dir):
    text = F.concat_ws(" . ", "title", "body")
    return note(spark, sf_dir).select("id", F.array_join(rules.entities(text, NAMES), ",").alias("entities"))


@query("m08_opinion_pages", "SELECT page_id, coalesce(contains(lower(url), '/p/1'), false) OR coalesce(contains(lower(url), '/opinion/'), false) OR coalesce(regexp_matches(regexp_extract(html, '<title>([^<]*)', 1), '(?i)^\\s*(the|der|les)'), false) AS opinion FROM pages")
def m08(spark, sf_dir):
    title = F.regexp_extract("html", "<title>([^<]*)", 1)
    return table(spark, sf_dir, "pages").select("page_id", fn.opinion(title, F.col("url"), ["/p/1", "/opinion/"], [r"^\s*(the|der|les)"]).alias("opinion"))


SLUGS = [("cash", ["bank", "price"]), ("water", ["river", "water"]), ("home", ["house"])]


@query("m09_gallery_slug", f"WITH {TOPIC_SQL} SELECT id, coalesce(CASE WHEN lang = 'fr' THEN 'lane' END, CASE " + " ".join(f"WHEN {' OR '.join(word(w) for w in ws)} THEN '{s}'" for s, ws in SLUGS) + " END, CASE topic WHEN 'economy' THEN 'eco' WHEN 'politics' THEN 'pol' END) AS slug FROM sc")
def m09(spark, sf_dir):
    rows = scored(spark, sf_dir)
    by_topic = F.when(F.col("topic") == "economy", "eco").when(F.col("topic") == "politics", "pol")
    slug = rules.first_slug(F.when(F.col("lang") == "fr", "lane"), rules.keyword_slug(F.col("folded"), SLUGS), by_topic)
    return rows.select("id", slug.alias("slug"))


@query("m20_retry_decision", f"WITH {NOTE}, p AS (SELECT id, length(body) AS new_, lag(length(body)) OVER (PARTITION BY portal ORDER BY id) AS old_, row_number() OVER (PARTITION BY portal, fecha ORDER BY id) % 5 AS attempts FROM note) SELECT id, CASE WHEN attempts >= 3 THEN 'capped' WHEN coalesce(new_, 0) < 230 THEN 'short' WHEN new_ <= coalesce(old_, 0) THEN 'not longer' ELSE 'retry' END AS decision FROM p")
def m20(spark, sf_dir):
    by = Window.partitionBy("portal").orderBy("id")
    tries = F.row_number().over(Window.partitionBy("portal", "fecha").orderBy("id")) % 5
    rows = note(spark, sf_dir).select("id", F.length("body").alias("new_"), F.lag(F.length("body")).over(by).alias("old_"), tries.alias("attempts"))
    return rows.select("id", rules.retry_decision(F.col("old_"), F.col("new_"), F.col("attempts")).alias("decision"))


@query("m29_missing_pictures", f"WITH {NOTE} SELECT id FROM note WHERE fecha > DATE '2024-01-25' - 10 AND quality IS NULL")
def m29(spark, sf_dir):
    rows = note(spark, sf_dir).withColumn("image", F.col("quality").cast("string"))
    return op.without_picture(rows, "2024-01-25", 10).select("id")


@query("m30_picture_choice", f"WITH {NOTE}, c AS (SELECT id, CASE WHEN quality = 1 THEN 'own' WHEN quality = 0 THEN '' END AS own, portal = 'src2' AS bad, CASE WHEN lang = 'en' THEN 'gal' END AS gal FROM note) SELECT id, CASE WHEN own <> '' AND NOT coalesce(bad, false) THEN own ELSE coalesce(gal, 'none') END AS url, CASE WHEN own <> '' AND NOT coalesce(bad, false) THEN 'page' WHEN gal IS NOT NULL THEN 'gallery' ELSE 'placeholder' END AS kind, coalesce(own <> '' AND bad, false) AS nulled FROM c")
def m30(spark, sf_dir):
    own = F.when(F.col("quality") == 1, "own").when(F.col("quality") == 0, "")
    choice = rules.picture(own, F.col("portal") == "src2", F.when(F.col("lang") == "en", "gal"), "none")
    return note(spark, sf_dir).select("id", choice.alias("c")).select("id", "c.url", "c.kind", F.coalesce("c.nulled", F.lit(False)).alias("nulled"))


@query("w17_picture_rotation")
def w17(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", F.col("lang").alias("slug"), "fecha", F.lpad((F.col("score10") % 24).cast("string"), 2, "0").alias("hora"))
    return op.rotated_pictures(rows, {"en": 5, "fr": 3, "de": 4, "es": 0})


@query("t07_portal_order", f"WITH {NOTE} SELECT id, CASE portal WHEN 'src2' THEN 1 WHEN 'src0' THEN 2 ELSE 3 END AS portal_place FROM note")
def t07(spark, sf_dir):
    return op.portal_order(note(spark, sf_dir), ["src2", "src0"]).select("id", "portal_place")


@query("m12_note_rows")
def m12(spark, sf_dir):
    rows = note(spark, sf_dir)
    seen = F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") * 977).cast("timestamp_ntz")
    made = rows.select(F.concat(F.lit("https://"), F.col("portal"), F.lit(".example.org/n/"), F.col("id")).alias("url"), seen.alias("published"), "portal", F.col("lang").alias("topic"), "title", "body", "score10")
    return op.note_rows(made, {"en": "world", "es": "home"})


@query("m18_release_values")
def m18(spark, sf_dir):
    return note(spark, sf_dir).select("id", rules.release_values(F.col("title"), F.col("body")).alias("v")).select("id", "v.*")


@query("m07_institutional_boost_impact", f"WITH {NOTE}, b AS (SELECT id, CASE WHEN portal IN ('src1', 'src2') AND score10 >= 67 THEN least(score10 + 10, 100) ELSE score10 END AS boosted FROM note) SELECT id, boosted, CASE WHEN boosted >= 80 THEN 'high' WHEN boosted >= 70 THEN 'medium' ELSE 'low' END AS impact FROM b")
def m07(spark, sf_dir):
    rows = note(spark, sf_dir).select("id", op.boosted(F.col("score10"), F.col("portal"), ["src1", "src2"], 67).alias("boosted"))
    return rows.withColumn("impact", op.impact(F.col("boosted")))


@query("f21_token_sort_ratio")
def f21b(spark, sf_dir):
    """Each title with the one before it in its portal."""
    before = F.lag("title").over(Window.partitionBy("portal").orderBy("id"))
    rows = note(spark, sf_dir).select("id", "title", before.alias("before")).where("before IS NOT NULL")
    return rows.select("id", F.round(ev.token_sort_ratio("title", "before"), 9).alias("ratio"))
