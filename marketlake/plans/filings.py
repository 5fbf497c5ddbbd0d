"""Queries on filings: every turn of a conversation is an item, its role the section."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import rules
from ..registry import query
from ..session import table

TAGS = [("issue", "ouha"), ("coupon", "stble"), ("rating", "eash"), ("covenant", "whan"), ("meeting", "ndre"), ("person", "edble"), ("loan", "thst"), ("dividend", "lyer"), ("audit", "onst")]
OF_SECTION = {"assistant": "procedure"}
LADDER = [
    rules.Step("issues", text=("register",)), rules.Step("issues", text=("ouha",), sections=("assistant",), tags=("issue",)), rules.Step("coupons", tags=("coupon",), without_tags=("covenant",)),
    rules.Step("covenants", tags=("covenant",)), rules.Step("ratings", tags=("rating",), category="even"), rules.Step("meetings", text=("call", "date")), rules.Step("board", text=("er .*er ", "ation")),
    rules.Step("trusts", text=("trust",)), rules.Step("audits", tags=("audit",), without_tags=("meeting",)), rules.Step("staff", tags=("person",)), rules.Step("loans", tags=("loan",), without_text=("trust",)),
    rules.Step("dividends", tags=("dividend",)), rules.Step("funds", text=("fund|ingor",)), rules.Step("meetings", tags=("meeting",)),
]
FIELDS = {"coupons": {"word": "(stble[a-z]*)", "next": "stble[a-z]* +([a-z]+)"}, "loans": {"word": "([a-z]*thst[a-z]*)"}, "staff": {"word": "([a-z]*edble[a-z]*)", "after": "edble[a-z]* (xyz)"}, "board": {"word": "er (q[a-z]+) er"}}


def items(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("section"), F.when(F.col("turn") % 2 == 0, "even").otherwise("odd").alias("category"), "text")
    return rows.withColumn("tags", rules.tags(F.col("text"), F.col("section"), TAGS, OF_SECTION))


def has(pattern: str) -> str:
    return f"coalesce(regexp_matches(text, '(?i){pattern}'), false)"


TAGGED = "it AS (SELECT conv_id, turn, role AS section, CASE WHEN turn % 2 = 0 THEN 'even' ELSE 'odd' END AS category, text, list_filter([" + ", ".join(f"CASE WHEN {has(p)} THEN '{n}' END" for n, p in TAGS) + "], lambda x: x IS NOT NULL)[1:3] AS t3 FROM conversations), tg AS (SELECT *, CASE WHEN starts_with(section, 'assistant') THEN list_append(t3, 'procedure') ELSE t3 END AS tags FROM it)"


def rung(s: rules.Step) -> str:
    parts = [has(p) for p in s.text] + [f"NOT {has(p)}" for p in s.without_text]
    if s.tags:
        parts.append("(" + " OR ".join(f"list_contains(tags, '{t}')" for t in s.tags) + ")")
    parts += [f"NOT list_contains(tags, '{t}')" for t in s.without_tags]
    if s.sections:
        parts.append("section IN (" + ", ".join(f"'{x}'" for x in s.sections) + ")")
    if s.category:
        parts.append(f"contains(category, '{s.category}')")
    return f"WHEN {' AND '.join(parts)} THEN '{s.group}'"


GROUPED = TAGGED + ", gr AS (SELECT *, CASE " + " ".join(map(rung, LADDER)) + " ELSE 'other' END AS grp FROM tg)"


@query("m13_filing_tags", f"WITH {TAGGED} SELECT conv_id, turn, array_to_string(tags, ',') AS tags, md5(text) AS text_md5 FROM tg")
def m13(spark, sf_dir):
    return items(spark, sf_dir).select("conv_id", "turn", F.array_join("tags", ",").alias("tags"), F.md5("text").alias("text_md5"))


@query("m14_filing_groups", f"WITH {GROUPED} SELECT conv_id, turn, section, grp, md5(text) AS text_md5 FROM gr")
def m14(spark, sf_dir):
    group = rules.group_of(LADDER, F.col("text"), F.col("tags"), F.col("section"), F.col("category"))
    return items(spark, sf_dir).select("conv_id", "turn", "section", group.alias("grp"), F.md5("text").alias("text_md5"))


FIELD = "nullif(trim(regexp_extract(text, '{}', 1)), '')"


@query("m15_filing_fields", f"WITH {GROUPED} SELECT conv_id, turn, grp, CASE grp WHEN 'coupons' THEN {FIELD.format(FIELDS['coupons']['word'])} WHEN 'loans' THEN {FIELD.format(FIELDS['loans']['word'])} WHEN 'staff' THEN {FIELD.format(FIELDS['staff']['word'])} WHEN 'board' THEN {FIELD.format(FIELDS['board']['word'])} END AS word, CASE WHEN grp = 'coupons' THEN {FIELD.format(FIELDS['coupons']['next'])} END AS next, md5(text) AS text_md5 FROM gr")
def m15(spark, sf_dir):
    rows = items(spark, sf_dir).withColumn("grp", rules.group_of(LADDER, F.col("text"), F.col("tags"), F.col("section"), F.col("category")))
    rows = rows.withColumn("fields", rules.extracted(F.col("text"), F.col("grp"), FIELDS))
    return rows.select("conv_id", "turn", "grp", F.col("fields")["word"].alias("word"), F.col("fields")["next"].alias("next"), F.md5("text").alias("text_md5"))


@query("m16_enriched_filings")
def m16(spark, sf_dir):
    """Board items without a name go down the ladder again, staff items of a meeting without what follows become meetings, and
    covenants are parted by whether they have indicators."""
    rows = rules.enriched(items(spark, sf_dir), LADDER, FIELDS, {"board": "word"}, {"staff": ("meeting", "after", "meetings")}, ("covenants", r"([a-z]+) *(>=|<=|=>|=<) *([0-9.,]+)[^0-9]*([0-9.,]+)", "reported covenants", "announced covenants"), 3)
    return rows.select("conv_id", "turn", "grp", "version", "reviewed", F.md5("text").alias("text_md5"))


@query("m32_outdated_items", "SELECT conv_id, turn, md5(text) AS text_md5 FROM conversations WHERE NOT (role = 'assistant' AND turn % 3 = 1)")
def m32(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").withColumns({"origin": F.when(F.col("role") == "assistant", "machine").otherwise("person"), "version": (F.col("turn") % 3).cast("int")})
    return rules.outdated(rows, 1).select("conv_id", "turn", F.md5("text").alias("text_md5"))


SENTINEL, REFUSALS = "^n/?a$", ["sorry", "lo siento", "thest"]


@query("m19_clean_responses", "WITH t AS (SELECT conv_id, turn, role, text, trim(regexp_replace(text, '[ \\t\\r\\n]+', ' ', 'g')) AS one FROM conversations) SELECT conv_id, turn, role = 'assistant' AND coalesce(one, '') <> '' AND NOT regexp_matches(lower(one), '^n/?a$') AND NOT contains(lower(one), 'sorry') AND NOT contains(lower(one), 'lo siento') AND NOT contains(lower(one), 'thest') AS valid, md5(text) AS text_md5 FROM t")
def m19(spark, sf_dir):
    valid = (F.col("role") == "assistant") & rules.usable_response(F.col("text"), SENTINEL, REFUSALS)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", valid.alias("valid"), F.md5("text").alias("text_md5"))
