"""Rule tables as columns: editorial scales, evaluation cascades, tags, priority ladders, field extraction.

Users change rules, not code: every rule is a value. All of it is built-in expressions on one row, so a table of any length
is scored without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, has_prefix, has_word


@dataclass(frozen=True)
class Penalty:
    """A factor for notes whose text (or title only) has the pattern, unless `unless` is there too; no pattern means the flag."""

    name: str
    factor: float
    pattern: str | None = None
    title_only: bool = False
    unless: str | None = None


@dataclass(frozen=True)
class Scale:
    """Penalties in order (the first that matches counts alone), else bonuses that compound, each capped at 1."""

    penalties: tuple[Penalty, ...]
    institutions: str = "a^"
    institutions_factor: float = 1.0
    keywords: str = "a^"
    keywords_factor: float = 1.0
    portals: dict[str, float] = field(default_factory=dict)
    version: int = 1


def _has(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike(f"(?iu){pattern}"), F.lit(False))


def penalty(scale: Scale, text: Column, title: Column, flag: Column) -> Column:
    """Name of the first penalty that applies; NULL if none."""
    out = []
    for p in scale.penalties:
        hit = flag if p.pattern is None else _has(title if p.title_only else text, p.pattern)
        if p.unless is not None:
            hit = hit & ~_has(text, p.unless)
        out.append(F.when(hit, p.name))
    return F.coalesce(*out, F.lit(None).cast("string"))


def adjusted(scale: Scale, score: Column, name: Column, text: Column, portal: Column) -> Column:
    """The score (0 to 1) after the named penalty, or after the bonuses if there is none."""
    cut = None
    for p in scale.penalties:
        cut = F.when(name == p.name, score * p.factor) if cut is None else cut.when(name == p.name, score * p.factor)
    mentions = F.size(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(f"(?iu)({scale.institutions})"), F.lit(1))))
    raised = F.when(mentions >= 2, F.least(score * scale.institutions_factor, F.lit(1.0))).otherwise(score)
    raised = F.when(_has(text, f"({scale.keywords})"), F.least(raised * scale.keywords_factor, F.lit(1.0))).otherwise(raised)
    for name_, factor in scale.portals.items():
        raised = F.when(portal == name_, F.least(raised * factor, F.lit(1.0))).otherwise(raised)
    return raised if cut is None else F.when(name.isNull(), raised).otherwise(cut)


def evaluated(notes: DataFrame, scale: Scale, excluded: list[str], anchors: list[str], threshold: float = 0.33, floor_portal: str | None = None, floor: float = 9.0) -> DataFrame:
    """notes (title, body, portal, topic, model_score in 0..1, opinion) with score (0 to 10), adjusted_score, penalised_by and
    discarded_by: excluded word, no anchor, below threshold, or NULL.

    An excluded phrase ends it; then an anchor term or a topic must be there; then the model's score is adjusted. The floor
    portal's notes get the floor at least, whatever the threshold.
    """
    text = F.lower(F.concat_ws(" ", F.col("title"), F.col("body")))
    rows = notes.withColumn("__text", text)
    within = lambda terms: F.exists(F.array(*[F.lit(t) for t in terms]), lambda t: F.contains(F.col("__text"), t)) if terms else F.lit(False)
    rows = rows.withColumns({"__out": within(excluded), "__in": within(anchors) | F.col("topic").isNotNull()})
    rows = rows.withColumn("penalised_by", F.when(~F.col("__out") & F.col("__in"), penalty(scale, F.col("__text"), F.col("title"), F.coalesce("opinion", F.lit(False)))))
    rows = rows.withColumn("adjusted_score", F.when(~F.col("__out") & F.col("__in"), adjusted(scale, F.col("model_score"), F.col("penalised_by"), F.col("__text"), F.col("portal"))))
    is_floor = F.col("portal") == floor_portal if floor_portal is not None else F.lit(False)
    low = F.coalesce(F.col("adjusted_score") < threshold, F.lit(True)) & ~F.coalesce(is_floor, F.lit(False))
    reason = F.when(F.col("__out"), "excluded word").when(~F.col("__in"), "no anchor").when(low, "below threshold")
    ten = F.floor(F.col("adjusted_score") * 100 + 0.5 + 1e-9) / 10  # to a tenth, halves up, whatever their last bit
    score = F.when(F.col("discarded_by").isNotNull(), 0.0).when(is_floor, F.greatest(ten, F.lit(floor))).otherwise(ten)
    return rows.withColumn("discarded_by", reason).withColumn("score", score).withColumn("rules_version", F.lit(scale.version)).drop("__text", "__out", "__in")


def entities(text: Column, names: dict[str, list[str]]) -> Column:
    """Sorted names whose aliases the text has as words (folded)."""

    def of(folded: Column) -> Column:
        found = []
        for name in sorted(names):
            hit = F.lit(False)
            for alias in names[name]:
                hit = hit | has_word(folded, alias)
            found.append(F.when(hit, name))
        return F.array_compact(F.array(*found))

    return F.get(F.transform(F.array(fold(text)), of), F.lit(0))  # folded once, not for each alias


@dataclass(frozen=True)
class Topic:
    """Strong words count ten, weak ones one where a context stem is there; a veto phrase rules the topic out."""

    name: str
    strong: tuple[str, ...]
    weak: tuple[str, ...] = ()
    context: tuple[str, ...] = ()
    veto: tuple[str, ...] = ()


def topic_of(folded: Column, topics: list[Topic]) -> Column:
    """(topic, hits) of the best topic by hits, then strong words, then the order of the list; (NULL, 0) if none."""
    count = lambda words: sum((has_word(folded, w).cast("int") for w in words), F.lit(0))
    some = []
    for k, t in enumerate(topics):
        veto = F.lit(False)
        for phrase in t.veto:
            veto = veto | F.contains(folded, F.lit(phrase))
        gate = F.lit(False)
        for stem in t.context:
            gate = gate | has_prefix(folded, stem)
        strong = count(t.strong)
        hits = F.when(veto, 0).otherwise(strong * 10 + F.when(gate, count(t.weak)).otherwise(0))
        some.append(F.struct(hits.alias("hits"), strong.alias("strong"), F.lit(-k).alias("order"), F.lit(t.name).alias("topic")))
    best = F.array_max(F.array(*some))
    return F.struct(F.when(best["hits"] > 0, best["topic"]).alias("topic"), F.coalesce(best["hits"], F.lit(0)).alias("hits"))


def first_slug(*steps: Column) -> Column:
    """The first of the slugs that is there: lane, keyword priority, topic, category."""
    return F.coalesce(*steps)


def keyword_slug(folded: Column, ordered: list[tuple[str, list[str]]]) -> Column:
    """The slug of the first entry one of whose words is there; NULL if none."""
    out = []
    for slug, words in ordered:
        hit = F.lit(False)
        for w in words:
            hit = hit | has_word(folded, w)
        out.append(F.when(hit, slug))
    return F.coalesce(*out)


def tags(text: Column, section: Column, rules: list[tuple[str, str]], of_section: dict[str, str], most: int = 3) -> Column:
    """The first `most` tags whose patterns match, in order, and the section's own tag after them."""
    found = F.slice(F.array_compact(F.array(*[F.when(_has(text, p), name) for name, p in rules])), 1, most)
    own = F.lit(None).cast("string")
    for prefix, tag in of_section.items():
        own = F.when(section.startswith(prefix), F.lit(tag)).otherwise(own)
    return F.when(own.isNotNull() & ~F.coalesce(F.array_contains(found, own), F.lit(False)), F.array_append(found, own)).otherwise(found)


@dataclass(frozen=True)
class Step:
    """A rung of a ladder: all that is given must hold. sections and tags: one of them; text: all patterns; without_*: none."""

    group: str
    text: tuple[str, ...] = ()
    tags: tuple[str, ...] = ()
    sections: tuple[str, ...] = ()
    category: str | None = None
    without_text: tuple[str, ...] = ()
    without_tags: tuple[str, ...] = ()

    def holds(self, text: Column, tags_: Column, section: Column, category: Column) -> Column:
        has_tag = lambda t: F.coalesce(F.array_contains(tags_, t), F.lit(False))
        ok = F.lit(True)
        for p in self.text:
            ok = ok & _has(text, p)
        for p in self.without_text:
            ok = ok & ~_has(text, p)
        if self.tags:
            some = F.lit(False)
            for t in self.tags:
                some = some | has_tag(t)
            ok = ok & some
        for t in self.without_tags:
            ok = ok & ~has_tag(t)
        if self.sections:
            ok = ok & F.coalesce(section.isin(*self.sections), F.lit(False))
        if self.category is not None:
            ok = ok & F.coalesce(F.contains(category, F.lit(self.category)), F.lit(False))
        return ok


def group_of(ladder: list[Step], text: Column, tags_: Column, section: Column, category: Column, skip: str | None = None, rest: str = "other") -> Column:
    """The group of the first rung that holds; skip leaves a group's rungs out."""
    out = [F.when(s.holds(text, tags_, section, category), s.group) for s in ladder if s.group != skip]
    return F.coalesce(*out, F.lit(rest))


def extracted(text: Column, group: Column, fields: dict[str, dict[str, str]]) -> Column:
    """Map of the fields of the row's group that match: the first capture of each pattern."""
    out = F.create_map().cast("map<string,string>")
    for name, patterns in fields.items():
        pairs = F.map_from_arrays(F.array(*[F.lit(k) for k in patterns]), F.array(*[F.trim(F.regexp_replace(F.regexp_extract(text, p, 1), r"\s+", " ")) for p in patterns.values()]))
        out = F.when(group == name, F.map_filter(pairs, lambda _, v: v.isNotNull() & (v != ""))).otherwise(out)
    return out


def indicators(text: Column, pattern: str) -> Column:
    """Array of (name, op, required, value, ok) of every threshold in a text; the pattern captures name, >= or <=, bound and value."""
    part = lambda k: F.regexp_extract_all(text, F.lit(pattern), F.lit(k))
    zipped = F.arrays_zip(part(1).alias("name"), part(2).alias("op"), part(3).alias("required"), part(4).alias("value"))
    number = lambda s: F.replace(F.when(F.contains(s, F.lit(".")) & F.contains(s, F.lit(",")), F.replace(s, F.lit("."), F.lit(""))).otherwise(s), F.lit(","), F.lit(".")).try_cast("double")

    def made(x: Column) -> Column:
        bound, value = number(x["required"]), number(x["value"])
        at_least = x["op"].isin(">=", "=>")
        ok = F.when(at_least, value >= bound).otherwise(value <= bound)
        return F.struct(F.trim(x["name"]).alias("name"), F.when(at_least, ">=").otherwise("<=").alias("op"), bound.alias("required"), value.alias("value"), ok.alias("ok"))

    return F.filter(F.transform(zipped, made), lambda x: x["required"].isNotNull() & x["value"].isNotNull())


def enriched(items: DataFrame, ladder: list[Step], fields: dict[str, dict[str, str]], needs: dict[str, str], demoted: dict[str, tuple[str, str, str]], split: tuple[str, str, str, str] | None, version: int) -> DataFrame:
    """items (text, section, category, tags, reviewed) with grp, fields, indicators, version and reviewed.

    needs: a group that needs a field is given up without it, and the item goes down the ladder again without that group.
    demoted: group -> (tag, field, other group): with the tag and without the field the item is of the other group.
    split: (group, pattern, with, without) parts a group by whether its text has indicators. The same input gives the
    same output, so a new version is run over all of history by overwriting.
    """
    text, tags_, section, category = F.col("text"), F.col("tags"), F.col("section"), F.col("category")
    rows = items.withColumn("grp", group_of(ladder, text, tags_, section, category)).withColumn("fields", extracted(text, F.col("grp"), fields))
    for name, need in needs.items():
        lost = (F.col("grp") == name) & F.col("fields")[need].isNull()
        rows = rows.withColumn("grp", F.when(lost, group_of(ladder, text, tags_, section, category, skip=name)).otherwise(F.col("grp")))
    rows = rows.withColumn("fields", extracted(text, F.col("grp"), fields))
    for name, (tag, need, other) in demoted.items():
        lost = (F.col("grp") == name) & F.coalesce(F.array_contains(tags_, tag), F.lit(False)) & F.col("fields")[need].isNull()
        rows = rows.withColumn("grp", F.when(lost, other).otherwise(F.col("grp")))
    rows = rows.withColumn("fields", extracted(text, F.col("grp"), fields))
    if split is not None:
        name, pattern, with_, without = split
        rows = rows.withColumn("indicators", F.when(F.col("grp") == name, indicators(text, pattern)))
        rows = rows.withColumn("grp", F.when(F.col("grp") != name, F.col("grp")).when(F.size("indicators") > 0, with_).otherwise(without))
    reviewed = F.coalesce("reviewed", F.lit("provisional")) if "reviewed" in items.columns else F.lit("provisional")
    return rows.withColumn("version", F.lit(version)).withColumn("reviewed", reviewed)


def outdated(items: DataFrame, version: int, origin: str = "machine") -> DataFrame:
    """The items that the current version of `origin` didn't make."""
    return items.where(~F.coalesce((F.col("origin") == origin) & F.col("version").eqNullSafe(F.lit(version)), F.lit(False)))


def retry_decision(old_length: Column, new_length: Column, attempts: Column, cap: int = 3, least: int = 230) -> Column:
    """retry, or why not: capped, short, not longer."""
    return F.when(attempts >= cap, "capped").when(F.coalesce(new_length, F.lit(0)) < least, "short").when(new_length <= F.coalesce(old_length, F.lit(0)), "not longer").otherwise("retry")


def picture(own: Column, bad_source: Column, gallery: Column, placeholder: str) -> Column:
    """(url, kind, nulled): the page's own picture unless its source can't serve it, else the gallery's, else the placeholder."""
    usable = own.isNotNull() & (own != "") & ~F.coalesce(bad_source, F.lit(False))
    nulled = own.isNotNull() & (own != "") & F.coalesce(bad_source, F.lit(False))
    url = F.when(usable, own).otherwise(F.coalesce(gallery, F.lit(placeholder)))
    kind = F.when(usable, "page").when(gallery.isNotNull(), "gallery").otherwise("placeholder")
    return F.struct(url.alias("url"), kind.alias("kind"), nulled.alias("nulled"))


def release_values(title: Column, body: Column) -> Column:
    """(periodo, monthly, cumulative, twelve) of a press release on prices: signed per cents by what stands before them."""
    from ..functions.text import MONTHS, month_number

    text = F.concat_ws(" ", title, body)
    month, year = F.regexp_extract(text, f"(?iu)({'|'.join(MONTHS)}) (?:de |del )?([0-9]{{4}})", 1), F.regexp_extract(text, f"(?iu)({'|'.join(MONTHS)}) (?:de |del )?([0-9]{{4}})", 2)
    periodo = F.when(year != "", F.format_string("%s-%02d", year, month_number(month, MONTHS)))

    def percent(before: str) -> Column:
        pattern = f"(?iu){before}[^0-9%-]{{0,60}}(-?[0-9]+(?:[.,][0-9]+)?) ?%"
        number = F.replace(F.regexp_extract(text, pattern, 1), F.lit(","), F.lit(".")).try_cast("double")
        falls = F.regexp_extract(text, f"(?iu)({before}[^0-9%-]{{0,60}})-?[0-9]", 1).rlike("(?iu)negativa|baj|ca[yí]|descend|disminu")
        return F.when(falls & (number > 0), -number).otherwise(number)

    return F.struct(periodo.alias("periodo"), percent("mensual").alias("monthly"), percent("acumulad").alias("cumulative"), percent("(?:doce|12) meses").alias("twelve"))


def usable_response(text: Column, sentinel: str, refusals: list[str]) -> Column:
    """Whether a service's answer counts: not empty, not the sentinel (a pattern for the whole answer), no refusal phrase in it."""
    one = F.lower(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\r\n]+", " ")))
    ok = (one != "") & ~one.rlike(sentinel)
    for phrase in refusals:
        ok = ok & ~F.contains(one, F.lit(phrase))
    return ok


def keyword_score(text: Column, portal: Column, excluded: list[str], forced: list[str], topics: dict[str, list[str]], gated: tuple[list[str], list[str]] = ((), ())) -> Column:
    """0 with an excluded word, or for a gated portal without one of the anchors; 10 with a forced one; else the words of the best topic."""
    has = lambda word: F.contains(text, F.lit(word))

    def some(words) -> Column:
        hit = F.lit(False)
        for w in words:
            hit = hit | has(w)
        return hit

    counts = [sum((has(w).cast("int") for w in words), F.lit(0)) for words in topics.values()]
    portals, anchors = gated
    shut = some(excluded) | (F.coalesce(portal.isin(list(portals)), F.lit(False)) & ~some(anchors) if portals else F.lit(False))
    return F.when(shut, 0).when(some(forced), 10).otherwise(F.array_max(F.array(*counts)))
