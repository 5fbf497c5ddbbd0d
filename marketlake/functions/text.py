"""Text functions as Column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Latin letters with marks and what they fold to.
MARKED = "áàâäãåéèêëíìîïóòôöõúùûüñçý"
PLAIN = "aaaaaaeeeeiiiiooooouuuuncy"


def fold(text: Column) -> Column:
    """Lower case without marks, runs of white space as one blank."""
    return F.trim(F.regexp_replace(F.translate(F.lower(text), MARKED, PLAIN), "[ \\t\\n\\r]+", " "))


def has_word(folded: Column, word: str) -> Column:
    """Whether a folded text holds a folded word (a-z0-9) between other characters."""
    if not re.fullmatch("[a-z0-9 ]+", word):
        return folded.rlike(f"(^|[^0-9a-z]){word}([^0-9a-z]|$)")
    # the word itself comes first in the pattern, so that other places are passed over fast
    return folded.rlike(f"{word}(?![0-9a-z])(?<![0-9a-z]{word})")


def slug(text: Column) -> Column:
    """ASCII letters and digits, joined by underscores."""
    return F.trim(F.regexp_replace(fold(text), "[^a-z0-9]+", "_"), F.lit("_"))


def name_key(text: Column) -> Column:
    """A name without a last parenthesis, marks and anything but letters and digits."""
    return F.regexp_replace(fold(F.regexp_replace(text, r"\s*\([^()]*\)\s*$", "")), "[^a-z0-9]", "")


def html_text(html: Column) -> Column:
    """Text of HTML: tags, named and numbered entities become blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(html, "<[^>]+>", " "), "&#[0-9]+;|&[0-9A-Za-z_]+;", " "), "[ \\t\\n\\r\\f]+", " "))


#: The separators of words in Unicode (Zs).
BLANKS = " \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"


def cut_at_word(text: Column, most: int, ellipsis: str = "") -> Column:
    """The trimmed text if it has at most `most` characters; else cut at the last blank before, hard if that is in the first
    half, without blanks and stops at the end, and with the ellipsis."""
    text = F.btrim(text, F.lit(BLANKS))
    head = F.substring(text, 1, most)
    words = F.regexp_extract(head, "(?s)^(.*) [^ ]*$", 1)
    cut = F.when(F.length(words) >= most // 2, words).otherwise(head)
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.regexp_replace(cut, r"[ ,;:.]+\z", ""), F.lit(ellipsis)))


#: Query parameters that only track a visit.
TRACKING = "utm_[^=&]*|fbclid|gclid|mc_cid|mc_eid"


def url_key(url: Column) -> Column:
    """Normal form of a URL: lower case, without fragment, tracking parameters and slashes at the path's end."""
    plain = F.regexp_replace(F.lower(F.trim(url)), "#.*$", "")
    path = F.regexp_replace(F.regexp_extract(plain, "^([^?]*)", 1), "/+$", "")
    kept = F.filter(F.split(F.regexp_extract(plain, "[?](.*)$", 1), "&"), lambda p: (p != "") & ~p.rlike(f"^({TRACKING})(=|$)"))
    return F.concat(path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def spanish_number(text: Column) -> Column:
    """A number with thousands dots and a decimal comma; NULL if it is none."""
    return F.when(text.rlike("^-?[0-9.]*,?[0-9]+$"), F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit(","), F.lit(".")).cast("double"))


def replaced(text: Column, pairs: list[tuple[str, str]]) -> Column:
    """The pairs (bad, good) replaced one after the other, so that a later pair sees what an earlier one made."""
    for bad, good in pairs:
        text = F.replace(text, F.lit(bad), F.lit(good))
    return text


def has_prefix(folded: Column, stem: str) -> Column:
    """Whether a word of a folded text begins with the folded stem."""
    return folded.rlike(f"(^|[^0-9a-z]){stem}")


#: Letters of the Spanish alphabet; digits and underscores bound a word.
LETTERS = "a-zA-ZáéíóúüñÁÉÍÓÚÜÑ"


def has_spanish_word(text: Column, word: str) -> Column:
    """Whether a text holds a word between other characters than Spanish letters, in any case."""
    return text.rlike(f"(?iu)(^|[^{LETTERS}]){word}([^{LETTERS}]|$)")


#: Abbreviations whose dot doesn't end a sentence.
ABBREVIATIONS = "ee uu art núm num no nro etc dr dra sr sra srta lic ing arq av ud uds pág pag vol cap us bs aprox máx mín gral tel ref depto ej".split()


def sentences(text: Column) -> Column:
    """The sentences of a text: a stop, white space and a capital, digit or opening mark end one, unless the stop is a dot after an
    abbreviation or an initial."""
    text = F.trim(F.coalesce(text, F.lit("")))
    short = "|".join(ABBREVIATIONS)
    # a mark before the white space of every such stop, taken back after an abbreviation or a word of one or two letters
    marked = F.regexp_replace(text, "([.!?])[ \\t\\n\\r]+(?=[«\"“¿¡A-ZÁÉÍÓÚÑ0-9])", "$1\u0001")
    kept = F.regexp_replace(marked, f"(?i)(?<=^|[ \\t\\n\\r(\u0001])((?:{short}|\\p{{L}}{{1,2}})\\.+)\u0001", "$1 ")
    parts = F.transform(F.split(kept, "\u0001"), lambda s: F.trim(s))
    return F.filter(parts, lambda s: s != "")


def summary(text: Column, most: int = 200, at_most: int = 2) -> Column:
    """The text if it fits, else its first whole sentences that do, else cut_at_word()."""
    whole = F.trim(text)
    parts = F.slice(sentences(text), 1, at_most)
    start = F.struct(F.lit("").alias("kept"), F.lit(False).alias("full"))

    def add(acc: Column, part: Column) -> Column:
        longer = F.trim(F.concat(acc["kept"], F.lit(" "), part))
        fits = ~acc["full"] & (F.length(longer) <= most)
        return F.struct(F.when(fits, longer).otherwise(acc["kept"]).alias("kept"), (~fits).alias("full"))

    kept = F.aggregate(parts, start, add, lambda acc: acc["kept"])
    return F.when(F.length(whole) <= most, whole).when(kept != "", kept).otherwise(cut_at_word(text, most))


#: Spanish month names and their abbreviations.
MONTHS = "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre".split()
SHORT_MONTHS = "ene feb mar abr may jun jul ago sep oct nov dic".split()


def month_number(name: Column, names: list[str]) -> Column:
    """1 to 12 for a month's name in any case, NULL for any other text."""
    return F.nullif(F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(name)).cast("int"), F.lit(0))


def any_date(text: Column, first_year: int = 2020, last_year: int = 2100) -> Column:
    """The first date in a text, by form: 2026-06-26, 26/06/2026 or 26-06-2026, 26 de junio de 2026, 26-jun-2026; NULL if none."""
    text = F.trim(text)

    def made(pattern: str, y: int, m: int, d: int, names: list[str] | None = None, bounded: bool = False) -> Column:
        part = lambda k: F.regexp_extract(text, pattern, k)
        number = lambda k: F.when(part(k) != "", part(k)).cast("int")
        month = month_number(part(m), names) if names else number(m)
        day = F.try_to_date(F.format_string("%04d-%02d-%02d", number(y), month, number(d)), "yyyy-MM-dd")
        fits = number(y).isNotNull() & month.isNotNull()
        if bounded:
            fits = fits & number(y).between(first_year, last_year)
        return F.when(fits, day)

    return F.coalesce(
        made("\\b([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\\b", 1, 2, 3, bounded=True),
        made("\\b([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})\\b", 3, 2, 1),
        made("(?iu)([0-9]{1,2})\\s+de\\s+([a-záéíóú]+)\\s+de\\s+([0-9]{4})", 3, 2, 1, MONTHS),
        made("(?i)\\b([0-9]{1,2})[- ]([a-z]{3})[- .]*([0-9]{4})\\b", 3, 2, 1, SHORT_MONTHS),
    )


def period_of_label(label: Column, year: Column) -> Column:
    """yyyy for a year label (with or without a mark of preliminary), yyyy-Qn for a roman quarter of `year`; NULL for others."""
    own = F.regexp_extract(label, r"(?i)^\s*([0-9]{4})\s*(\(?\s*p\s*\)?)?\s*$", 1)
    roman = F.upper(F.regexp_extract(label, r"(?i)^\s*(III|II|IV|I)\s+Trimestre\s*$", 1))
    n = F.array_position(F.array(*[F.lit(q) for q in ("I", "II", "III", "IV")]), roman)
    quarter = F.when((n > 0) & year.isNotNull(), F.concat(year.cast("string"), F.lit("-Q"), n.cast("string")))
    return F.when(own != "", own).otherwise(quarter)


def is_preliminary(label: Column) -> Column:
    """Whether a year label bears the mark (p)."""
    return label.rlike(r"(?i)^\s*[0-9]{4}\s*\(?\s*p\s*\)?\s*$")


def absolute_url(link: Column, base: Column) -> Column:
    """A link as seen from its page: with scheme and host; NULL for an empty one."""
    origin = F.regexp_extract(base, "^([a-z]+://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_extract(base, "^([^?#]*)", 1), "[^/]*$", "")
    folder = F.when(F.length(folder) <= F.length(F.regexp_extract(base, "^([a-z]+://)", 1)), F.concat(origin, F.lit("/"))).otherwise(folder)
    made = F.when(link.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*:"), link).when(link.startswith("//"), F.concat(F.regexp_extract(base, "^([a-z]+:)", 1), link))
    return F.when(link != "", made.when(link.startswith("/"), F.concat(origin, link)).otherwise(F.concat(folder, link)))


#: The tags that name a page's picture, in the order in which they count.
IMAGE_TAGS = ["og:image", "og:image:secure_url", "twitter:image"]


def page_image(html: Column, url: Column) -> Column:
    """Absolute URL of the picture that a page names in its meta tags; NULL if none."""
    tags = F.regexp_extract_all(html, F.lit("(?i)<meta\\s[^>]*>"), F.lit(0))

    def content(name: str) -> Column:
        mine = F.filter(tags, lambda t: t.rlike(f"(?i)(property|name)\\s*=\\s*[\"']{name}[\"']"))
        found = F.transform(mine, lambda t: F.trim(F.regexp_extract(t, "(?i)content\\s*=\\s*[\"']([^\"']*)[\"']", 1)))
        return F.get(F.filter(found, lambda c: c != ""), F.lit(0))

    return absolute_url(F.coalesce(*[content(n) for n in IMAGE_TAGS], F.lit("")), url)


def epoch_of_url(url: Column) -> Column:
    """The time that a URL ends with as _<seconds since 1970>; NULL if it doesn't."""
    seconds = F.regexp_extract(url, "_([0-9]{9,})$", 1)
    return F.timestamp_seconds(F.when(seconds != "", seconds).cast("long"))


def without_publisher(title: Column, names: list[str]) -> Column:
    """A title without a publisher's name after a dash or bar at its end, twice, as in "News - Paper - Country"."""
    listed = "|".join("\\Q" + n + "\\E" for n in names)
    for _ in range(2):
        title = F.regexp_replace(title, f"(?iu)\\s*[-–—|]\\s*({listed})\\s*$", "")
    return F.trim(title)


def folded_aliases(text: Column, aliases: dict[str, list[str]]) -> Column:
    """Every alias replaced by its one name, longer aliases first; the rest of the text stays as it is."""
    for name, forms in aliases.items():
        for form in sorted(forms, key=lambda f: (-len(f), f)):
            text = F.regexp_replace(text, f"(?iu)(?<![\\p{{L}}\\p{{N}}_])\\Q{form}\\E(?![\\p{{L}}\\p{{N}}_])", name)
    return text


def dedupe_key(title: Column, publishers: list[str], aliases: dict[str, list[str]]) -> Column:
    """What titles are compared by."""
    return folded_aliases(without_publisher(title, publishers), aliases)


def amounts(text: Column) -> Column:
    """Sorted set of the numbers with a scale (million, thousand) in a text, as digits_scale: 40_millon."""
    pattern = F.lit("([0-9][0-9.,]*) *(mill?on(?:es)?|mil)(?![0-9a-z_])")
    folded = fold(text)
    number, scale = F.regexp_extract_all(folded, pattern, F.lit(1)), F.regexp_extract_all(folded, pattern, F.lit(2))
    joined = F.zip_with(number, scale, lambda n, s: F.concat(F.regexp_replace(n, "[.,]", ""), F.lit("_"), F.substring(s, 1, 6)))
    return F.array_sort(F.array_distinct(joined))


def names(text: Column) -> Column:
    """The plausible names of a list like "A B, C D y E F": two to six words, a capital first, under 60 characters."""
    plain = F.regexp_replace(F.regexp_replace(text, r"\s+", " "), "^[ .;:]+|[ .;:]+$", "")
    parts = F.transform(F.split(plain, ", *| [ye] (?=[A-ZÁÉÍÓÚÑ])"), lambda p: F.regexp_replace(p, "^[ .;:]+|[ .;:]+$", ""))
    return F.filter(parts, lambda p: p.rlike("^[A-ZÁÉÍÓÚÑÜ]") & F.size(F.split(p, " ")).between(2, 6) & (F.length(p) < 60))


def opinion(title: Column, url: Column, sections: list[str], markers: list[str]) -> Column:
    """Whether a note is an opinion: by a section in its URL or a marker (a pattern) in its title."""
    hit = F.lit(False)
    for s in sections:
        hit = hit | F.coalesce(F.contains(F.lower(url), F.lit(s)), F.lit(False))
    for m in markers:
        hit = hit | F.coalesce(title.rlike(f"(?iu){m}"), F.lit(False))
    return hit
