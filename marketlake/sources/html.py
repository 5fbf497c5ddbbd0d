"""Pages as rows of elements, read by a state machine over the markup: nesting, comments, scripts, unquoted attributes and missing ends.

elements() is the table function: a task reads each page once, whole, and gives a row per wanted element; tables, links, headings,
images and cards are DataFrame expressions over these rows. A page is one row's text, so memory is that of the largest page.

Defined results: a null page has no elements; what ends nowhere ends with what surrounds it; ends of what isn't open are passed over; a
`<` that opens no tag is text; comments, scripts and styles have no text; names are in lower case, of an attribute given twice the first
counts and one without a value has an empty one; character references are resolved in text and values; white space in text is collapsed.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as fn

#: Fixed by the standard: elements without content, those whose content is no markup, and what a start tag ends if it is open.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style".split())
PLAIN = frozenset("title textarea".split())
ENDS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "tbody": ("thead", "tbody", "tr", "td", "th"), "thead": ("tbody", "tr", "td", "th"), "tfoot": ("thead", "tbody", "tr", "td", "th"),
} | dict.fromkeys("p div ul ol dl table h1 h2 h3 h4 h5 h6 article section nav footer header form pre blockquote main aside hr".split(), ("p",))
#: A start tag ends nothing beyond these.
SCOPES = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table",), "th": ("table",), "tbody": ("table",), "thead": ("table",), "tfoot": ("table",)}
WANTED = ("a", "h1", "h2", "h3", "img", "li", "meta", "p", "td", "th", "time", "title", "tr")
SHAPE = "page_id long, place int, parent int, tag string, path string, attributes map<string,string>, text string"


def attributes(markup: str, at: int) -> tuple[dict[str, str], int, bool]:
    """Attributes from a place inside a tag on, the place after the tag, and whether it ends itself."""
    found: dict[str, str] = {}
    n = len(markup)
    while True:
        while at < n and (markup[at].isspace() or markup[at] == "/"):
            at += 1
        if at >= n:
            return found, n, False
        if markup[at] == ">":
            return found, at + 1, markup[at - 1] == "/"
        start = at
        at += 1
        while at < n and not markup[at].isspace() and markup[at] not in "=>/":
            at += 1
        name, value = markup[start:at].lower(), ""
        after = at
        while after < n and markup[after].isspace():
            after += 1
        if after < n and markup[after] == "=":
            at = after + 1
            while at < n and markup[at].isspace():
                at += 1
            if at < n and markup[at] in "\"'":
                end = markup.find(markup[at], at + 1)
                end = n if end < 0 else end
                value, at = markup[at + 1 : end], min(n, end + 1)
            else:
                start = at
                while at < n and not markup[at].isspace() and markup[at] != ">":
                    at += 1
                value = markup[start:at]
        found.setdefault(name, html.unescape(value))


def events(markup: str) -> Iterator[tuple[str, str, dict[str, str], bool]]:
    """(kind, name or text, attributes, ends itself): kinds are start, end and text."""
    at, n, text = 0, len(markup), 0

    def said(end: int) -> Iterator[tuple[str, str, dict[str, str], bool]]:
        if end > text:
            yield "text", html.unescape(markup[text:end]), {}, False

    while (at := markup.find("<", at)) >= 0:
        following = markup[at + 1 : at + 2]
        if following.isascii() and following.isalpha() or following == "/" and markup[at + 2 : at + 3].isascii() and markup[at + 2 : at + 3].isalpha():
            yield from said(at)
            closes = following == "/"
            start = at = at + 1 + closes
            while at < n and not markup[at].isspace() and markup[at] not in "/>":
                at += 1
            name = markup[start:at].lower()
            found, at, single = attributes(markup, at)
            yield ("end" if closes else "start"), name, {} if closes else found, single
            text = at
            if not closes and (name in RAW or name in PLAIN):
                end = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(markup, at)
                stop = end.start() if end else n
                if name in PLAIN:
                    yield from said(stop)
                text = at = stop
        elif following in ("!", "?") or following == "/":
            yield from said(at)
            if markup.startswith("<!--", at):
                end = markup.find("-->", at + 4)
                at = n if end < 0 else end + 3
            else:
                end = markup.find(">", at)
                at = n if end < 0 else end + 1
            text = at
        else:
            at += 1
    yield from said(n)


def tree(markup: str, wanted: frozenset[str]) -> list[list]:
    """[place, parent's place (-1: none), tag, path, attributes, parts of its text] of the wanted elements; places number all elements."""
    out, opened, place = [], [], 0  # opened: (tag, place, row or None)

    def close(tags: tuple[str, ...], scope: tuple[str, ...]) -> None:
        """End the open elements down to the outermost of `tags` above `scope`."""
        for k in range(len(opened) - 1, -1, -1):
            if opened[k][0] in scope:
                break
            if opened[k][0] in tags:
                lowest = k
                while lowest and opened[lowest - 1][0] in tags and opened[lowest - 1][0] not in scope:
                    lowest -= 1
                del opened[lowest:]
                return

    for kind, name, found, single in events(markup):
        if kind == "text":
            for _, _, row in opened:
                if row is not None:
                    row[5].append(name)
        elif kind == "start":
            if name in ENDS:
                close(ENDS[name], SCOPES.get(name, ("table", "td", "th", "li", "body")))
            row = None
            if name in wanted:
                row = [place, opened[-1][1] if opened else -1, name, "/".join([t for t, _, _ in opened] + [name]), found, []]
                out.append(row)
            if name in ("br", "p", "div", "tr", "td", "th", "li"):  # words on both sides stay apart
                for _, _, above in opened:
                    if above is not None:
                        above[5].append(" ")
            if name not in VOID and not (single and name not in RAW and name not in PLAIN):
                opened.append((name, place, row))
            place += 1
        else:
            at = next((k for k in range(len(opened) - 1, -1, -1) if opened[k][0] == name), None)
            if at is not None:
                del opened[at:]
    return out


def elements(pages: DataFrame, wanted: tuple[str, ...] = WANTED, html_column: str = "html", key: str = "page_id") -> DataFrame:
    """page_id, place, parent, tag, path (of tags from the outermost on), attributes, text of the wanted elements, in the page's order.

    text is all that stands in the element, those in it included.
    """
    tags = frozenset(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page, markup in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows = tree(markup or "", tags)
                columns = [[page] * len(rows), *([r[k] for r in rows] for k in range(4)), [list(r[4].items()) for r in rows], [" ".join("".join(r[5]).split()) for r in rows]]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    names = ["page_id", "place", "parent", "tag", "path", "attributes", "text"]
    types = [pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.map_(pa.string(), pa.string()), pa.string()]
    return pages.select(F.col(key).cast("long"), html_column).mapInArrow(read, SHAPE)


def table_rows(found: DataFrame) -> DataFrame:
    """page_id, row (the place of its tr), cells (texts of its own td and th, in order): rows of a table within a cell are rows of their own."""
    cells = found.where("tag IN ('td', 'th')")
    return cells.groupBy("page_id", F.col("parent").alias("row")).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda c: c["text"]).alias("cells"))  # one row's cells


def links(found: DataFrame, pages: DataFrame, within: str = "", least: int = 0) -> DataFrame:
    """page_id, place, title, link (absolute) of anchors with a title of `least` characters or more; within: only in such an element."""
    inside = F.col("path").rlike(f"(^|/)({within})/") if within else F.lit(True)
    anchors = found.where((F.col("tag") == "a") & inside & (F.length("text") >= least)).select("page_id", "place", F.col("text").alias("title"), F.col("attributes")["href"].alias("href"))
    return anchors.join(pages.select("page_id", "url"), "page_id").select("page_id", "place", "title", fn.absolute_url(F.col("href"), F.col("url")).alias("link")).where("link IS NOT NULL")


def page_image(found: DataFrame, pages: DataFrame, names: tuple[str, ...] = ("og:image:secure_url", "og:image", "twitter:image")) -> DataFrame:
    """page_id, image: of the first of these properties that a page has with a link, made absolute."""
    name: Column = F.coalesce(F.col("attributes")["property"], F.col("attributes")["name"])
    metas = found.where("tag = 'meta'").select("page_id", "place", F.array_position(F.array(*[F.lit(n) for n in names]), F.lower(name)).alias("rank"), F.col("attributes")["content"].alias("content")).where("rank > 0 AND trim(content) <> ''")
    first = metas.groupBy("page_id").agg(F.min_by("content", F.struct("rank", "place")).alias("content"))
    return first.join(pages.select("page_id", "url"), "page_id").select("page_id", fn.absolute_url(F.trim("content"), F.col("url")).alias("image")).where("image IS NOT NULL")
