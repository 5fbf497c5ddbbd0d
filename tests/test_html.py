"""The HTML reader against the standard library's parser, and on broken and nested markup."""

import random
from html.parser import HTMLParser

from marketlake.sources import html

SF = "/root/testdata/sf0.001"


class Plain(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tags, self.text = [], []

    def handle_starttag(self, tag, attrs):
        once = {}
        for k, v in attrs:
            once.setdefault(k, v or "")
        self.tags.append((tag, once))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        if not (self.tags and self.tags[-1][0] in ("script", "style") and self.raw):
            self.text.append(data)

    raw = property(lambda self: getattr(self, "cdata_elem", None) in ("script", "style"))


def plain(markup):
    parser = Plain()
    parser.feed(markup)
    parser.close()
    return parser.tags, "".join(parser.text)


def test_events_equal_the_library_on_the_given_pages(spark):
    for row in spark.read.parquet(f"{SF}/pages.parquet").collect():
        found = list(html.events(row.html))
        tags, text = plain(row.html)
        assert [(n, a) for kind, n, a, _ in found if kind == "start"] == tags
        assert "".join(n for kind, n, _, _ in found if kind == "text") == text


def test_events_equal_the_library_on_made_markup():
    parts = ["<p>", "</p>", "<a href=x/y>", "</a>", "<img src='a b' alt=\"q\">", "<br/>", "<!-- <p> -->", "<script>if (a<b) '</p>'</script>", "text & more &amp; x", "a < b", "<td nowrap>", '<a  HREF = "u&amp;v" href=2 >', "</td >", "<b>", "</b>"]
    for seed in range(400):
        markup = "".join(random.Random(seed).choices(parts, k=8))
        found = list(html.events(markup))
        tags, text = plain(markup)
        assert [(n, a) for kind, n, a, _ in found if kind == "start"] == tags, markup
        assert "".join(n for kind, n, _, _ in found if kind == "text") == text, markup


def rows_of(spark, *markup, wanted=html.WANTED):
    pages = spark.createDataFrame([(k, f"https://site.example/dir/page{k}", m) for k, m in enumerate(markup)], "page_id long, url string, html string")
    return pages, html.elements(pages, wanted)


def test_tables_with_missing_ends_and_tables_in_cells(spark):
    nested = "<table><tr><th>Fecha<th>TC<tr><td>26/06/2026<td> 9,<b>95</b> <tr><td>x<table><tr><td>in<td>ner</table><td>after</table><p>rest"
    _, found = rows_of(spark, nested, "<table><tbody><tr><td>1</td></tr><tbody><tr><td>2", None, "")
    cells = {(r.page_id, tuple(r.cells)) for r in html.table_rows(found).collect()}
    assert cells == {(0, ("Fecha", "TC")), (0, ("26/06/2026", "9,95")), (0, ("x in ner", "after")), (0, ("in", "ner")), (1, ("1",)), (1, ("2",))}


def test_links_in_headings_images_and_broken_markup(spark):
    good = '<h2>Of <a href="/n/1?a=1&amp;b=2">A &lt;long&gt; title</a></h2><nav><a href=other>short</a></nav><meta property=og:image content="/i.png"><meta property="og:image:secure_url" content=" /s.png ">'
    broken = "<h2><a href='x'>never <i>ended <!-- <a href=no> <p><a href=y>second</h2></div></div><a <b>third</a>< notag <a>"
    pages, found = rows_of(spark, good, broken, "<h2><a href=javascript:void(0)>nothing to follow</a></h2>")
    within = [(r.page_id, r.title, r.link) for r in html.links(found, pages, "h1|h2|h3", 6).orderBy("page_id", "place").collect()]
    assert (0, "A <long> title", "https://site.example/n/1?a=1&b=2") in within and not any("short" in w[1] for w in within)
    assert [r.image for r in html.page_image(found, pages).collect()] == ["https://site.example/s.png"]
    assert found.where("page_id = 1 AND tag = 'a'").count() >= 1


def test_any_text_is_read_to_its_end():
    for seed in range(2000):
        rng = random.Random(seed)
        markup = "".join(rng.choice(["<", ">", "/", "!", "-", "=", '"', "'", " ", "a", "p", "td", "&amp", "script", "?"]) for _ in range(rng.randint(0, 30)))
        html.tree(markup, frozenset(html.WANTED))
