"""Markup read tag by tag, held against the standard library's parser."""

from html.parser import HTMLParser

from pyspark.sql import functions as F

from adlens.functions import markup as M

VOID = {"br", "img", "hr", "input"}


class Plain(HTMLParser):
    """Links, first-end-tag cells and the text of a span, by parser events."""

    def __init__(self, page, span_id, cls):
        super().__init__(convert_charrefs=True)
        self.links, self.cells, self.span, self.depth, self.open, self.skip = [], [], None, 0, [], 0
        self.span_id, self.cls = span_id, cls
        self.feed(page)
        self.close()
        self.cells += self.open

    def handle_starttag(self, tag, attrs, closed=False):
        attrs = dict(reversed(attrs))
        if tag in ("script", "style"):
            self.skip += 1
        self.open = [c + self.get_starttag_text() for c in self.open]
        if tag == "a" and attrs.get("href") is not None:
            self.links.append(attrs["href"])
        if tag == "span" and not closed:
            if self.depth:
                self.depth += 1
            elif self.span is None and attrs.get("id") == self.span_id:
                self.span, self.depth = "", 1
        if tag == "td" and self.cls in (attrs.get("class") or "").split():
            self.open.append("")

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs, True)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip -= 1
            return
        if tag == "span" and self.depth:
            self.depth -= 1
        self.cells, self.open = self.cells + self.open, []

    def handle_data(self, data):
        if self.skip:
            return
        if self.depth:
            self.span += data
        self.open = [c + data for c in self.open]


PAGES = [
    "<a href='/msg/1'>x</a><!-- <a href='/msg/2'>y</a> --><script>var s = \"<a href='/msg/3'></a>\";</script><a title='<a href=\"/msg/4\">' href=/msg/5>z</a>",
    "<span id='note'>a <span>b</span> c <b>d</b></span><span>e</span>",
    "<span class=x id=note>one<span id=\"note\">two</span>three</span> four",
    "<span id='note'>never closed <i>at all",
    "<span id='note'>self <span/> closed</span> after",
    "<span id=\"note\">&#8364; &#x20AC; &amp;lt; &lt;b&gt; &nbsp;&unknown; &#0; &#xD800; AT&T</span>",
    "<span id='note'>a<!-- </span> -->b<style>c</style>d</span>",
    "<table><td class='k'>plain</td><td class=\"x k\">a <b>b</b> c</td><td class='kk'>no</td><!--<td class='k'>no</td>--></table>",
    "<td class='k' title='a > b'>quoted &quot;x&quot;</td><TD CLASS=k>bare</TD><td class='k'>open",
    "<a>none</a><A HREF='/msg/6?a=1&amp;b=2'>x</A><a href>y</a><abbr href='/msg/7'>no</abbr><a\nhref = \"/msg/8\">z</a>",
    "", "no markup < at all > here", "<!-- never closed <a href='/msg/9'>", "<script>never closed <a href='/msg/9'>",
]


def test_pages_as_the_parser_reads_them(spark):
    df = spark.createDataFrame(list(enumerate([*PAGES, None])), "i int, html string").select("i", M.tokens("html").alias("t"))
    rows = df.select("i", M.links("t").alias("links"), M.cells("t", "td", "k").alias("cells"), M.span_text("t", "note").alias("span")).orderBy("i").collect()
    for r, page in zip(rows, PAGES):
        want = Plain(page, "note", "k")
        assert r["links"] == [x for x in want.links if x != ""], page
        assert r["cells"] == want.cells, page
        if "&#0" not in page:
            assert r["span"] == want.span, page
    assert rows[5]["span"] == "€ € &lt; <b> \u00a0&unknown; \ufffd \ufffd AT&T"
    assert rows[-1]["links"] is None and rows[-1]["span"] is None


def test_elements_nest(spark):
    page = "<table id='page_main'><tr><td>a</td><td><table><td>b</td></table></td></tr></table><table><td>c</td></table>"
    got = spark.createDataFrame([(page,), ("<p>none</p>",)], "html string").select(M.tokens("html").alias("t")).select(
        F.array_join(M.element("t", "table", "id", "page_main"), "").alias("inner")).collect()
    assert [r["inner"] for r in got] == ["<tr><td>a</td><td><table><td>b</td></table></td></tr>", None]


def test_a_long_page(spark):
    page = "<span id='note'>" + "<span>x</span>" * 4000 + "</span>tail" + "<a href='/msg/1' title='" + "y" * 200_000 + "'>z</a>"
    row = spark.createDataFrame([(page,)], "html string").select(M.tokens("html").alias("t")).select(
        M.span_text("t", "note").alias("s"), M.links("t").alias("l")).first()
    assert row["s"] == "x" * 4000 and row["l"] == ["/msg/1"]
