import tempfile

from pyspark.sql import functions as F

from adlens.functions import html as H
from adlens.functions import markup as M
from adlens.operators import extract as E
from adlens.sources.reports import parse_blocks


def pages(spark, *htmls):
    return spark.createDataFrame([(i, f"https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/p{i}.html", h) for i, h in enumerate(htmls)],
                                 "page_id bigint, url string, html string")


def test_links_one_many_duplicate_none(spark):
    df = pages(spark,
               '<a href="/msg/lv/a.html">x</a>',
               '<a href="/msg/lv/a.html">x</a><a class="n" href="/msg/lv/b.html">y</a><a href="/about">z</a>',
               '<a href="/msg/lv/b.html"></a><a href="/msg/lv/a.html"></a><a href="/msg/lv/b.html"></a>',
               '<p>no links</p>')
    got = {}
    for r in E.page_links(df).collect():
        got.setdefault(r["page_id"], []).append((r["link_pos"], r["url"]))
    assert got[0] == [(1, "https://ss.lv/msg/lv/a.html")]
    assert got[1] == [(1, "https://ss.lv/msg/lv/a.html"), (2, "https://ss.lv/msg/lv/b.html")]
    assert got[2] == [(1, "https://ss.lv/msg/lv/b.html"), (2, "https://ss.lv/msg/lv/a.html")]  # first occurrence order
    assert 3 not in got
    d = {r["url"]: r["n_pages"] for r in E.distinct_links(df).collect()}
    assert d == {"https://ss.lv/msg/lv/a.html": 3, "https://ss.lv/msg/lv/b.html": 2}


AD_PAGE = """<html><body><table id="other"><td class="ads_opt">ignored</td></table>
<table id="page_main">
<tr><td class="ads_opt_name">Pilsēta:</td><td class="ads_opt" id="opt_city"><b>Ezerpils</b></td></tr>
<tr><td class="ads_opt_name">Iela:</td><td class="ads_opt"><b>Egļu laukums 9</b></td></tr>
<tr><td class="ads_opt_name">Istabas:</td><td class="ads_opt">5</td></tr>
<tr><td class="ads_opt_name">Platība:</td><td class="ads_opt">118 m²</td></tr>
<tr><td class="ads_opt_name">Stāvs:</td><td class="ads_opt">6/8/lifts</td></tr>
<tr><td class="ads_opt_name">Karte:</td></tr>
<tr><td class="ads_price" id="tdo_8">149 860 € (1 270 €/m²)\t</td></tr>
<tr><td class="msg_footer">Reklāma</td><td class="msg_footer">Skatījumi</td><td class="msg_footer">Datums: 14.06.2024 10:11</td></tr>
</table><span id="price_note">cena <b>ar</b> PVN</span></body></html>"""


def test_cells_by_class_token(spark):
    df = pages(spark, AD_PAGE)
    row = df.select(H.cells("html", "td", "ads_opt", scoped=True).alias("v"),
                    H.cells("html", "td", "ads_opt_name", scoped=True).alias("n"),
                    H.cells("html", "td", "ads_price").alias("p")).first()
    assert row["v"][0] == "<b>Ezerpils"                      # cut at the first '</' (Q3)
    assert len(row["v"]) == 5 and len(row["n"]) == 6     # 'ads_opt' does not hit 'ads_opt_name'
    assert row["p"] == ["149 860 € (1 270 €/m²)"]        # TAB removed (H6)
    assert df.select(H.span_text("html", "price_note")).first()[0] == "cena ar PVN"


def test_ad_page_to_report_block(spark):
    df = pages(spark, AD_PAGE, AD_PAGE.replace("ads_price", "ads_nothing"))
    blocks, quarantine = E.ad_pages_to_blocks(df)
    rows = blocks.collect()
    assert len(rows) == 1
    assert rows[0]["block"].splitlines() == [
        "https://ss.lv/msg/lv/real-estate/flats/testa-nov/ezerpils/p0.html", "Pilsēta:><b>Ezerpils", "Iela:><b>Egļu laukums 9", "Istabas:>5",
        "Platība:>118 m²", "Stāvs:>6/8/lifts", "Price:>149 860 € (1 270 €/m²)", "Date:>14.06.2024"]
    assert [r["reason"] for r in quarantine.collect()] == ["no_price"]
    parsed = parse_blocks(blocks.select("block", F.lit("p").alias("source_file"), F.lit(None).cast("date").alias("run_date")))
    clean, q = E.clean_formatted(E.blocks_to_formatted(parsed)[0], run_date="2024-06-15")
    c = clean.first()
    assert (c["room_count"], c["price_eur"], c["street"], c["has_lift"]) == (5, 149860, "Egļu laukums 9", True)


def test_ad_pages_are_read_once(spark):
    """Whatever is asked of the pages, each is cut into tokens once."""
    pages(spark, AD_PAGE, None).write.mode("overwrite").parquet(path := tempfile.mkdtemp(prefix="adlens-test-", dir="/tmp"))
    stored = spark.read.parquet(path)
    for df in E.ad_pages_to_blocks(stored):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("(?:script|style)\\b") == 1
    assert [r["reason"] for r in E.ad_pages_to_blocks(stored)[1].collect()] == ["no_price"]


def test_cells_up_to_the_first_end_tag(spark):
    page = '<td class="c">a<b>b</b></td><td class="c">&lt;d<td class="c">e</td><td class="c">f<td class="c"></td><td class="c">g'
    got = spark.createDataFrame([(page,), (None,)], "html string").select(M.cells(M.tokens("html"), "td", "c")).collect()
    assert [r[0] for r in got] == [["a<b>b", '<d<td class="c">e', "e", 'f<td class="c">', "", "g"], None]


def test_zip_options_and_footer(spark):
    df = spark.createDataFrame([(["a:", "b:", "last:"], ["1", "2"], ["x", "y", "Datums: 03.04.2024 12:00"])],
                               "n array<string>, v array<string>, f array<string>")
    r = df.select(H.zip_options("n", "v").alias("z"), H.footer_date("f").alias("d")).first()
    assert [(p["name"], p["value"]) for p in r["z"]] == [("a:", "1"), ("b:", "2")]
    assert r["d"] == "03.04.2024"
    short = spark.createDataFrame([(["x"],)], "f array<string>")
    assert short.select(H.footer_date("f")).first()[0] is None   # Q4: no third cell -> NULL, not the previous ad's date


def test_links_as_an_attribute_parser_sees_them(spark):
    df = pages(spark,
               "<a data-href=\"/msg/wrong\" href='/msg/right'>x</a>",
               '<a href="/msg/y" data-href="/msg/z">x</a>',
               "<A HREF='/msg/a?b=1&amp;c=2' class=x>x</A><a class='k' id=q href=/msg/bare>y</a>",
               "<a href='/msg/one'>x</a><a href='/msg/one'>x</a><a href=\"/msg/two\">y</a>",
               "<abbr href='/msg/no'>x</abbr><a title='href=\"/msg/no\"' name='n'>z</a>",
               "<a\n  href = \"/msg/spaced\">x</a>")
    got = {r["page_id"]: r["l"] for r in df.select("page_id", H.links("html").alias("l")).collect()}
    assert got == {0: ["/msg/right"], 1: ["/msg/y"], 2: ["/msg/a?b=1&c=2", "/msg/bare"],
                   3: ["/msg/one", "/msg/one", "/msg/two"], 4: [], 5: ["/msg/spaced"]}


def test_cells_and_span_in_any_quotes(spark):
    page = ("<table id='page_main'><tr><td data-class='ads_price' class='x'>no</td><TD class='a ads_price b'>1 €</TD></tr>"
            "<tr><td><table><tr><td class=ads_price>2 €</td></tr></table></td></tr>"
            "<tr><td class=\"ads_price\">3 €</td></tr></table>"
            "<table><tr><td class='ads_price'>9 €</td></tr></table><span data-id='note' id='other'>no</span><SPAN class='c' id='note'>a <b>b</b></SPAN>")
    row = pages(spark, page).select(H.cells("html", "td", "ads_price", scoped=True).alias("p"),
                                    H.cells("html", "td", "ads_price").alias("all"),
                                    H.span_text("html", "note").alias("s")).first()
    assert row["p"] == ["1 €", "2 €", "3 €"]     # the table after the main one is out of scope
    assert row["all"] == ["1 €", "2 €", "3 €", "9 €"]
    assert row["s"] == "a b"
