"""Plain markup is read by one pattern, and as the standard parser reads it."""

import random
from html.parser import HTMLParser

import pytest

from eventloom.operators import facts, html, pages


class Standard(html.Page):
    """The standard parser from the first character on."""

    def _read_plain(self, text):
        return 0 if text else len(text)


FIELDS = ("tags", "attrs", "parent", "past", "hidden", "first_text", "past_text", "texts", "owner", "places")
PIECES = (
    "<div>", "</div>", '<p class="a b">', "</p>", "<br/>", "<br />", "<img alt='x' src=\"a&amp;b\">", "<script>", "</script>", "</ SCRIPT\n>", "<style>a<b</style>", "<script/>", "text", "a&amp;b", "&lt", "&", "<", ">", "</", "<!--", "-->",
    "-- >", "<!doctype html>", "<!DOCTYPE", "<?pi?>", "<![CDATA[x]]>", "\xa0", "\x0b", " ", "\n", "=", '"', "'", "/", "<a href=x/>", "<a b c=d>", "<a\x0bb=c>", "<a b = c>", '<a b="c"d="e">', "<A HREF='Q'>", "</A>", "<a b=1 B=2>", '<a b="">',
    "<a b=x\xa0>", "</a x>", "<h1", "<aé>", "<li>", "</li>", "</br>", "<svg><path/></svg>", "<a b==c>", '<a b=c"d>', "<a/b=c>", "<a b=/c>", "<a x\x00y>", "<a b='<p>'>", "<x:y-z.w>", "</x:y-z.w>", "&notin;", "&#0;",
)


def read(kind, text):
    page = kind()
    page.read(text)
    return [getattr(page, f) for f in FIELDS] + [[list(a.items()) for a in page.attrs]]


def test_any_markup_is_read_as_the_standard_parser_reads_it():
    draw = random.Random(11)
    for _ in range(20_000):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randint(0, 9)))
        try:
            want = read(Standard, text)
        except AssertionError:  # the standard parser gives up on some declarations
            continue
        assert read(html.Page, text) == want, text


def test_plain_pages_need_no_standard_parser(monkeypatch):
    """It took most of the time of every query over pages."""

    def refused(*_):
        raise RuntimeError("the standard parser was called")

    monkeypatch.setattr(HTMLParser, "feed", refused)
    page = html.parsed('<!DOCTYPE html><body><!-- x --><script type="application/ld+json">{"a": "<b>"}</script><a class=c href=\'/q?a=1&amp;b=2\' hidden>A &amp; B</a><br/>end')
    assert page.tags == ["body", "script", "a", "br"] and page.attrs[2] == {"class": "c", "href": "/q?a=1&b=2", "hidden": ""} and page.texts == ['{"a": "<b>"}', "A & B", "end"]
    with pytest.raises(RuntimeError):
        html.parsed("<p>1 < 2</p>")


def test_elements_are_marked_once_for_all_kinds_of_companies(monkeypatch):
    made = []
    monkeypatch.setattr(facts, "Frames", lambda page, make=facts.Frames: made.append(page) or make(page))
    page = html.parsed('<section class="sponsors-list"><h2>Sponsors</h2><div class="sponsor"><h3>Acme Works</h3></div></section><div class="exhibitor-list"><div class="exhibitor"><h3>Fjord Ltd</h3></div></div>')
    assert [e["name"] for e in facts.entities(page, "https://h.org/", facts.SPONSOR_WORDS)] == ["Acme Works"]
    assert [e["name"] for e in facts.entities(page, "https://h.org/", facts.EXHIBITOR_WORDS)] == ["Fjord Ltd"] and len(made) == 1


@pytest.mark.parametrize("base", ["https://a.b", "http://a.b/c/d", "https://a.b/c/", "https://A.b", "https://a.b/c?q=1", "", "x"])
@pytest.mark.parametrize("href", ["/q", "/q?x=1#f", "#f", "#", "//z/y", "/q/../r", "/a//b", "https://a.b", "http://c.d/e?x", "/a;b", "/a?", "e", ""])
def test_plain_references_resolve_as_any_other(base, href):
    from urllib.parse import urljoin

    assert html.resolved(base, href) == urljoin(base, href)


def test_cut_references_stay_where_only_closed_ones_count(spark):
    """The query's SQL knows references by their semicolon; titles of some pages end in the middle of one."""
    frame = spark.createDataFrame([(1, "<title>a&&& b&amp</title><p>c &amp; d &copy;&copy &unknown; &#65;&#65 &</p>")], "page_id long, html string")
    assert pages.page_text(frame).first()["text"] == "a&&& b&\nc & d \u00a9\u00a9 &unknown; AA &"
    assert pages.page_text(frame, open_references=False).first()["text"] == "a&&& b&amp\nc & d \u00a9&copy &unknown; A&#65 &"


def test_page_text_gives_what_its_sql_gives(spark):
    import duckdb

    import __spark_entry__

    d = "/root/testdata/sf0.1"
    with duckdb.connect() as db:
        db.execute(f"create view pages as select * from '{d}/pages.parquet'")
        want = dict(db.execute(__spark_entry__.oracle_sql()["page_text"]).fetchall())
    assert {r["page_id"]: r["text"] for r in __spark_entry__.queries()["page_text"](spark, d).collect()} == want


def test_strip_takes_unicode_white_space_without_a_pattern(spark):
    """The same characters as the pattern that it was."""
    from pyspark.sql import functions as F

    from eventloom.functions.urls import strip

    points = [k for k in range(1, 0x10000) if not 0xD800 <= k < 0xE000]
    rows = spark.createDataFrame([(chr(k) + "a" + chr(k) + "b" + chr(k) * 2,) for k in points] + [(" \n\t",), ("",), (None,), ("a \r\n",), (" a\x85\n",)], "x string")
    got, was = strip(F.col("x")), F.regexp_replace("x", r"(?U)^\s+|\s+$", "")
    assert rows.filter(~got.eqNullSafe(was)).count() == 0
    assert "regexp" not in rows.select(got)._jdf.queryExecution().optimizedPlan().toString()
