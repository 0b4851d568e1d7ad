import pytest
from pyspark.sql import functions as F

from eventloom.functions import taxonomy, text, urls


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        (" HTTPS://WWW.Example.COM/A/b//?q=1#x ", "https://www.example.com/A/b"),
        ("http://h.com", "http://h.com/"),
        ("http://h.com/a;v=1", "http://h.com/a"),
        ("", ""),
        (None, ""),
        ("/a/b/", "/a/b"),
    ],
)
def test_canonical_url(spark, url, expected):
    assert one(spark, urls.canonical_url(F.col("u")), u=url) == expected


@pytest.mark.parametrize(
    ("url", "expected"),
    [
        ("https://a.com/event/x", True),
        ("https://a.com/events/create", False),
        ("https://a.com/conferences/event", False),
        ("/event/x", False),
        ("https://a.com/search/event/x", False),
    ],
)
def test_is_event_detail_url(spark, url, expected):
    assert one(spark, urls.is_event_detail_url(F.col("u")), u=url) is expected


def test_hosts(spark):
    assert one(spark, urls.bare_host(F.col("u"), compat=True), u="https://wework.com/") == "ework.com"
    assert one(spark, urls.bare_host(F.col("u")), u="https://www.wework.com/") == "wework.com"
    assert one(spark, urls.is_blocked_url(F.col("u")), u="https://de.linkedin.com/x") is True
    assert one(spark, urls.is_blocked_url(F.col("u")), u="https://notx.community/x") is False
    assert one(spark, urls.domain_from_url(F.col("u")), u=None) is None


@pytest.mark.parametrize(
    ("said", "expected"),
    [
        ("2026-05-02 to 2026/05/01", ("2026-05-01", "2026-05-02")),
        ("on March 3, 2026", ("2026-03-03", "2026-03-03")),
        ("Apr 3-5, 2026", ("2026-04-03", "2026-04-05")),
        ("Foo 3, 2026", (None, None)),
        (None, (None, None)),
    ],
)
def test_extract_dates(spark, said, expected):
    assert tuple(one(spark, text.extract_dates(F.col("t")), t=said)) == expected


def test_quirks(spark):
    assert one(spark, text.normalize_for_match(F.col("t")), t=" A  b ") == "a b"
    assert one(spark, text.snippet_in_text(F.col("s"), F.col("t"), 4), s="Ann", t="ann") is False  # names under four characters never count
    assert one(spark, text.program_not_published(F.col("t")), t="xtba") is True
    long = one(spark, text.methodology_description(F.col("t")), t="x" * 501)
    assert len(long) == 500 and long.endswith("...")
    assert one(spark, taxonomy.map_industry(F.col("t")), t="Exponent of fintech").code == "TECH"
    assert one(spark, text.parse_speaker_candidate(F.col("t")), t="Dr. Ann Lee — Chief").asDict() == {"name": "Dr. Ann Lee", "title": "Chief", "company": None, "details": "Dr. Ann Lee — Chief"}
