"""Queries read every event, and what a page gives is read in its one parse."""

import random

from pyspark.sql import functions as F

from eventloom.functions import text
from eventloom.jobs import event_pages as ep
from eventloom.jobs import registry
from eventloom.operators import enrich, event_page, facts, html


def test_every_event_is_dispatched(spark, sf):
    """Directory pages that name their organization were left out."""
    import __spark_entry__

    got = {r["k"]: r for r in __spark_entry__.queries()["listing_dispatch"](spark, sf).collect()}
    events = {r["k"]: r["host"] for r in ep.events(spark, sf).select("k", "host").collect()}
    assert got.keys() == events.keys()
    named = lambda k: None if k % 3 == 2 else "Conference Index" if k % 12 == 0 else events[k]
    assert all(r["group_name"] == named(k) and r["none"] == (k % 3 == 2) for k, r in got.items())
    assert " where " not in registry.oracle_sql()["listing_dispatch"].rsplit(" as none ", 1)[1]


SAID = (
    "Panelists: ", "panelist:", "Panelist", " at ", " AT ", "\tat  ", " — ", " - ", "-", ", ", ";", "•", "\n", "\n", " ", "  ", "\xa0", "\x1f", "\u2003", "Dr. Ann", "Prof. Bo", "keynote", "Speaker", "speakers", "presenter: ", "Lunch", "lunchbox",
    "Coffee break", "location:", " Location:", ". Description:", "12", "9am", "a:", ":", "logo", " logo", "Home", "contact us", "faculty", "Sign-in", "é", "İ", "x", "Ann Lee", "one two three four five six seven", "y" * 30, "_", "CEO", "٣",
)


def test_speakers_are_read_in_the_parse_as_the_expression_reads_them(spark):
    """Working them out of a page's lines by expressions was most of the time of a page."""
    draw = random.Random(3)
    texts = [html.visible_text(html.parsed("".join(draw.choice(SAID) for _ in range(draw.randint(0, 18))))) for _ in range(1500)]
    made = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", text.speakers_from_text(F.col("t")).alias("s"), text.is_junk_speaker_name(F.col("t")).alias("junk"))
    for r in made.collect():
        own = facts.said_speakers(texts[r["i"]]).values()
        assert [tuple(x) for x in r["s"]] == [(x["name"], x["title"], x["company"], x["details"]) for x in own], texts[r["i"]]
        assert r["junk"] == facts.is_junk_speaker(texts[r["i"]])


def test_speakers_of_text_and_cards(spark):
    page = "<section><h2>Speakers</h2><div><h3>Ann Lee</h3><p>Chair</p><p>Acme</p></div><div><h3>Lunch</h3></div><div><h3>Dr. Bo<br>Ek</h3></div></section><p>Panelists: Ann Lee — CEO; Cy Roe at Fjord</p>"
    got = event_page.extract_speakers(spark.createDataFrame([(1, "https://h.org/", page), (2, None, None)], "k int, url string, html string"), ["k"]).collect()
    names = {r["k"]: [(x["name"], x["title"], x["company"]) for x in r["speakers"]] for r in got}
    assert names == {1: [("Speakers", None, None), ("Ann Lee", None, None), ("Chair", None, None), ("Acme", None, None), ("Dr. Bo", None, None), ("Ek", None, None), ("Cy Roe", None, "Fjord"), ("Dr. Bo Ek", None, None)], 2: []}


def test_an_events_pages_are_collected_once(spark):
    """An aggregate for each field and its provenance took most of the time of a record."""
    made = (F.lit(None).cast("string").alias(f) for f in event_page.RECORD if f not in ("event_name", "city"))
    told = lambda *of: {f: {"source": s, "page_url": None, "page_role": None, "snippet": n} for f, s, n in of}
    rows = [
        (1, "sponsors", 4, "Late", "Oslo", ["b"], told(("event_name", "json_ld", "late"), ("city", "meta", "late"), ("zip_code", "regex", "late"))),
        (1, "main", 2, "", "Bergen", ["a"], told(("event_name", "json_ld", "main"), ("city", "json_ld", "main"))), (1, "x", None, None, None, [], None), (2, "main", 2, None, None, [], {}),
    ]
    kinds = "event_id int, role string, role_rank int, event_name string, city string, names array<string>, provenance map<string,struct<source:string,page_url:string,page_role:string,snippet:string>>"
    entity = F.transform("names", lambda n: F.struct(n.alias("name"), F.lit(None).cast("string").alias("website"), F.lit(None).cast("string").alias("details")))
    found = spark.createDataFrame(rows, kinds).select("*", *made, F.concat(F.lit("on "), "role").alias("text"), *[entity.alias(f) for f in event_page.LISTS]).drop("names")
    out = enrich.merge_pages(found)
    got = {r["event_id"]: r for r in out.collect()}
    assert (got[1]["event_name"], got[1]["city"], got[1]["zip_code"], got[1]["roles"]) == ("Late", "Bergen", None, "x, main, sponsors")
    assert [x["name"] for x in got[1]["sponsors"]] == ["a", "b"] and got[1]["combined_text"] == "--- x ---\non x\n\n--- main ---\non main\n\n--- sponsors ---\non sponsors"
    assert {f: p["snippet"] for f, p in got[1]["provenance"].items()} == {"event_name": "late", "city": "main", "zip_code": "late"}
    assert got[2]["provenance"] == {} and got[2]["event_name"] is None and got[1]["fetch_notes"] == ["x_fetch: ", "main_fetch: ", "sponsors_fetch: "]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(") == 1 and "min_by" not in plan and "max_by" not in plan
