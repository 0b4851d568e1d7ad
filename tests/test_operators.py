import os
import random
import re
import time
from urllib.parse import urljoin

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from eventloom.jobs import registry
from eventloom.functions import taxonomy, text, urls
from eventloom.operators import blocking, coverage, enrich, event_page, facts, html, merge, pages, resolve, rules, support
from eventloom.sources import files

TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark conversations".split()


def test_entry_has_rows(spark):
    assert __spark_entry__.entry(spark).count() > 0


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    """A fiftieth of the orders and all else: every query runs over it, and its SQL reads the same files."""
    given, folder = "/root/testdata/sf0.001", tmp_path_factory.mktemp("tables")
    con = duckdb.connect()
    for t in TABLES:
        some = {"orders": "where o_orderkey % 50 = 1", "lineitem": "where l_orderkey % 50 = 1"}.get(t, "")
        con.sql(f"copy (select * from '{given}/{t}.parquet' {some}) to '{folder}/{t}.parquet'")
    return str(folder)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, small, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{small}/{t}.parquet'")
    sf = small
    ours, theirs = registry.queries()[name](spark, sf).toPandas(), con.sql(registry.oracle_sql()[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    rows = lambda frame: sorted(repr([None if v is None or v != v else round(float(v), 6) if isinstance(v, (int, float)) else str(v) for v in r]) for r in frame[columns].astype(object).itertuples(index=False))
    assert rows(ours) == rows(theirs)


def test_value_and_provenance_may_differ(spark):
    """The first non-empty value stays, while the most trusted source is named, of equals the last."""
    facts = spark.createDataFrame([(1, 0, "name", "a", "llm"), (1, 1, "name", "b", "meta"), (1, 2, "name", "c", "meta")], "e int, r int, field string, v string, source string")
    assert facts.groupBy("e").agg(merge.first_nonempty("v", "r")).first()["v"] == "a"
    assert merge.merge_provenance(facts, "e", "r", ["source", "v"]).first()["v"] == "c"


def test_coverage_counts_white_space_as_missing(spark):
    row = spark.createDataFrame([(" ",)], "city string")
    others = {f: (F.array().cast("array<string>") if f in coverage.LISTS else F.lit(None).cast("string")) for f in coverage.FIELDS if f != "city"}
    got = coverage.field_coverage(row.withColumns(others)).first()
    assert (got["filled_count"], got["total_count"], got["data_completeness"]) == (0, 27, "minimal")


def test_ties_go_to_the_first_hit(spark):
    events = spark.createDataFrame([(1, "Data Summit", None, None, None), (2, "", None, None, None), (3, "Lone Event", None, None, None)], "event_id int, event_name string, city string, country string, organizer string")
    hits = spark.createDataFrame([(1, 1, "https://a.org/", "Data Summit", ""), (1, 0, "https://b.org/", "Data Summit", ""), (2, 0, "https://b.org/", "x", "")], "event_id int, hit_pos int, url string, title string, snippet string")
    got = {r["event_id"]: (r["official_url"], r["note"]) for r in resolve.resolve_official_url(events, hits).collect()}
    assert got == {1: ("https://b.org/", "picked"), 2: (None, "missing event name"), 3: (None, "no search results")}


def test_pages_survive_bad_markup(spark):
    rows = [(1, "http://h/", "<p>a<p>b</i><script>x</script><img alt=' pic '>"), (2, None, None), (3, "http://h/", "<a href='//['>x</a>")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.page_text(frame).collect()} == {1: "a\nb\npic", 2: "", 3: "x"}
    assert pages.page_links(frame).count() == 1
    assert pages.dom_elements(frame).filter("page_id = 1 and tag = 'p'").agg(F.max("parent_index")).first()[0] == 0  # an unclosed p nests


def test_saved_pages(spark, tmp_path):
    (tmp_path / "summit-1").mkdir()
    (tmp_path / "summit-1" / "main.html").write_bytes(b"<p>caf\xc3\xa9 \xff</p>")
    (tmp_path / "summit-1" / "notes.txt").write_text("no page")
    got = files.read_page_bundle(spark, str(tmp_path)).collect()
    assert [(r["event_id"], r["role"], r["html"]) for r in got] == [("summit-1", "main", "<p>café \ufffd</p>")]
    assert files.read_listing_pages(spark, str(tmp_path / "summit-1" / "main.html")).first()["html"] == got[0]["html"]


def test_event_lists_of_another_shape_are_refused(spark, tmp_path):
    (tmp_path / "whole.json").write_text('[{"name": "a"},\n {"name": "b"}]')
    assert files.read_event_list(spark, str(tmp_path / "whole.json"), multi_line=True).count() == 2
    (tmp_path / "bad.json").write_text("no json")
    with pytest.raises(ValueError):
        files.read_event_list(spark, str(tmp_path / "bad.json"))


def test_answers(spark):
    """Typed items of objects and plain names; what can't be read is kept apart with the reason."""
    said = '{"city": "Oslo", "speakers": [{"name": "A", "title": "T", "evidence_snippet": "A, T"}, "B", 7, null], "sponsor_companies": "no list"}'
    rows = [(1, f"```\n{said}\n```"), (2, None), (3, '"text"'), (4, "{"), (5, " "), (1, "zz"), (None, "{}")]
    good, rejected = files.read_answers(spark.createDataFrame(rows, "event_id long, raw string"))
    got = {r["event_id"]: r for r in good.collect()}
    assert set(got) == {1, None} and got[1]["city"] == "Oslo" and got[1]["sponsor_companies"] is None and got[None]["city"] is None
    assert [(x["name"], x["title"], x["evidence_snippet"], x["website"]) for x in got[1]["speakers"]] == [("A", "T", "A, T", None), ("B", None, None, None)]
    assert sorted((r["event_id"], r["reason"]) for r in rejected.collect()) == [(1, "not JSON"), (2, "no answer"), (3, "no object"), (4, "not JSON"), (5, "no answer")]


def test_answers_reach_the_records(spark):
    """What the pages support is taken from the answer, the rest is counted; directories' own pages take nothing."""
    said = '{"address_2": "Hall Nine East", "city": "Bergen", "attending_companies": [{"name": "Fjord Works", "website": "https://fjord.example/", "evidence_snippet": "meet Fjord Works"}, "Ghost Corporation"]}'
    none = {f: None for f in event_page.RECORD}
    seeds = spark.createDataFrame([tuple({**none, "event_url": u}.values()) + (k,) for k, u in ((1, "https://own.example/"), (2, "https://conferenceindex.org/event/x"))], ", ".join(f"{f} string" for f in none) + ", event_id long")
    pages = spark.createDataFrame([(k, "main", 0, "https://own.example/", "<h1>Expo</h1><p>Hall Nine East</p><p>Come and meet Fjord Works</p>") for k in (1, 2)], "event_id long, role string, role_rank int, url string, html string")
    answers, _ = files.read_answers(spark.createDataFrame([(1, said), (2, said)], "event_id long, raw string"))
    got = {r["event_id"]: r for r in enrich.parse_event_pages(seeds, pages, answers).collect()}
    assert (got[1]["address_2"], got[1]["city"], got[1]["validation"]["llm_stripped"], got[1]["validation"]["llm_merged_fields"]) == ("Hall Nine East", None, 2, 2)
    assert [(x["name"], x["website"]) for x in got[1]["attending_companies"]] == [("Fjord Works", "https://fjord.example/")]
    assert got[1]["field_provenance"]["address_2"]["source"] == "llm" and "llm: used (stripped 2 ungrounded)" in got[1]["enrich_notes"]
    assert got[2]["address_2"] is None and "llm: skipped (listing-only source)" in got[2]["enrich_notes"]


def test_job_parses_each_page_once(spark, monkeypatch):
    """Two parses in all, of other pages each; nothing but the records' table stays, and listings' links follow the event's URL."""
    site, listing = "https://expo.example/", "https://conferenceindex.org/event/expo-9"
    html = {"listing": "<h1>Grand Expo on 2026-05-04</h1><ul><li>Location: <strong>Oslo, Norway</strong></li></ul><a href='/event/expo-9/program'>Program</a><a href='sponsors.html'>Our sponsors</a>", "main": "<h1>Grand Expo</h1><a href='/exhibitor-list'>Exhibitors</a>"}
    rows = [(1, r, k, u, html[r], True, "ok") for k, (r, u) in enumerate((("listing", listing), ("main", site)))] + [(2, "main", 1, "https://x.example/", None, False, "timeout"), (9, "main", 1, "https://y.example/", "<p>other</p>", True, "ok")]
    pages = spark.createDataFrame(rows, "event_id long, role string, role_rank int, page_url string, html string, fetch_ok boolean, fetch_note string")
    items = spark.createDataFrame([(1, "Grand Expo", listing), (2, "Lone Summit", "https://lone.example/")], "event_id long, name string, event_url string")
    hits = spark.createDataFrame([(1, 0, site, "Grand Expo Oslo", "official site Oslo Norway")], "event_id long, hit_pos int, url string, title string, snippet string")
    plans, tables, real = [], [], enrich.staged

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        tables.append(real(df, name))
        return tables[-1]

    monkeypatch.setattr(enrich, "staged", watched)
    got = {r["event_id"]: r for r in enrich.enrich_events(items, pages, hits).collect()}
    assert set(got) == {1, 2} and [p.count("MapInArrow") for p in plans] == [0, 1, 0, 1, 0, 0]
    assert [os.path.exists(t._staged_at.removeprefix("file://")) for t in tables] == [False] * 5 + [True]
    one = got[1]
    assert (one["event_url"], one["start_date"], one["city"], one["listing_url"]) == (site, "2026-05-04", "Oslo", listing)
    assert one["exhibitor_crawler_url"] == "https://conferenceindex.org/event/expo-9/program" and one["enrich_notes"][-3:] == ["listing_fetch: ok", "main_fetch: ok", "pages_fetched: listing, main"]
    assert got[2]["enrich_notes"] == ["no pages fetched"] and got[2]["event_url"] == "https://lone.example/"


def test_bucketed_pages_stay_where_they_are(spark):
    """Events are shuffled to the pages' buckets; no exchange lies above the scan of the pages."""
    rows = [(k % 7, "main", f"https://h/{k}", f"<p>{k}</p>", True) for k in range(40)]
    files.write_page_table(spark.createDataFrame(rows, "event_id long, role string, page_url string, html string, fetch_ok boolean"), "page_buckets", 4)
    events = spark.range(7).selectExpr("id as event_id", "concat('https://e/', id) as event_url")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        read, bare = enrich.join_pages_to_events(events, spark.table("page_buckets"))
        plan = read._jdf.queryExecution().executedPlan().toString()
        assert read.count() == 40 and bare.count() == 0
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table page_buckets")
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" in plan


def test_references_resolve_like_the_standard_library(spark):
    rng = random.Random(1)
    bases = ["http://h", "http://h/", "https://www.h.org/a/b", "https://h/a/b/", "https://h/a//b/c.html?x=1#f", "http://h?q=1", "HTTP://H:80/x"]
    refs = {rng.choice(["", "", "/"]) + "/".join(rng.choice(["", "a", "b.html", "..", ".", "..."]) for _ in range(rng.randrange(6))) + rng.choice(["", "?", "?p=2", "?a=/b/../c"]) + rng.choice(["", "#", "#x"]) for _ in range(1500)}
    rows = [(b, h) for h in refs if not re.match("///|//([?#]|$)", h) for b in rng.sample(bases, 2)] + [("https://h/a", "//o.example/x?#"), ("", "x"), (None, "x"), ("mailto:a@b", "x")]
    for r in spark.createDataFrame(rows, "b string, h string").withColumn("r", urls.join_url(F.col("b"), F.col("h"))).collect():
        assert r["r"] == (urljoin(r["b"], r["h"]) if r["b"] and r["b"] != "mailto:a@b" else r["h"]), r


def test_manifest_has_notes(spark, tmp_path):
    pages = spark.createDataFrame([(1, "main", "u", "h", "ok"), (1, "listing", "v", "h", None), (2, "main", "w", "h", "")], "event_id long, role string, page_url string, html string, fetch_note string")
    files.write_page_bundle(pages, str(tmp_path / "bundle"))
    assert {r["event_id"]: r["notes"] for r in spark.read.parquet(str(tmp_path / "bundle/manifest")).collect()} == {1: ["main_fetch: ok"], 2: []}


def test_an_empty_side_gets_all_rows(spark):
    frame = spark.createDataFrame([(1, True), (2, True)], "k int, needs_review boolean")
    assert [x.count() for x in files.split_by_confidence(frame)] == [2, 2]


RULES = {"scalar": (support.scalar_ways, text.scalar_in_text), "snippet": (support.snippet_ways, text.snippet_in_text)}


@pytest.mark.parametrize("rule", RULES)
def test_supported_pairs_are_those_of_all_pairs(spark, rule):
    """Needles that begin or end inside words, of one character, longer than 40, without a word; texts that hold them, nearly or not."""
    rng = random.Random(7)
    words = ["expo", "exposition", "berlin", "ber", "in", "a", "co-op", "caf\u00e9", "x" * 50, "data", "metadata", "the", "week", "wee", "7", "\u00df", "..."]
    said = [" ".join(rng.choices(words, k=n)) for n in range(1, 12) for _ in range(6)]
    cuts = [t[a:b] for t in said[20:] for a, b in [sorted(rng.sample(range(len(t) + 1), 2))]]
    items = spark.createDataFrame([(k, t) for k, t in enumerate([*said, *cuts, "", None, "  ", "Data  WEEK", "a", "\u00a0expo\u2003week"])], "item_id int, text string")
    items = items.unionByName(items.filter("item_id = 3")).unionByName(spark.createDataFrame([(3, "other words of it")], "item_id int, text string"))
    docs = spark.createDataFrame([(k, " ".join(rng.choices(words, k=rng.randrange(40))) + rng.choice(["", "\n", " Data\tweek"])) for k in range(60)] + [(100, None), (101, ""), (102, "\n".join(said[:30]))], "doc_id int, text string")
    ways, column = RULES[rule]
    found = sorted(map(tuple, support.supported_pairs(docs, items, ways).collect()))
    every = docs.withColumnRenamed("text", "body").crossJoin(items).filter(column(F.col("text"), F.col("body"))).select("doc_id", "item_id").distinct()
    assert found == sorted(map(tuple, every.collect())) and len(found) > 100


def test_supported_pairs_of_empty_tables(spark):
    none, one = spark.createDataFrame([], "doc_id int, item_id int, text string"), spark.createDataFrame([(1, 2, "data week")], "doc_id int, item_id int, text string")
    for docs, items in ((none, one), (one, none), (none, none)):
        assert support.supported_pairs(docs, items, support.scalar_ways).count() == 0
    assert support.supported_pairs(one, one, support.scalar_ways).collect() == [(1, 2)]


def test_blocked_hosts_of_a_long_list(spark, small):
    """The join agrees with the pattern on the hosts that both know; 100,000 listed hosts more, rows and columns come out as they were."""
    own = spark.createDataFrame([(k, u, "h", False) for k, u in enumerate(["https://a.b.linkedin.com/x", "https://notlinkedin.com/", "https://www.linkedin.com", "https://h77.example/", "https://x.y.h77.example/", "https://h77.example.org/", "", None, "https://z.org/paper.pdf", "https://z.org/", "https://z.org/", "https://" + "a." * 500 + "org/"])], "k int, url string, _host string, _by_path boolean")
    listed = blocking.default_hosts(spark).unionByName(spark.range(100_000).select(F.format_string("h%d.example", "id").alias("host")))
    got = blocking.drop_blocked(own, listed)
    assert got.columns == own.columns and sorted(r["k"] for r in got.collect()) == [1, 5, 9, 10, 11]
    given = spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url").unionByName(own.select(F.col("k").cast("long").alias("page_id"), "url"))
    by_pattern = given.filter(~urls.is_blocked_url(F.col("url")))
    assert sorted(map(tuple, blocking.drop_blocked(given, blocking.default_hosts(spark)).collect())) == sorted(map(tuple, by_pattern.collect()))
    assert blocking.drop_blocked(own, listed.limit(0)).count() == 9


def test_nested_cards_in_linear_time():
    """Cards that nobody closes hold all later ones: four times as many take about four times as long, not sixteen times."""

    def seconds(n):
        said = "".join(f'<div class="partner-card"><h3>Firm {k}</h3><p>of {k}</p><a href="https://f{k}.org/">site</a></b>' for k in range(n))
        page, began = html.parsed(f'<section class="sponsors-list"><h2>Sponsors</h2>{said}'), time.process_time()
        found = facts.entities(page, "https://h.org/", facts.SPONSOR_WORDS)
        spent = time.process_time() - began
        assert len(found) == facts.MAX_ENTITIES and found[1] == {"name": "Firm 1", "website": "https://f1.org/", "details": "of 1"}
        return spent

    assert min(seconds(20_000) for _ in range(2)) < 9 * max(seconds(5000), 0.05)


def _first_rule(said, table):
    held = [(rank, code, label) for rank, code, label, word in table if word is not None and word.lower() in (said or "").lower()]
    return min(held)[1:] if held else (None, None)


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_rules_of_a_table(spark, sent):
    """Sent to the tasks or joined, 10,000 rules give what a plain loop gives; empty and null substrings, equal ranks, null texts."""
    rng = random.Random(3)
    letters = lambda n: "".join(rng.choices("abcd \u00e9", k=n))
    table = [(k, f"c{k}", f"Label {k}", letters(rng.randrange(4, 9)).strip() or "abab") for k in range(10_000)]
    table += [(5, "c0", "less", "zz Z"), (7, "c7", None, None), (3, "c3", "Label 3", "\ttab")]
    texts = [(k, letters(rng.randrange(60))) for k in range(150)] + [(200, None), (201, ""), (202, "Zz z\ttab"), (203, "q")]
    docs = spark.createDataFrame(texts, "doc_id int, text string")
    columns = "rank long, code string, label string, substring string"
    named = {}
    for rank, code, label, _ in table:
        named[rank] = min(named.get(rank, (code, label)), (code, label), key=lambda x: (x[0], x[1] or ""))
    table = [(rank, *named[rank], word) for rank, _, _, word in table]
    for more in ([], [(9_000, *named[9_000], "")]):
        got = {r["doc_id"]: (r["code"], r["label"]) for r in rules.match_rules(docs, spark.createDataFrame([*table, *more], columns), "doc_id", sent_chars=sent).collect()}
        assert got == {k: _first_rule(t, [*table, *more]) for k, t in texts}
    assert [tuple(r) for r in rules.match_rules(docs.limit(1), spark.createDataFrame([], columns), "doc_id", sent_chars=sent).collect()] == [(0, None, None)]


def test_rule_table_agrees_with_the_expression(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", F.concat("text", F.element_at(F.array(*[F.lit(w[0]) for _, _, w in taxonomy.INDUSTRIES]), (F.col("doc_id") % len(taxonomy.INDUSTRIES) + 1).cast("int"))).alias("text"))
    plain = docs.select("doc_id", taxonomy.map_industry(F.col("text")).alias("x")).select("doc_id", "x.code", "x.label")
    found = rules.match_rules(docs, rules.rule_table(spark), "doc_id")
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, plain.collect()))
