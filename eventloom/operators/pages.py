"""Rows from captured pages: one parse per page, map-side, after which everything is column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.urls import canonical_url, is_event_detail_url, strip
from eventloom.operators import jsonld
from eventloom.operators.facts import WINDOW_OPEN, page_facts
from eventloom.operators.html import Page, only_closed_references, parsed, per_page, visible_text
from eventloom.operators.merge import SOURCE_RANK, merge_events, nonempty

LISTED = ("event_id", "edition_id", "name", "date_display", "start_date", "end_date", "venue", "description", "categories", "footer_stats", "jsonld_position", "jsonld_image")


def page_text(pages: DataFrame, most: int = 6000, open_references: bool = True) -> DataFrame:
    """``page_id, text``: the visible text, its first ``most`` characters.

    Without ``open_references`` character references count only with their semicolon; cut ones stay as they are.
    """
    own = (lambda h: h) if open_references else (lambda h: only_closed_references(h or ""))
    return per_page(pages, ["page_id"], ["html"], "text string", lambda h: [(visible_text(parsed(own(h)))[:most],)])


def page_links(pages: DataFrame) -> DataFrame:
    """``page_id, pos, kind, href, resolved, text, title, rel, classes`` of anchors with a reference and of links with a relation."""
    return page_facts(pages, ["page_id"], "links").select("page_id", F.inline("links")).drop("hidden", "in_item")


def dom_elements(pages: DataFrame) -> DataFrame:
    """``page_id, index, parent_index, tag, id, class, attrs, text_preview, child_element_count`` in document order."""

    def preview(page: Page, at: int) -> str:
        """The first 400 characters of an element's text: no more of its texts than they need."""
        out = ""
        for k in range(page.first_text[at], page.past_text[at]):
            if page.owner[k] < 0 or page.tags[page.owner[k]] not in ("script", "style"):
                out = f"{out} {' '.join(page.texts[k].split())}".strip()
                if len(out) > 400:
                    break
        return out[:400]

    def make(html: str | None) -> list[tuple]:
        page = parsed(html)
        children = [0] * len(page.tags)
        for up in page.parent:
            if up >= 0:
                children[up] += 1
        return [
            (at, page.parent[at], page.tags[at], own.get("id"), own.get("class"), list(own.items()), preview(page, at), children[at])
            for at, own in enumerate(page.attrs)
        ]

    return per_page(pages, ["page_id"], ["html"], "index int, parent_index int, tag string, id string, class string, attrs map<string,string>, text_preview string, child_element_count int", make)


def meta_tags(pages: DataFrame) -> DataFrame:
    """``page_id, by_name, by_property``: content of the first tag of each name or property."""
    return page_facts(pages, ["page_id"], "by_name", "by_property")


def meta(*keys: str) -> Column:
    """Of the page's head: for each key in order the tag of that name or, only without one, of that property; the first content that isn't empty."""
    key = lambda k: F.coalesce(F.try_element_at("by_name", F.lit(k)), F.try_element_at("by_property", F.lit(k)))
    return F.get(F.filter(F.array(*map(key, keys)), lambda v: v != ""), 0)


def json_ld_scripts(pages: DataFrame) -> DataFrame:
    """``page_id, pos, raw`` of every JSON-LD script."""
    return page_facts(pages, ["page_id"], "json_ld").select("page_id", F.posexplode("json_ld").alias("pos", "raw"))


def json_ld_nodes(pages: DataFrame, depth: int = jsonld.DEPTH) -> DataFrame:
    """``page_id, pos, node``: every object of the pages' JSON-LD, lists and graphs flattened; broken scripts are skipped."""
    nodes = page_facts(pages, ["page_id"], "json_ld").withColumn("n", jsonld.json_ld_nodes(F.col("json_ld"), depth))
    return nodes.select("page_id", F.posexplode("n").alias("pos", "node"))


def jsonld_events(pages: DataFrame) -> DataFrame:
    """``page_id, event_url, canonical`` and the fields of listed events, the first of each canonical URL of a page."""
    found = page_facts(pages, ["page_id"], "json_ld").select("page_id", F.inline(jsonld.listed_events(F.col("json_ld"))))
    found = found.withColumn("canonical", canonical_url(F.col("event_url"))).filter("canonical <> ''")
    return found.groupBy("page_id", "canonical").agg(F.min_by(F.struct(*[c for c in found.columns if c not in ("page_id", "canonical")]), "order").alias("f")).select("page_id", "canonical", "f.*")


def listing_ajax_url(pages: DataFrame) -> DataFrame:
    return page_facts(pages, ["page_id"], "ajax_url")


def listing_table_rows(pages: DataFrame) -> DataFrame:
    """A row per event of the pages' directory tables."""
    return page_facts(pages, ["page_id"], "listing").select("page_id", F.inline("listing"))


def featured_rows(pages: DataFrame) -> DataFrame:
    """A row per card of the pages' premium rails."""
    return page_facts(pages, ["page_id"], "featured").select("page_id", F.inline("featured"))


def opened_urls(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit("(?i)" + WINDOW_OPEN), F.lit(2))


def window_open_urls(pages: DataFrame) -> DataFrame:
    """``page_id, pos, event_url, canonical`` of URLs that scripts open, the first of each canonical URL; read from the raw page."""
    rows = pages.select("page_id", F.posexplode(opened_urls(F.col("html"))).alias("pos", "event_url")).withColumn("canonical", canonical_url(F.col("event_url")))
    return rows.filter("canonical <> ''").groupBy("page_id", "canonical").agg(F.min("pos").alias("pos"), F.min_by("event_url", "pos").alias("event_url")).select("page_id", "pos", "event_url", "canonical")


def _anchor_name(title: Column, text: Column) -> Column:
    return F.coalesce(F.nullif(title, F.lit("")), F.nullif(text, F.lit("")))


def anchor_event_links(links: DataFrame) -> DataFrame:
    """Anchors to detail pages of events, the first of each canonical URL of a page; named by title, else by text."""
    rows = links.filter((F.col("kind") == "a") & is_event_detail_url(F.col("href"))).withColumn("canonical", canonical_url(F.col("href"))).withColumn("name", _anchor_name(F.col("title"), F.col("text")))
    first = F.min_by(F.struct(F.col("href").alias("event_url"), "name"), "pos")
    return rows.groupBy("page_id", "canonical").agg(F.min("pos").alias("pos"), first.alias("_f")).select("page_id", "pos", "canonical", "_f.*")


def extract_event_list(pages: DataFrame, scope: str = "page") -> DataFrame:
    """Events of listing pages from five kinds of sources, merged by canonical URL in each page or, with ``scope="global"``, over all.

    A page is parsed once and gives one array of found events, so that the merge is the only shuffle.
    """
    facts = page_facts(pages.withColumn("opened", opened_urls(F.col("html"))), ["page_id", "opened"], "links", "json_ld", "listing", "featured")
    none = F.lit(None).cast("string")

    def row(source: str, pos: Column, url: Column, **given: Column) -> Column:
        return F.struct(
            F.lit(SOURCE_RANK[source]).alias("src_rank"), F.lit(source).alias("source"), pos.cast("struct<node:int,entry:int>").alias("pos"), url.alias("event_url"),
            *[given.get(f, none).cast("string").alias(f) for f in LISTED],
        )

    at = lambda i: F.struct(i.cast("int").alias("node"), F.lit(0).alias("entry"))
    fields = lambda x, names: {f: x[f] for f in names}
    directory = lambda source: lambda x: row(source, at(x["pos"]), x["event_url"], **fields(x, LISTED[:10]))
    anchors = F.filter("links", lambda x: (x["kind"] == "a") & is_event_detail_url(x["href"]))
    found = F.concat(
        F.transform("listing", directory("listing")),
        F.transform("featured", directory("featured")),
        F.transform(jsonld.listed_events(F.col("json_ld")), lambda x: row("jsonld", x["order"], x["event_url"], **fields(x, ("name", "start_date", "end_date", "venue", "jsonld_position", "jsonld_image")))),
        F.transform("opened", lambda x, i: row("window_open", at(i), x)),
        F.transform(anchors, lambda x: row("anchor", at(x["pos"]), x["href"], name=_anchor_name(x["title"], x["text"]))),
    )
    rows = facts.select("page_id", F.explode(found).alias("x")).select("page_id", "x.*").withColumn("canonical", canonical_url(F.col("event_url")))
    if scope == "global":
        return merge_events(rows.withColumn("pos", F.struct("page_id", "pos")), [], list(LISTED))
    return merge_events(rows, ["page_id"], list(LISTED))


def keyword_tags(links: Column) -> Column:
    """Tags of an aggregator's page and its keywords, as one text; needs the page's ``by_name``."""
    tags = F.transform(F.filter(links, lambda x: (x["kind"] == "a") & x["in_item"] & nonempty(x["text"])), lambda x: x["text"])
    return F.array_join(F.concat(tags, F.array_compact(F.array(F.nullif(F.try_element_at("by_name", F.lit("keywords")), F.lit(""))))), ", ")


def labelled_value(labels: Column, label: str) -> Column:
    """The value of the first list item ``Label: value``: what is in bold, else what follows the colon."""

    def read(x: Column) -> Column:
        rest = strip(F.regexp_replace(x["text"], r"^[^:]*:", ""))
        return F.when(nonempty(x["strong"]), x["strong"]).otherwise(F.nullif(rest, F.lit("")))

    fit = F.filter(labels, lambda x: x["text"].rlike(rf"(?i)^{label}\s*:"))
    return F.get(F.transform(F.slice(fit, 1, 1), read), 0)


def link_directory(pages: DataFrame) -> DataFrame:
    """All links of all pages by canonical URL: the first raw one and its text, and on how many pages they stand.

    Links are counted by page first, so that the number of pages needs no distinct count beside the rest.
    """
    links = page_links(pages).filter("kind = 'a'").withColumn("canonical", canonical_url(F.col("resolved"))).withColumn("text", strip(F.coalesce("text", F.lit(""))))
    by_page = links.filter("canonical <> ''").groupBy("canonical", "page_id").agg(F.count(F.lit(1)).alias("n"), F.min_by(F.struct("resolved", "text"), "pos").alias("f"))
    return by_page.groupBy("canonical").agg(F.min_by("f", "page_id").alias("f"), F.count(F.lit(1)).alias("pages"), F.sum("n").alias("links")).select("canonical", F.col("f.resolved").alias("url"), F.col("f.text").alias("name"), "pages", "links")
