"""Fields, lists and their provenance from one captured page of an event."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.taxonomy import map_industry
from eventloom.functions.text import extract_dates, methodology_description, parse_location
from eventloom.functions.urls import any_of, bare_host, domain_from_url, is_bad_subpage, is_listing_host, let, netloc, parse_url_slug, strip, text_of
from eventloom.operators import jsonld
from eventloom.operators.coverage import SCALARS
from eventloom.operators.facts import page_facts
from eventloom.operators.merge import nonempty
from eventloom.operators.pages import keyword_tags, labelled_value, meta
from eventloom.operators.records import date_fallback, filled

# Words that lead to a page of exhibitors or sponsors, and the fields that an event's own data may give.
EXHIBITOR_LINKS = ("exhibitor", "exhibitors", "exhibitor-list", "floor-plan", "expo")
SPONSOR_LINKS = ("sponsor", "sponsors", "partner", "partners", "supporters")
EVENT_DATA = ("event_name", "start_date", "end_date", "event_description_methodology", "hosting_entity", "venue_name", "address_1", "address_2", "city", "country", "state_province", "zip_code", "conference_group_name", "conference_group_description")
PLACE = ("venue_name", "address_1", "address_2", "city", "country", "state_province", "zip_code")

#: A record's texts: the fields that count, and the listing.
RECORD = (*SCALARS[:8], "listing_url", *SCALARS[8:])
LISTS = ("attending_companies", "exhibitors", "sponsors", "speakers")
#: Fields of a listing page's own columns that no record keeps.
EXTRAS = ("program_url", "organizer_url", "ticket_exit_url", "event_category")
PROVENANCE = "struct<source:string,page_url:string,page_role:string,snippet:string>"

PARTS = (
    "text", "links", "by_name", "by_property", "json_ld", "h1", "labels", "description_pane", "organization_pane", "organizer_name", "organizer_href", "ticket_url",
    "attending", "exhibitors", "sponsors", "speakers",
)


def best_subpage_link(links: Column, base: Column, words: tuple[str, ...], same_host: bool = True, hidden: bool = False) -> Column:
    """The URL of the link that most of the words lead to, of equals the first; null if there is none.

    With ``same_host`` the base's own host counts for far more than words, and others hardly ever win.
    ``hidden``: links that aren't shown count too.
    """
    return best_subpage_links(links, base, {"url": words}, same_host, hidden)["url"]


def best_subpage_links(links: Column, base: Column, words_of: dict[str, tuple[str, ...]], same_host: bool = True, hidden: bool = False) -> Column:
    """``struct`` of ``best_subpage_link`` for several lists of words by name; what doesn't depend on the words is worked out once a link."""

    def fit(x: Column) -> Column:
        shown = F.lit(True) if hidden else ~x["hidden"]
        return (x["kind"] == "a") & shown & (x["href"] != "") & ~x["href"].rlike("^(#|javascript:|mailto:)") & ~is_bad_subpage(x["resolved"])

    def read(home: Column) -> Column:
        by_host = lambda at: F.when(home == "", 0.0).when(at == home, 12.0).otherwise(-8.0)
        of_host = lambda x: let(bare_host(x["resolved"]), by_host) if same_host else F.lit(0.0)
        return F.transform(F.filter(links, fit), lambda x: F.struct(F.lower(text_of(x["text"])).alias("l"), F.lower(x["href"]).alias("h"), of_host(x).alias("b"), (-x["pos"]).alias("p"), x["resolved"].alias("url")))

    def best(read: Column, words: tuple[str, ...]) -> Column:
        joined = tuple(dict.fromkeys(w.replace(" ", j) for w in words for j in "-_"))

        def score(y: Column) -> Column:
            label, href = y["l"], y["h"]
            hits = reduce(Column.__add__, [(label.contains(w) | href.contains(w)).cast("double") for w in words])
            extra = F.when(any_of(label, words), 1.5).otherwise(0.0) + F.when(any_of(href, joined), 1.0).otherwise(0.0) + y["b"]
            return let(hits, lambda n: F.when(n > 0, n + extra))

        scored = F.transform(read, lambda y: F.struct(score(y).alias("s"), y["p"].alias("p"), y["url"].alias("url")))
        return F.array_max(F.filter(scored, lambda x: F.coalesce(x["s"] > -1, F.lit(False))))["url"]

    return let(let(bare_host(base), read), lambda x: F.struct(*[best(x, words).alias(name) for name, words in words_of.items()]))


def _named(values: dict[str, Column], always: tuple[str, ...]) -> Column:
    """A struct of listing fields, with ``keys``: the fields that the page sets, some of them even where it has nothing for them."""
    none = F.lit(None).cast("string")
    fields = F.struct(*[values.get(f, none).cast("string").alias(f) for f in (*RECORD, *EXTRAS)])

    def keyed(x: Column) -> Column:
        keys = F.array_compact(F.array(*[F.lit(f) if f in always else F.when(x[f].isNotNull(), f) for f in values]))
        return F.struct(*[x[f].alias(f) for f in (*RECORD, *EXTRAS)], keys.alias("keys"))

    return let(fields, keyed)


def _with_industry(read: Column, *texts: str) -> Column:
    """``read`` and ``industry``, by what the named ones of its texts say."""
    return let(read, lambda x: F.struct(x.alias("x"), map_industry(F.concat_ws(" ", *[F.nullif(x[t], F.lit("")) for t in texts])).alias("industry")))


def aggregator_page_a(url: Column, event: Column) -> Column:
    """Fields of a directory's page with a list of labels; ``event``: its JSON-LD node. Needs the page's parts."""
    label = lambda name: labelled_value(F.col("labels"), name)
    dates, slug = extract_dates(label("Date")), parse_url_slug(url)
    host = F.coalesce(jsonld.get(event, "$.organizer.name"), F.when(jsonld.get(event, "$.organizer", "variant").isNull(), jsonld.get(event, "$.performer.name")))
    description = filled(methodology_description(F.col("description_pane")), methodology_description(jsonld.said(event, "$.description")))
    read = F.struct(
        filled(strip(F.get(F.split("h1", " on "), 0)), jsonld.get(event, "$.name")).alias("name"), description.alias("description"), keyword_tags(F.col("links")).alias("tags"),
        parse_location(label("Location")).alias("place"), label("Venue").alias("hall_label"), parse_location(label("Venue")).alias("hall"), dates.alias("dates"), slug.alias("slug"),
        label("Organization").alias("organization"), host.alias("host"), F.get(F.filter("links", lambda x: (x["kind"] == "a") & x["href"].rlike("/program$")), 0)["resolved"].alias("program"),
    )

    def build(w: Column) -> Column:
        x, industry = w["x"], w["industry"]
        place, hall, slug, days = x["place"], x["hall"], x["slug"], x["dates"]
        by_slug = F.when(slug["year"].isNotNull() & slug["month"].isNotNull() & days["start"].isNull(), F.concat_ws("-", slug["year"], slug["month"], F.lit("01")))
        values = {
            "event_url": url, "listing_url": url, "conference_domain": domain_from_url(url), "conference_group_name": filled(x["organization"], F.lit("Conference Index")), "event_name": x["name"],
            "venue_name": F.when(x["hall_label"].isNotNull(), F.coalesce(hall["venue"], x["hall_label"])).otherwise(F.coalesce(place["venue"], place["city"])),
            "city": filled(place["city"], hall["city"], slug["city"]), "state_province": filled(place["state"], hall["state"]), "country": filled(place["country"], hall["country"], slug["country"]),
            "zip_code": filled(place["zip"], hall["zip"]), "address_1": hall["venue"], "start_date": filled(days["start"], by_slug, jsonld.get(event, "$.startDate")),
            "end_date": filled(days["end"], days["start"], by_slug, jsonld.get(event, "$.endDate")), "hosting_entity": filled(x["organization"], x["host"]), "conference_group": x["organization"],
            "sponsor_crawler_url": x["program"], "exhibitor_crawler_url": x["program"], "program_url": x["program"], "event_description_methodology": x["description"],
            "conference_group_description": methodology_description(F.col("organization_pane")), "industry_methodology": industry["code"], "industry": industry["label"],
        }
        return _named(values, ("event_url", "listing_url", "conference_domain", "conference_group_name", "venue_name", "city", "state_province", "country", "zip_code", "industry_methodology", "industry"))

    return let(_with_industry(read, "name", "description", "tags"), build)


def aggregator_page_b(url: Column, event: Column) -> Column:
    """Fields of a ticket seller's page; ``event``: its JSON-LD node. Needs the page's parts."""
    day = lambda n: let(jsonld.said(event, n), lambda d: F.when(F.length(d) >= 10, F.substring(d, 1, 10)))
    anchors = F.filter("links", lambda x: x["kind"] == "a")
    business = F.filter(anchors, lambda x: (x["href"].contains("/business") | text_of(x["title"]).contains("Business events")) & F.lower(x["text"]).contains("business"))
    by_path = F.get(F.transform(F.filter(anchors, lambda x: x["href"].rlike("(?i)/[a-z-]+/business")), lambda x: filled(x["text"], F.lit("Business"))), 0)
    read = F.struct(
        filled(F.col("h1"), jsonld.get(event, "$.name")).alias("name"), methodology_description(jsonld.said(event, "$.description")).alias("description"),
        F.coalesce(F.get(business, 0)["text"], by_path).alias("category"), F.try_element_at("by_name", F.lit("keywords")).alias("keywords"), jsonld.address(event).alias("where"),
    )

    def build(w: Column) -> Column:
        x, organizer = w["x"], F.col("organizer_name")
        values = {
            "event_url": url, "listing_url": url, "conference_domain": domain_from_url(url), "conference_group_name": filled(organizer, F.lit("AllEvents")), "event_name": x["name"],
            "hosting_entity": filled(organizer, jsonld.get(event, "$.organizer.name")), "conference_group": organizer, "organizer_url": F.col("organizer_href"), "ticket_exit_url": F.col("ticket_url"),
            "start_date": day("$.startDate"), "end_date": day("$.endDate"), "event_description_methodology": x["description"], "event_category": x["category"],
            "industry_methodology": w["industry"]["code"], "industry": w["industry"]["label"], **{f: x["where"][f] for f in PLACE},
        }
        return _named(values, ("event_url", "listing_url", "conference_domain", "conference_group_name", "industry_methodology", "industry"))

    return let(_with_industry(read, "name", "description", "category", "keywords"), build)


def listing_dispatch(url: Column, event: Column) -> Column:
    """The fields of an aggregator's page by its host; null on any other."""
    host = netloc(url)
    return F.when(host.contains("conferenceindex.org"), aggregator_page_a(url, event)).when(host.contains("allevents.in"), aggregator_page_b(url, event))


def listing_pages(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and ``listing``: what an aggregator's page says of its event. ``pages`` has ``url, html`` and the keys."""
    return listing_of_facts(page_facts(pages.withColumn("_url", F.col("url")), [*keys, "_url"], *PARTS[:12]), keys)


def listing_of_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """``listing_pages`` of pages that are parsed already, see ``event_facts``."""
    facts = facts.withColumn("_event", jsonld.event_node(jsonld.json_ld_nodes(F.col("json_ld"))))
    return facts.select(*keys, listing_dispatch(F.col("_url"), F.col("_event")).alias("listing"))


def extract_speakers(pages: DataFrame, keys: list[str]) -> DataFrame:
    """The keys and ``speakers`` of each of ``pages(url, html)``: those of its text, then those of its cards, the first of each name."""
    return page_facts(pages, keys, "speakers")


def page_role(role: Column) -> Column:
    """The kind of a captured page: those that follow a first one, and a program, count with their kind."""
    out = role
    for kind in ("exhibitors", "sponsors", "speakers"):
        out = F.when(role.startswith(kind), kind).otherwise(out)
    return F.when(role == "program", "speakers").otherwise(out)


def stamp_provenance(values: dict[str, Column], lists: dict[str, Column], is_event: Column, listed: Column, url: Column, role: Column) -> Column:
    """``map<field, struct<source, page_url, page_role, snippet>>`` of the fields that hold something.

    ``listed`` is the array of fields that a listing sets. The event's own data are named first, then
    the listing, and then what kind of reading the field takes without them.
    """
    empty = F.lit(None).cast(PROVENANCE)

    def source(field: str) -> Column:
        if field in lists:
            return F.lit("heuristic")
        own = "meta" if field in ("event_name", "event_description_methodology", "conference_group_name") else "taxonomy" if field in ("industry_methodology", "industry") else "heuristic"
        by = F.when(F.array_contains(listed, field), "listing")
        by = by.when(~is_event, "regex").otherwise(own) if field in ("start_date", "end_date") else by.otherwise(own)
        return F.when(is_event, "json_ld").otherwise(by) if field in EVENT_DATA else by

    def entry(field: str, has: Column, snippet: Column) -> Column:
        told = F.struct(source(field).alias("source"), url.alias("page_url"), role.alias("page_role"), F.nullif(F.substring(snippet, 1, 120), F.lit("")).alias("snippet"))
        return F.struct(F.lit(field).alias("key"), F.when(has, told).otherwise(empty).alias("value"))

    entries = [entry(f, nonempty(c), c) for f, c in values.items()]
    entries += [entry(f, F.size(c) > 0, F.get(c, 0)["name"]) for f, c in lists.items()]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


#: Lists of a page, and the kinds of pages that they are read from, but never from an aggregator's.
LIST_ROLES = {"attending": ("main",), "exhibitors": ("main", "exhibitors"), "sponsors": ("main", "sponsors"), "speakers": ("main", "speakers", "program")}


def lists_to_skip(url: Column, role: Column) -> Column:
    """The lists that a page of this kind isn't asked for."""
    listed = is_listing_host(url)
    return F.array_compact(F.array(*[F.when(listed | ~F.coalesce(role.isin(*roles), F.lit(False)), F.lit(part)) for part, roles in LIST_ROLES.items()]))


def event_facts(pages: DataFrame, keys: list[str]) -> DataFrame:
    """One parse of each of ``pages(url, role, html)``: the keys, ``role, _url, _role`` and all that ``page_fields`` reads."""
    given = pages.withColumns({"_url": F.col("url"), "_role": page_role(F.col("role"))})
    given = given.withColumn("_skip", lists_to_skip(F.col("_url"), F.col("_role")))
    return page_facts(given, [*keys, "role", "_url", "_role"], *PARTS, skip="_skip")


def extract_page_fields(pages: DataFrame, keys: list[str]) -> DataFrame:
    """What each page says of its event: the keys, ``role, text``, the texts of a record, four lists and ``provenance``.

    ``pages`` has ``url`` (the event's), ``role, html`` and the keys. Lists are read only where the page's role
    allows it, and never on aggregators; a listing's fields fill only what is empty. A page without anything gives
    nulls and empty lists.
    """
    return page_fields(event_facts(pages, keys), keys)


def page_fields(facts: DataFrame, keys: list[str]) -> DataFrame:
    """The fields of pages that are parsed already, see ``event_facts`` and ``extract_page_fields``."""
    both = let(jsonld.json_ld_nodes(F.col("json_ld")), lambda nodes: F.struct(jsonld.event_node(nodes).alias("event"), jsonld.event_fields(nodes).alias("ld")))
    leads = best_subpage_links(F.col("links"), F.col("_url"), {"exhibitors": EXHIBITOR_LINKS, "sponsors": SPONSOR_LINKS})
    facts = facts.withColumns({"_both": both, "_leads": leads}).withColumns({"_event": F.col("_both.event"), "_ld": F.col("_both.ld")})
    url, role, ld = F.col("_url"), F.col("_role"), F.col("_ld")
    facts = facts.withColumn("_listing", F.when(role.isin("main", "listing", "speakers", "program"), listing_dispatch(url, F.col("_event"))))
    base = F.col("_listing")
    facts = facts.withColumn("_dates", date_fallback(ld["start_date"], ld["end_date"], F.col("text")))
    dates = F.col("_dates")
    own = {
        "conference_domain": domain_from_url(url), "event_url": url,
        "event_name": filled(ld["event_name"], meta("og:title", "twitter:title")),
        "event_description_methodology": filled(methodology_description(meta("description", "og:description", "twitter:description")), ld["event_description_methodology"]),
        "conference_group_name": filled(ld["conference_group_name"], meta("og:site_name", "application-name")), "conference_group_description": ld["conference_group_description"],
        "hosting_entity": ld["hosting_entity"], "start_date": dates["start"], "end_date": dates["end"],
        "exhibitor_crawler_url": F.col("_leads.exhibitors"), "sponsor_crawler_url": F.col("_leads.sponsors"),
        **{f: ld["address"][f] for f in PLACE},
    }
    none = F.lit(None).cast("string")
    texts = {f: filled(own.get(f, none), base[f]) for f in RECORD}
    free = ~is_listing_host(url)
    only = lambda column, *roles: F.when(free & role.isin(*roles), column).otherwise(F.slice(column, 1, 0))
    lists = {
        "attending_companies": only(F.col("attending"), "main"), "exhibitors": only(F.col("exhibitors"), "main", "exhibitors"), "sponsors": only(F.col("sponsors"), "main", "sponsors"),
        "speakers": only(F.col("speakers"), "main", "speakers", "program"),
    }
    read = facts.select(*keys, "role", "_url", "_role", "text", *[c.alias(f) for f, c in texts.items()], *[c.alias(f) for f, c in lists.items()], ld["is_event"].alias("_is_event"), base["keys"].alias("_listed"))
    stamped = {f: F.col(f) for f in RECORD if f not in ("event_url", "conference_domain")}
    named = {_LIST_FIELD[f]: F.col(f) for f in LISTS}
    prov = stamp_provenance(stamped, named, F.col("_is_event"), F.coalesce("_listed", F.array().cast("array<string>")), url, role)
    return read.withColumn("provenance", prov).drop("_url", "_role", "_is_event", "_listed")


_LIST_FIELD = {"attending_companies": "attending_companies", "exhibitors": "exhibitor_companies", "sponsors": "sponsor_companies", "speakers": "speakers"}
