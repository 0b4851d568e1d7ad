"""The whole job: listed events, captured pages, stored hits and stored answers become records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.taxonomy import DEFAULT, Taxonomy, evaluate_scope, scope_blob
from eventloom.functions.text import methodology_description, normalize_for_match
from eventloom.functions.urls import domain_from_url, is_listing_host, let, text_of
from eventloom.operators import crawl, evidence
from eventloom.operators.event_page import LISTS, PROVENANCE, RECORD, event_facts, extract_page_fields, listing_of_facts, page_fields
from eventloom.operators.facts import rebased
from eventloom.operators.merge import merge_of_entries, nonempty
from eventloom.operators.records import ENTITY, SPEAKER, fill_industry, filled, finalize_record, normalize_entities, seed_records, with_company_lists
from eventloom.operators.resolve import resolve_official_url
from eventloom.operators.staging import staged, unstaged

#: List columns while a record is worked on, and the field that each ends up in.
FIELD_OF = {"attending_companies": "attending_companies", "exhibitors": "exhibitor_companies", "sponsors": "sponsor_companies", "speakers": "speakers"}
PAGE_CHARS = 6000


def join_pages_to_events(events: DataFrame, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good pages with their event's URL as ``url``, and the ids of events that have none.

    Only the ids and URLs of events meet the pages, so that no page is joined with more than that.
    """
    good = pages.filter(F.coalesce("fetch_ok", F.lit(False)) & nonempty(F.col("html")))
    return good.join(events.select("event_id", F.col("event_url").alias("url")), "event_id"), events.select("event_id").join(good.select("event_id"), "event_id", "left_anti")


def merge_pages(found: DataFrame) -> DataFrame:
    """One row per event of the fields of its pages: first non-empty texts, lists one after the other, the most trusted provenance.

    An event has a few pages, so they are collected once, in order, and each field is chosen from them; an aggregate for each
    field sorted and compared every page some seventy times. ``fetch_notes``: what is noted of each page.
    """
    if "fetch_note" not in found.columns:
        found = found.withColumn("fetch_note", F.lit(None).cast("string"))
    noted = F.concat("role", F.lit("_fetch: "), text_of(F.col("fetch_note")))
    said = F.concat(F.lit("--- "), F.col("role"), F.lit(" ---\n"), F.substring("text", 1, PAGE_CHARS))
    # maps have no order, their entries do
    page = F.struct("role_rank", "role", *RECORD, *LISTS, said.alias("_said"), noted.alias("_noted"), F.map_entries("provenance").alias("_told"))
    merged = found.groupBy("event_id").agg(F.array_sort(F.collect_list(page)).alias("_pages"))
    of = lambda f: F.transform("_pages", lambda x: x[f])
    first = lambda f: F.get(F.filter(of(f), nonempty), 0).alias(f)
    # of sources that are trusted alike the last page's stays, as it does where entries are merged
    maps = F.transform(F.filter(of("_told"), lambda t: t.isNotNull()), F.map_from_entries)
    none = F.create_map().cast(f"map<string,{PROVENANCE}>")
    provenance = let(maps, lambda m: F.when(F.size(m) <= 1, F.coalesce(F.get(m, 0), none)).otherwise(F.aggregate(m, none, lambda held, more: merge_of_entries(held, more))))
    return merged.select(
        "event_id", *[first(f) for f in RECORD], *[F.flatten(of(n)).alias(n) for n in LISTS], F.array_join(of("_said"), "\n\n").alias("combined_text"),
        F.array_join(of("role"), ", ").alias("roles"), of("_noted").alias("fetch_notes"), provenance.alias("provenance"),
    )


def parse_event_pages(seeds: DataFrame, pages: DataFrame, answers: DataFrame | None = None, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """A record per event of ``seeds``.

    ``seeds`` has ``event_id`` and the texts of a record (``event_url`` is the one that pages are read for),
    ``pages`` has ``event_id, role, role_rank, url, html``, ``answers`` has ``event_id`` and what a model
    answered (``sources.files.read_answers``), one row an event. Values are the seed's, then the first page's that has them, then
    the model's where the pages support it. Names that the pages don't support go, and so do lists of programs that aren't published yet.
    """
    return records_of(seeds, extract_page_fields(pages, ["event_id", "role_rank"]), answers, taxonomy).drop("fetch_notes")


def records_of(seeds: DataFrame, found: DataFrame, answers: DataFrame | None = None, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """``parse_event_pages`` of pages whose fields are there already; ``fetch_notes`` and ``roles`` are null for an event without pages.

    Other columns of ``seeds`` go through.
    """
    rest = [c for c in seeds.columns if c not in ("event_id", *RECORD)]
    out = seeds.alias("s").join(merge_pages(found).alias("m"), "event_id", "left")
    lists = {n: F.coalesce(F.col(f"m.{n}"), F.array().cast(f"array<{SPEAKER if n == 'speakers' else ENTITY}>")).alias(n) for n in LISTS}
    seeded = F.struct(F.lit("seed").alias("source"), F.col("s.listing_url").alias("page_url"), F.lit("listing").alias("page_role"), F.lit(None).cast("string").alias("snippet"))
    seeded = F.when(nonempty(F.col("s.listing_url")), F.map_from_arrays(F.array(F.lit("listing_url")), F.array(seeded.cast(PROVENANCE))))
    out = out.select(
        "event_id", *rest, *[filled(F.col(f"s.{f}"), F.col(f"m.{f}")).alias(f) for f in RECORD], *lists.values(), F.coalesce("m.combined_text", F.lit("")).alias("combined_text"), "m.roles", "m.fetch_notes",
        merge_of_entries(F.coalesce(seeded, F.create_map().cast(f"map<string,{PROVENANCE}>")), F.coalesce("m.provenance", F.create_map().cast(f"map<string,{PROVENANCE}>"))).alias("provenance"),
    )
    out = finalize_record(out).withColumn("_body", normalize_for_match(F.col("combined_text")))
    out = evidence.validate_list_fields(out, FIELD_OF, "_body")
    role = F.try_element_at("provenance", F.lit("speakers"))["page_role"]
    clear = evidence.clear_unpublished(F.col("speakers"), F.col("attending_companies"), F.col("combined_text"), role)
    out = out.withColumn("_c", clear).withColumns({"speakers": F.col("_c.speakers"), "attending_companies": F.col("_c.attending"), "program_unpublished_lists_cleared": F.col("_c.cleared")}).drop("_c")
    out = _with_answers(out, answers)
    blob = F.concat_ws(" ", *[F.nullif(F.col(f), F.lit("")) for f in ("event_name", "event_description_methodology", "conference_group_description")])
    out = out.withColumn("_i", fill_industry(F.col("industry_methodology"), F.col("industry"), blob, taxonomy.industries))
    added = {f: F.struct(F.lit("taxonomy").alias("source"), F.col("event_url").alias("page_url"), F.lit("derived").alias("page_role"), F.col(f"_i.{p}").alias("snippet")).cast(PROVENANCE) for f, p in (("industry_methodology", "code"), ("industry", "label"))}
    fresh = F.array(*[F.struct(F.lit(f).alias("key"), F.when(~F.coalesce(nonempty(F.col(f)), F.lit(False)) & nonempty(e["snippet"]), e).alias("value")) for f, e in added.items()])
    by_rule = F.map_from_entries(F.filter(fresh, lambda e: e["value"].isNotNull()))
    out = out.withColumn("provenance", merge_of_entries(F.col("provenance"), by_rule, always=True))
    out = out.withColumns({"industry_methodology": F.col("_i.code"), "industry": F.col("_i.label"), "event_description_methodology": methodology_description(F.col("event_description_methodology"))})
    text = scope_blob(*map(F.col, ("event_name", "event_description_methodology", "industry", "conference_group_description")))
    out = out.withColumn("_blob", text).withColumn("scope", evaluate_scope(F.col("_blob"), F.col("exhibitors"), F.col("sponsors"), F.col("speakers"), taxonomy=taxonomy))
    note = F.concat(F.lit("validation: stripped llm="), F.col("llm_stripped"), F.lit(" heuristic="), F.col("heuristic_stripped"))
    out = out.withColumn("enrich_notes", F.array_append("enrich_notes", note))
    validation = F.struct("llm_stripped", "heuristic_stripped", "program_unpublished_lists_cleared", "llm_merged_fields")
    # without answers nothing came in since the lists were normalised, and doing it twice changes nothing
    out = (out if answers is None else finalize_record(out)).withColumns({"validation": validation, "field_provenance": F.col("provenance")})
    return with_company_lists(out).drop("_body", "_i", "_blob", "provenance", "combined_text")


def _with_answers(records: DataFrame, answers: DataFrame | None) -> DataFrame:
    """Adds what a model answered and the pages support; directories' own pages are never completed that way."""
    if answers is None:
        none = F.lit(0)
        return records.withColumns({"llm_stripped": none, "llm_merged_fields": none, "enrich_notes": F.array().cast("array<string>")})
    lists = list(FIELD_OF.values())
    given = answers.select("event_id", *[F.col(f).alias(f"a_{f}") for f in (*RECORD, *lists) if f in answers.columns])
    names = [f for f in RECORD if f in answers.columns]
    own = F.col("a_known") & ~F.lower(text_of(F.col("event_url"))).contains("conferenceindex.org")
    out = records.join(given.withColumn("a_known", F.lit(True)), "event_id", "left").withColumn("_use", F.coalesce(own, F.lit(False)))
    use = F.col("_use")
    out = out.withColumns({**{f"a_{f}": F.when(use, F.col(f"a_{f}")) for f in names}, **{f"a_{f}": F.when(use, F.coalesce(f"a_{f}", F.slice(f"a_{f}", 1, 0))).otherwise(F.slice(f"a_{f}", 1, 0)) for f in lists}})
    out = out.drop("llm_stripped") if "llm_stripped" in out.columns else out
    out = evidence.validate_llm_record(out, [f"a_{f}" for f in names], [f"a_{f}" for f in lists], "_body")
    made = {f"_m_{f}": evidence.merge_llm_scalar(F.col(f), F.col(f"a_{f}")) for f in names}
    shape = {n: SPEAKER if n == "speakers" else ENTITY for n in FIELD_OF}
    as_items = lambda n: F.coalesce(F.transform(F.col(f"a_{FIELD_OF[n]}"), lambda x: F.struct(*[x[p].alias(p) for p in _PARTS[n]])), F.array()).cast(f"array<{shape[n]}>")
    made |= {f"_m_{n}": evidence.merge_llm_items(F.col(n), as_items(n)) for n in FIELD_OF}
    out = out.withColumns(made)
    counts = [F.col(f"{m}.n") for m in made]
    snippet = {**{f: F.substring(f"a_{f}", 1, 120) for f in names}, **{f: F.get(f"a_{f}", 0)["name"] for f in lists}}
    told = F.array(*[F.struct(F.lit(f).alias("key"), F.when(nonempty(s), F.struct(F.lit("llm").alias("source"), F.lit(None).cast("string").alias("page_url"), F.lit(None).cast("string").alias("page_role"), s.alias("snippet"))).alias("value")) for f, s in snippet.items()])
    by_model = F.map_from_entries(F.filter(told, lambda e: e["value"].isNotNull()))
    note = F.when(use, F.array(F.concat(F.lit("llm: used (stripped "), F.col("llm_stripped"), F.lit(" ungrounded)")))).when(F.col("a_known"), F.array(F.lit("llm: skipped (listing-only source)"))).otherwise(F.array().cast("array<string>"))
    out = out.withColumns({"llm_merged_fields": sum(counts[1:], counts[0]), "enrich_notes": note, "provenance": merge_of_entries(F.col("provenance"), by_model)})
    out = out.withColumns({**{f: F.col(f"_m_{f}.value") for f in names}, **{n: F.col(f"_m_{n}.merged") for n in FIELD_OF}})
    return out.drop(*made, "a_known", "_use", *[f"a_{f}" for f in (*names, *lists)])


_PARTS = {n: ("name", "title", "company", "details") if n == "speakers" else ("name", "website", "details") for n in FIELD_OF}


def _first_of_event(rows: DataFrame, value: str) -> DataFrame:
    """``event_id`` and the value of the first of its rows, by rank and URL."""
    return rows.groupBy("event_id").agg(F.min_by(value, F.struct("role_rank", "page_url")).alias(value))


def enrich_events(items: DataFrame, pages: DataFrame, hits: DataFrame, answers: DataFrame | None = None, official_search: bool = True, taxonomy: Taxonomy = DEFAULT) -> DataFrame:
    """Listed events to finished records.

    ``items``: ``event_id``, unique, and the columns of listed events. ``pages``: ``event_id, role, role_rank, page_url, html,
    fetch_ok, fetch_note``. ``hits``: stored search hits. ``answers``: see ``parse_event_pages``. Without ``official_search``
    events of aggregators keep their listing. An event without a good page keeps its seed and a note.

    Each page is parsed once: a listing's before the official site is chosen, for the choice reads it; all others after, for
    the event's URL says which links lead out. What was read is a table in the shared folder, and only thin rows are joined from then on.
    All tables but the records' are removed before this returns.
    """
    good = pages.filter(F.coalesce("fetch_ok", F.lit(False)) & nonempty(F.col("html")))
    of_page = ["event_id", "role_rank", "page_url", "fetch_note"]
    seeds = staged(seed_records(items, "event_id"), "seeds")
    given = good.filter("role = 'listing'").join(seeds.select("event_id"), "event_id", "left_semi")
    listed = staged(event_facts(given.withColumn("url", F.col("page_url")), of_page), "listings")
    found = listing_of_facts(listed, of_page)
    chosen = staged(choose_sites(seeds, _first_of_event(found, "listing"), hits, official_search), "sites")
    urls = chosen.select("event_id", F.col("event_url").alias("url"))
    others = good.filter("role <> 'listing'").join(urls, "event_id")
    others = staged(event_facts(others, of_page), "facts")
    # a listing was read for its own URL; its links are those of the event's
    of_event = listed.join(urls, "event_id").withColumns({"_url": F.col("url"), "links": rebased(F.col("links"), F.col("url"))})
    facts = of_event.select(*others.columns).unionByName(others)
    fields = staged(page_fields(facts, of_page), "fields")
    mains = others.filter("role = 'main'").select("event_id", "role_rank", "page_url", crawl.subpages(rebased(F.col("links"), F.col("page_url")), F.col("page_url")).alias("subpages"))
    at = lambda role: F.get(F.filter("subpages", lambda x: x["role"] == role), 0)["url"]
    led = _first_of_event(mains, "subpages").select("event_id", at("exhibitors").alias("_exhibitors"), at("sponsors").alias("_sponsors"))
    led = chosen.join(led, "event_id", "left")
    led = led.withColumns({f"{k}_crawler_url": filled(F.col(f"{k}_crawler_url"), F.col(f"_{k}s")) for k in ("exhibitor", "sponsor")}).drop("_exhibitors", "_sponsors")
    out = staged(with_job_notes(records_of(led, fields, answers, taxonomy)), "records")
    unstaged(seeds, listed, chosen, others, fields)
    return out


def choose_sites(seeds: DataFrame, listings: DataFrame, hits: DataFrame, official_search: bool = True) -> DataFrame:
    """Seeds filled by their listings, with ``event_url`` to read for, ``official_url``, ``resolution_confidence`` and ``resolution_notes``."""
    none = F.lit(None).cast("string")
    known = set(seeds.columns)
    both = seeds.alias("s").join(listings.alias("l"), "event_id", "left")
    both = both.select(
        "event_id", *[filled(F.col(f"s.{f}") if f in known else none, F.col(f"l.listing.{f}")).alias(f) for f in RECORD],
        *[F.col(f"l.listing.{f}").alias(f"_{f}") for f in ("city", "country", "hosting_entity")],
    )
    asked = both.filter(F.lit(official_search) | ~is_listing_host(F.col("listing_url"))).select("event_id", "event_name", F.col("_city").alias("city"), F.col("_country").alias("country"), F.col("_hosting_entity").alias("organizer"))
    out = both.drop("_city", "_country", "_hosting_entity").join(resolve_official_url(asked, hits), "event_id", "left")
    notes = F.array(F.coalesce("note", F.lit("aggregator listing: official site search skipped")))
    out = out.withColumns({"resolution_confidence": F.coalesce("confidence", F.lit(0.0)), "resolution_notes": notes, "event_url": filled(F.col("official_url"), F.col("listing_url"))})
    return out.drop("confidence", "note")


def with_job_notes(records: DataFrame) -> DataFrame:
    """The URL and domain that a record ends up with, and the notes on its pages; an event without pages keeps its seed's domain."""
    official = F.when(nonempty(F.col("official_url")) & ~is_listing_host(F.col("official_url")), F.col("official_url"))
    final = F.coalesce(official, F.nullif("listing_url", F.lit("")), F.col("event_url"))
    bare = F.col("roles").isNull()
    noted = F.when(bare, F.array(F.lit("no pages fetched"))).otherwise(F.concat("enrich_notes", "fetch_notes", F.array(F.concat(F.lit("pages_fetched: "), "roles"))))
    domain = F.when(bare, F.col("conference_domain")).otherwise(domain_from_url(final))
    return records.withColumns({"event_url": final, "conference_domain": domain, "enrich_notes": noted}).drop("official_url", "roles", "fetch_notes")
