"""Queries of the page, listing, crawl, record and evidence operators over derived pages; their SQL reads the same pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import taxonomy, text
from eventloom.jobs import event_pages as ep
from eventloom.jobs import fixtures as fx
from eventloom.jobs.registry import _in, query
from eventloom.operators import crawl, enrich, event_page, evidence, facts, jsonld, records
from eventloom.operators import pages as page_ops
from eventloom.sources import files

K = ["k"]


def _page(spark, d, name, url="site"):
    """``k, page_id, url, html`` of one kind of page."""
    return ep.pages(spark, d, name).select("k", F.col("k").alias("page_id"), F.col(url).alias("url"), F.col(name).alias("html"))


def _cut(html: str, begin: str, end: str) -> str:
    """SQL of what stands between two marks of a page, null where the first isn't there."""
    b, e = begin.replace("'", "''"), end.replace("'", "''")
    return f"case when contains({html}, '{b}') then string_split(string_split({html}, '{b}')[2], '{e}')[1] end"


_GRAPH = "json_extract(" + _cut("main", '<script type="application/ld+json">', "</script>") + ", '$.\"@graph\"')"
_EVENT = f"json_extract({_GRAPH}, '$[1]')"
_get = lambda node, path: f"json_extract_string({node}, '{path}')"


@query("json_ld_nodes", ep.sql("main") + f"select k, i as pos, {_get('n', '$.name')} as name from (select k, unnest(range(json_array_length(g)::bigint)) as i, unnest(json_extract(g, '$[*]')) as n from (select k, {_GRAPH} as g from pg) where g is not null)")
def json_ld_nodes(spark, d):
    return page_ops.json_ld_nodes(_page(spark, d, "main")).select(F.col("page_id").alias("k"), F.col("pos").cast("long").alias("pos"), F.try_variant_get("node", "$.name", "string").alias("name"))


_TYPE = "json_extract(n, '$.\"@type\"')"


@query(
    "jsonld_type_matches",
    ep.sql("rows") + f"select k, {_get('n', '$.name')} as name, list_contains(string_split(n ->> '$.\"@type\"', ' '), 'Event') as loose, (n ->> '$.\"@type\"') = 'Event' as strict from (select k, unnest(json_extract(" + _cut("rows", '<script type="application/ld+json">', "</script>") + ", '$[*]')) as n from pg)",
)
def jsonld_type_matches(spark, d):
    n = F.col("node")
    return page_ops.json_ld_nodes(_page(spark, d, "rows")).select(F.col("page_id").alias("k"), F.try_variant_get("node", "$.name", "string").alias("name"), jsonld.type_matches(n, "Event").alias("loose"), jsonld.type_matches(n, "Event", strict=True).alias("strict"))


_HOSTED = f"coalesce({_get(_EVENT, '$.organizer.name')}, case when json_type({_EVENT}, '$.organizer') = 'VARCHAR' then {_get(_EVENT, '$.organizer')} end)"


@query(
    "jsonld_event_fields",
    ep.sql("main") + f"select k, {_EVENT} is not null as is_event, {_get(_EVENT, '$.name')} as event_name, {_get(_EVENT, '$.startDate')} as start_date, {_get(_EVENT, '$.endDate')} as end_date, {_get(_EVENT, '$.description')} as description, "
    f"coalesce({_HOSTED}, {_get(_GRAPH, '$[0].name')}) as hosting_entity, case when {_HOSTED} is null then {_get(_GRAPH, '$[0].description')} end as group_description from pg",
)
def jsonld_event_fields(spark, d):
    out = facts.page_facts(_page(spark, d, "main"), K, "json_ld").withColumn("x", jsonld.event_fields(jsonld.json_ld_nodes(F.col("json_ld"))))
    return out.select("k", "x.is_event", "x.event_name", "x.start_date", "x.end_date", F.col("x.event_description_methodology").alias("description"), "x.hosting_entity", F.col("x.conference_group_description").alias("group_description"))


_PLACE = f"(case when json_type({_EVENT}, '$.location') = 'ARRAY' then json_extract({_EVENT}, '$.location[0]') else json_extract({_EVENT}, '$.location') end)"


@query(
    "jsonld_address",
    ep.sql("main") + f"select k, {_get('p', '$.name')} as venue_name, case when json_type(p, '$.address') = 'VARCHAR' then {_get('p', '$.address')} else {_get('p', '$.address.streetAddress')} end as address_1, {_get('p', '$.address.addressLocality')} as city, {_get('p', '$.address.postalCode')} as zip_code, {_get('p', '$.address.addressCountry')} as country from (select k, {_PLACE} as p from pg)",
)
def jsonld_address(spark, d):
    out = facts.page_facts(_page(spark, d, "main"), K, "json_ld").withColumn("x", jsonld.address(jsonld.event_node(jsonld.json_ld_nodes(F.col("json_ld")))))
    return out.select("k", "x.venue_name", "x.address_1", "x.city", "x.zip_code", "x.country")


_OG = _cut("main", '<meta property="og:title" content="', '">')
_META = _cut("main", '<meta name="description" content="', '">')
_SITE_NAME = _cut("main", '<meta property="og:site_name" content="', '">')


@query("meta_fallback", ep.sql("main") + f"select k, coalesce({_get(_EVENT, '$.name')}, {_OG}) as event_name, coalesce({_META}, {_get(_EVENT, '$.description')}) as description, {_SITE_NAME} as site_name from pg")
def meta_fallback(spark, d):
    out = facts.page_facts(_page(spark, d, "main"), K, "json_ld", "by_name", "by_property").withColumn("x", jsonld.event_fields(jsonld.json_ld_nodes(F.col("json_ld"))))
    return out.select(
        "k", records.filled(F.col("x.event_name"), page_ops.meta("og:title", "twitter:title")).alias("event_name"),
        records.filled(text.methodology_description(page_ops.meta("description", "og:description", "twitter:description")), F.col("x.event_description_methodology")).alias("description"), page_ops.meta("og:site_name", "application-name").alias("site_name"),
    )


_LABEL = lambda n: _cut("listing", f"<li>{n}: ", "</li>")


@query("labelled_value", ep.sql("listing") + f"select k, regexp_replace({_LABEL('Location')}, '</?strong>', '', 'g') as place, {_LABEL('Date')} as day, {_LABEL('Organization')} as organization from pg")
def labelled_value(spark, d):
    out = facts.page_facts(_page(spark, d, "listing"), K, "labels")
    return out.select("k", *[page_ops.labelled_value(F.col("labels"), n).alias(a) for n, a in (("Location", "place"), ("Date", "day"), ("Organization", "organization"))])


_TAGS = "regexp_extract(listing, '<a href=\"/conferences/[^>]*>([^<]*)</a>', 1)"


@query("keyword_tags", ep.sql("listing") + f"select k, {_TAGS} || ', ' || " + _cut("listing", '<meta name="keywords" content="', '">') + " as tags from pg")
def keyword_tags(spark, d):
    return facts.page_facts(_page(spark, d, "listing"), K, "links", "by_name").select("k", page_ops.keyword_tags(F.col("links")).alias("tags"))


@query("listing_ajax_url", ep.sql("rows") + "select k, trim(" + _cut("rows", 'id="desktopdropdown" value="', '">') + ") as ajax_url from pg")
def listing_ajax_url(spark, d):
    return page_ops.listing_ajax_url(_page(spark, d, "rows")).select(F.col("page_id").alias("k"), "ajax_url")


_CELLS = "regexp_extract_all(" + _cut("rows", '<tr class="event-card x">', "</tr>") + ", '<td[^>]*>(.*?)</td>', 1)"
_PLAIN = lambda c: f"nullif(trim(regexp_replace({c}, '<[^>]*>', '', 'g')), '')"


@query(
    "listing_table_rows",
    ep.sql("rows") + "select k, " + _cut("rows", "onclick=\"window.open('", "')") + " as event_url, " + _cut("rows", '<td data-id="', '"') + " as event_id, " + _cut("rows", '<h2 data-edition="', '"') + " as edition_id, "
    f"{_PLAIN('c[2]')} as name, {_PLAIN('c[1]')} as date_display, " + _cut("rows", 'data-start-date="', '"') + f" as start_date, {_PLAIN('c[3]')} as venue, {_PLAIN('c[4]')} as description, {_PLAIN('c[5]')} as categories, {_PLAIN('c[6]')} as footer_stats from (select *, {_CELLS} as c from pg)",
)
def listing_table_rows(spark, d):
    out = page_ops.listing_table_rows(_page(spark, d, "rows"))
    return out.select(F.col("page_id").alias("k"), "event_url", "event_id", "edition_id", "name", "date_display", "start_date", "venue", "description", "categories", "footer_stats")


_RAIL = _cut("rows", '<div id="featured-events">', "</div></div></div>")


@query("featured_rows", ep.sql("rows") + "select k, " + _cut("r", "window.open('", "')") + " as event_url, " + _cut("r", 'data-id="', '"') + " as event_id, " + _cut("r", "<h3>", "</h3>") + " as name, " + _cut("r", 'data-start-date="', '"') + f" as start_date from (select k, {_RAIL} as r from pg)")
def featured_rows(spark, d):
    return page_ops.featured_rows(_page(spark, d, "rows")).select(F.col("page_id").alias("k"), "event_url", "event_id", "name", "start_date")


_LD = "(" + _cut("rows", '<script type="application/ld+json">', "</script>") + ")::json"
_E = lambda i, p: f"json_extract_string(l, '$[0].itemListElement[{i}].{p}')"
_LISTED = (
    f"select k, {_E(0, 'item')} as event_url, {_E(0, 'name')} as name, null as start_date, null as venue, {_E(0, 'position')} as position from j union all "
    f"select k, {_E(1, 'item.url')}, {_E(1, 'item.name')}, {_E(1, 'item.startDate')}, {_E(1, 'item.location.name')}, {_E(1, 'position')} from j union all "
    "select k, json_extract_string(l, '$[1].location[0].url'), json_extract_string(l, '$[1].name'), null, null, null from j"
)


@query("jsonld_events", ep.sql("rows") + f", j as (select k, {_LD} as l from pg) {_LISTED}")
def jsonld_events(spark, d):
    return page_ops.jsonld_events(_page(spark, d, "rows")).select(F.col("page_id").alias("k"), "event_url", "name", "start_date", "venue", F.col("jsonld_position").alias("position"))


_OPENED = "regexp_extract_all(rows, 'window\\.open\\(''([^'']*)''', 1)"
_ANCHORS = "select k, regexp_extract(rows, '<a href=\"([^\"]*)\"', 1) as event_url, regexp_extract(rows, '<a href=\"[^\"]*\" title=\"([^\"]*)\"', 1) as name from pg"


@query("anchor_event_links", ep.sql("rows") + f"select k as page_id, event_url, event_url as canonical, name from ({_ANCHORS})")
def anchor_event_links(spark, d):
    return page_ops.anchor_event_links(page_ops.page_links(_page(spark, d, "rows"))).select("page_id", "event_url", "canonical", "name")


@query("window_open_urls", ep.sql("rows") + f"select k as page_id, u as event_url, string_split(u, '?')[1] as canonical from (select k, unnest({_OPENED}) as u from pg)")
def window_open_urls(spark, d):
    return page_ops.window_open_urls(_page(spark, d, "rows")).select("page_id", "event_url", "canonical")


@query(
    "extract_event_list",
    ep.sql("rows") + f", j as (select k, {_LD} as l from pg), f as (select k, " + _cut("rows", "onclick=\"window.open('", "')") + f" as url, 0 as r, 'listing' as source, {_PLAIN('c[2]')} as name, " + _cut("rows", 'data-start-date="', '"') + f" as start_date, {_PLAIN('c[3]')} as venue from (select *, {_CELLS} as c from pg) "
    f"union all select k, " + _cut("r", "window.open('", "')") + ", 1, 'featured', " + _cut("r", "<h3>", "</h3>") + ", " + _cut("r", 'data-start-date="', '"') + f", null from (select k, {_RAIL} as r from pg) "
    f"union all select k, event_url, 2, 'jsonld', name, start_date, venue from ({_LISTED}) union all select k, unnest({_OPENED}), 3, 'window_open', null, null, null from pg union all select k, event_url, 4, 'anchor', name, null, null from ({_ANCHORS})) "
    "select k as page_id, string_split(url, '?')[1] as canonical, arg_min(url, r) as event_url, string_agg(source, ',' order by r) as sources, arg_min(name, r) filter (name is not null) as name, arg_min(start_date, r) filter (start_date is not null) as start_date, arg_min(venue, r) filter (venue is not null) as venue from f group by 1, 2",
)
def extract_event_list(spark, d):
    return page_ops.extract_event_list(_page(spark, d, "rows")).select("page_id", "canonical", "event_url", F.array_join("sources", ",").alias("sources"), "name", "start_date", "venue")


# --- pages of events -------------------------------------------------------------------------------------------------

_LISTING_URL = "'https://conferenceindex.org/event/' || slug"
_RULES = "case " + " ".join(f"when {_in('x', w)} then '{c}' " for c, _, w in taxonomy.INDUSTRIES) + " end"


def _listing_page(spark, d, name="listing", prefix="https://conferenceindex.org/event/"):
    rows = ep.pages(spark, d, name)
    return rows.select("k", F.concat(F.lit(prefix), "slug").alias("url"), F.col(name).alias("html"))


_ABOUT = "trim(replace(replace(" + _cut("listing", '<div id="event-description">', "</div>") + ", '<b>', chr(10)), '</b>', ''))"
_ABOUT = f"regexp_replace({_ABOUT}, ' *{chr(92)}n', chr(10))"
_TITLE = "string_split(" + _cut("listing", "<h1>", "</h1>") + ", ' on ')[1]"
_PLACE_A = f"string_split(regexp_replace({_LABEL('Location')}, '</?strong>', '', 'g'), ', ')"
_VENUE_A = f"string_split({_LABEL('Venue')}, ', ')"
_BLOB_A = f"lower({_TITLE} || ' ' || {_ABOUT} || ' ' || {_TAGS} || ', ' || " + _cut("listing", '<meta name="keywords" content="', '">') + ")"
_SELECT_A = (
    f"{_TITLE} as event_name, {_PLACE_A}[1] as city, {_PLACE_A}[2] as country, {_VENUE_A}[3] as state_province, coalesce({_VENUE_A}[1], {_PLACE_A}[1]) as venue_name, {_VENUE_A}[1] as address_1, {_LABEL('Date')} as start_date, {_LABEL('Organization')} as hosting_entity, "
    f"coalesce({_LABEL('Organization')}, 'Conference Index') as conference_group_name, 'https://conferenceindex.org' || regexp_extract(listing, 'href=\"(/event/[^\"]*)', 1) as program_url, {_ABOUT} as description, " + _cut("listing", '<div id="event-organization">', "</div>") + " as group_description"
)
_COLUMNS_A = ("event_name", "city", "country", "state_province", "venue_name", "address_1", "start_date", "hosting_entity", "conference_group_name", "program_url")


@query("aggregator_page_a", ep.sql("listing") + f"select k, {_SELECT_A}, {_RULES} as industry_methodology from (select *, {_BLOB_A} as x from pg)")
def aggregator_page_a(spark, d):
    out = event_page.listing_pages(_listing_page(spark, d), K)
    return out.select("k", *[f"listing.{c}" for c in _COLUMNS_A], F.col("listing.event_description_methodology").alias("description"), F.col("listing.conference_group_description").alias("group_description"), "listing.industry_methodology")


_TICKET = _EVENT.replace("main", "ticket")
_PLACE_B = _PLACE.replace("main", "ticket")
_TITLE_B = "trim(" + _cut("ticket", "<h1>", "</h1>") + ")"
_ORG_B = _cut("ticket", '<h2 class="eps-org-name">', "</h2>")
_CATEGORY = "regexp_extract(ticket, '/business\">([^<]*)<', 1)"
_SELECT_B = (
    f"{_TITLE_B} as event_name, {_ORG_B} as hosting_entity, 'https://allevents.in' || regexp_extract(ticket, 'href=\"(/org/[^\"]*)', 1) as organizer_url, " + _cut("ticket", 'data-ehref="', '"') + f" as ticket_exit_url, "
    f"left({_get(_TICKET, '$.startDate')}, 10) as start_date, {_CATEGORY} as event_category, {_get(_PLACE_B, '$.name')} as venue_name, {_get(_PLACE_B, '$.address.addressLocality')} as city"
)


@query("aggregator_page_b", ep.sql("ticket") + f"select k, {_SELECT_B}, {_RULES} as industry_methodology from (select *, lower({_TITLE_B} || ' ' || {_get(_TICKET, '$.description')} || ' ' || {_CATEGORY}) as x from pg)")
def aggregator_page_b(spark, d):
    out = event_page.listing_pages(_listing_page(spark, d, "ticket", "https://allevents.in/x/"), K)
    return out.select("k", *[f"listing.{c}" for c in ("event_name", "hosting_entity", "organizer_url", "ticket_exit_url", "start_date", "event_category", "venue_name", "city", "industry_methodology")])


@query("listing_dispatch", ep.sql("listing", "ticket") + f"select k, case k % 3 when 0 then coalesce({_LABEL('Organization')}, 'Conference Index') when 1 then {_ORG_B} end as group_name, k % 3 = 2 as none from pg")
def listing_dispatch(spark, d):
    k = F.col("k")
    made = ep.pages(spark, d, "listing", "ticket").select("k", F.concat(F.when(k % 3 == 0, "https://conferenceindex.org/event/").when(k % 3 == 1, "https://allevents.in/").otherwise("https://example.com/"), "slug").alias("url"), F.when(k % 3 == 0, F.col("listing")).otherwise(F.col("ticket")).alias("html"))
    return event_page.listing_pages(made, K).select("k", F.col("listing.conference_group_name").alias("group_name"), F.col("listing").isNull().alias("none"))


_HREF = lambda mark: f"regexp_extract(main, 'href=\"({mark}[^\"]*)\"', 1)"


@query("best_subpage_link", ep.sql("main") + f"select k, site || {_HREF('/exhibitor-list')} as exhibitors, site || {_HREF('/sponsors')} as sponsors, {_HREF('https://other')} as anywhere from pg")
def best_subpage_link(spark, d):
    out = facts.page_facts(_page(spark, d, "main").withColumn("site", F.col("url")), ["k", "site"], "links")
    best = lambda words, **how: event_page.best_subpage_link(F.col("links"), F.col("site"), words, **how)
    return out.select("k", best(event_page.EXHIBITOR_LINKS).alias("exhibitors"), best(event_page.SPONSOR_LINKS).alias("sponsors"), best(("partners",), same_host=False).alias("anywhere"))


_CARD = "regexp_extract(main, '<div class=\"sponsor-card\"><h3>([^<]*)</h3><p>([^<]*)</p><a href=\"([^\"]*)\"', {})"
_LOGO = _cut("main", '<img alt="', '"')
_PERSON = _cut("main", '<div class="card"><h3>', "</h3>")


@query("extract_entities", ep.sql("main") + f"select k, {_LOGO} as name, null as website, null as details from pg union all select k, {_CARD.format(1)}, {_CARD.format(3)}, {_CARD.format(2)} from pg union all select k, 'Site', {_CARD.format(3)}, null from pg")
def extract_entities(spark, d):
    return facts.page_facts(_page(spark, d, "main"), K, "sponsors").select("k", F.inline("sponsors"))


@query("semantic_section", ep.sql("main") + f"select k, 3 as in_section, string_split(substr(main, strpos(main, 'sponsors-list')), '</section>')[1] like '%<h2>Sponsors</h2>%' as found, not contains(main, 'class=\"exhibitor') and not contains(" + _cut("main", "<h1>", "</h1>") + ", 'expo') as no_exhibitors from pg")
def semantic_section(spark, d):
    out = facts.page_facts(_page(spark, d, "main"), K, "sponsors", "exhibitors")
    return out.select("k", F.size("sponsors").alias("in_section"), (F.size("sponsors") > 0).alias("found"), (F.size("exhibitors") == 0).alias("no_exhibitors"))


@query("speakers_from_text", f"with {fx.BASE} select k, unnest([speaker, host || ' B', 'Prof. ' || city, 'keynote: ' || host]) as name, unnest(['CEO', null, null, null]) as title, unnest([null, country, null, null]) as company from base")
def speakers_from_text(spark, d):
    said = F.expr("'Panelists: ' || speaker || ' — CEO; ' || host || ' B at ' || country || ', Lunch break, Prof. ' || city || ', ' || speaker || '. Description: none, at all' || chr(10) || 'keynote: ' || host")
    return fx.base(spark, d).select("k", F.inline(text.speakers_from_text(said))).select("k", "name", "title", "company")


@query("extract_speakers", ep.sql("main") + f"select k, {_PERSON} as name, count(*) as n from pg group by all")
def extract_speakers(spark, d):
    out = event_page.extract_speakers(_page(spark, d, "main"), K).select("k", F.explode("speakers").alias("s"))
    return out.filter(F.col("s.name").startswith("Customer")).groupBy("k", F.col("s.name").alias("name")).agg(F.count(F.lit(1)).alias("n"))


_OWN_NAME = f"coalesce({_get(_EVENT, '$.name')}, {_OG})"
_OWN_TEXT = f"coalesce({_META}, {_get(_EVENT, '$.description')})"
_OWN_START = f"coalesce({_get(_EVENT, '$.startDate')}, regexp_extract(main, 'Opens ([0-9-]*)', 1))"
_OWN_HOST = f"coalesce({_HOSTED}, {_get(_GRAPH, '$[0].name')})"


@query(
    "extract_page_fields",
    ep.sql("main") + f"select k, regexp_extract(site, '//www.(.*)', 1) as conference_domain, {_OWN_NAME} as event_name, {_OWN_TEXT} as description, {_OWN_START} as start_date, {_OWN_HOST} as hosting_entity, case when {_EVENT} is null then {_SITE_NAME} when {_HOSTED} is null then {_get(_GRAPH, '$[0].name')} end as group_name, "
    f"{_get(_PLACE, '$.name')} as venue_name, {_get(_PLACE, '$.address.addressLocality')} as city, site || {_HREF('/sponsors')} as sponsor_crawler_url, {_LOGO} || '|' || {_CARD.format(1)} || '|Site' as sponsors from pg",
)
def extract_page_fields(spark, d):
    out = event_page.extract_page_fields(_page(spark, d, "main").withColumn("role", F.lit("main")), K)
    return out.select("k", "conference_domain", "event_name", F.col("event_description_methodology").alias("description"), "start_date", "hosting_entity", F.col("conference_group_name").alias("group_name"), "venue_name", "city", "sponsor_crawler_url", F.array_join(F.transform("sponsors", lambda x: x["name"]), "|").alias("sponsors"))


@query(
    "stamp_provenance",
    ep.sql("main") + f"select k, case when {_EVENT} is null then 'meta' else 'json_ld' end as of_name, case when {_EVENT} is null then 'regex' else 'json_ld' end as of_start, case when {_EVENT} is not null then 'json_ld' end as of_venue, 'heuristic' as of_sponsors, left({_OWN_NAME}, 120) as snippet, left({_LOGO}, 120) as first_sponsor from pg",
)
def stamp_provenance(spark, d):
    out = event_page.extract_page_fields(_page(spark, d, "main").withColumn("role", F.lit("main")), K)
    of = lambda f: F.try_element_at("provenance", F.lit(f))
    return out.select("k", of("event_name")["source"].alias("of_name"), of("start_date")["source"].alias("of_start"), of("venue_name")["source"].alias("of_venue"), of("sponsor_companies")["source"].alias("of_sponsors"), of("event_name")["snippet"].alias("snippet"), of("sponsor_companies")["snippet"].alias("first_sponsor"))


# --- crawling --------------------------------------------------------------------------------------------------------


@query("discover_subpages", ep.sql("main") + f"select k, 'exhibitors' as role, site || {_HREF('/exhibitor-list')} as url from pg union all select k, 'sponsors', site || {_HREF('/sponsors')} from pg union all select k, 'speakers', null from pg where contains(main, 'href=\"/program')")
def discover_subpages(spark, d):
    return crawl.discover_subpages(_page(spark, d, "main"), K)


_PAGE_HREFS = "list_transform(regexp_extract_all(pager, '<a href=\"([^\"]*)\"', 1), lambda x: string_split(x, '#')[1])"
_NEXT_LINK = "regexp_extract(pager, '<link rel=\"next\" href=\"([^\"]*)\"', 1)"
_NEXT = f"(select k, site, list_filter({_PAGE_HREFS}, lambda x: starts_with(x, '/list') and contains(x, 'page=')) || [{_NEXT_LINK}] as u from pg)"
#: each URL once, in order
_ONCE = "list_transform(list_filter(range(1, len(u) + 1), lambda i: list_position(u, u[i]) = i), lambda i: u[i])"


@query("discover_pagination", ep.sql("pager") + f"select k, array_to_string(list_transform({_ONCE}[1:4], lambda x: site || x), ' ') as next_urls from {_NEXT}")
def discover_pagination(spark, d):
    return crawl.discover_pagination(_page(spark, d, "pager"), K).select("k", F.array_join("next_urls", " ").alias("next_urls"))


@query("pagination_chain", "with p as (select page_id, 'https://list.example.com/' || (page_id // 7) || '?page=' || (page_id % 7) as url, 'https://list.example.com/' || (page_id // 7) || '?page=' || (page_id % 7 + 1) as nxt from pages) select a.page_id as k, case when b.page_id = a.page_id then 'speakers' else 'speakers_p' || (b.page_id - a.page_id + 1) end as role, b.url from p a join p b on b.page_id // 7 = a.page_id // 7 and b.page_id between a.page_id and a.page_id + 4")
def pagination_chain(spark, d):
    url = lambda more: F.concat(F.lit("https://list.example.com/"), F.expr("page_id div 7").cast("string"), F.lit("?page="), (F.col("page_id") % 7 + more).cast("string"))
    ids = fx.read(spark, d, "pages").select(F.col("page_id").alias("k"), F.lit("speakers").alias("role"), url(0).alias("url"), F.array(url(1), url(0)).alias("next_urls"))
    return crawl.pagination_chain(ids.drop("next_urls"), ids.select("url", "next_urls"), K)


@query("crawl_plan", ep.sql("main") + f"select k, site || {_HREF('/exhibitor-list')} as exhibitor_crawler_url, site || {_HREF('/sponsors')} as sponsor_crawler_url, site || {_HREF('/sponsors')} || ' ' || site || {_HREF('/sponsors')} || '?page=2' as sponsors from pg")
def crawl_plan(spark, d):
    made = ep.pages(spark, d, "main", "sponsors")
    path = F.concat("site", F.lit("/sponsors-"), F.col("k").cast("string"))
    both = F.array(F.struct(path.alias("url"), F.col("sponsors").alias("html")), F.struct(F.concat(path, F.lit("?page=2")).alias("url"), F.lit("<p>end</p>").alias("html")))
    captured = made.select(F.inline(both))
    out = crawl.crawl_plan(made.select("k", F.col("site").alias("url"), F.col("main").alias("html")), captured, K)
    return out.select("k", "exhibitor_crawler_url", "sponsor_crawler_url", F.concat_ws(" ", F.try_element_at("pages", F.lit("sponsors")), F.try_element_at("pages", F.lit("sponsors_p2"))).alias("sponsors"))


@query("merge_crawler_urls", ep.sql("main") + f"select k, case when k % 2 = 0 then host else site || {_HREF('/exhibitor-list')} end as exhibitor_crawler_url, site || {_HREF('/sponsors')} as sponsor_crawler_url from pg")
def merge_crawler_urls(spark, d):
    made = ep.pages(spark, d, "main")
    seeds = made.select("k", F.when(F.col("k") % 2 == 0, F.col("host")).otherwise("").alias("exhibitor_crawler_url"), F.lit(None).cast("string").alias("sponsor_crawler_url"))
    main = made.select("k", F.col("site").alias("url"), F.col("main").alias("html"))
    # one page of each site, chosen by its key, so that no page is shuffled for it
    first = made.groupBy("site").agg(F.min("k").alias("k")).select("k")
    return crawl.merge_crawler_urls(seeds, crawl.crawl_plan(main, main.join(first, "k", "left_semi").select("url", "html"), K), K)


# --- records ---------------------------------------------------------------------------------------------------------


@query("join_pages_to_events", f"with {fx.BASE} select k as event_id, case when k % 3 <> 0 then 'https://e/' || k end as url, k % 3 = 0 as bare from base")
def join_pages_to_events(spark, d):
    events = fx.base(spark, d).select(F.col("k").alias("event_id"), F.concat(F.lit("https://e/"), F.col("k").cast("string")).alias("event_url"))
    captured = events.select("event_id", F.when(F.col("event_id") % 6 != 0, "<p>x</p>").otherwise("").alias("html"), (F.col("event_id") % 6 != 3).alias("fetch_ok"))
    good, bare = enrich.join_pages_to_events(events, captured)
    return good.select("event_id", "url", F.lit(False).alias("bare")).unionByName(bare.select("event_id", F.lit(None).cast("string").alias("url"), F.lit(True).alias("bare")))


_LINES = "select l_orderkey as k, l_linenumber as n, s_name as name, p_name as details from lineitem join supplier on s_suppkey = l_suppkey join part on p_partkey = l_partkey"


def _entity_lists(spark, d, speakers=False):
    """The suppliers of each order as a list of entities: padded names, some of them empty."""
    lines = fx.read(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    lines = lines.join(fx.read(spark, d, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey")).join(fx.read(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    none, name = F.lit(None).cast("string"), F.concat(F.lit(" "), F.when(F.col("l_linenumber") % 4 == 0, "").otherwise(F.col("s_name")), F.lit(" "))
    parts = (name.alias("name"), none.alias("title"), none.alias("company"), F.col("p_name").alias("details")) if speakers else (name.alias("name"), F.concat(F.lit("https://"), F.col("s_suppkey").cast("string")).alias("website"), F.col("p_name").alias("details"))
    item = F.struct("l_linenumber", F.col("p_name").alias("_p"), F.struct(*parts).alias("x"))
    return lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.transform(F.array_sort(F.collect_list(item)), lambda r: r["x"]).alias("items"))


_FIRST = f"(select k, name, details, i, l_s from (select *, row_number() over (partition by k, lower(name) order by i) as r from (select l_orderkey as k, s_name as name, p_name as details, s_suppkey as l_s, row_number() over (partition by l_orderkey order by l_linenumber, p_name, s_name) as i, l_linenumber as n from lineitem join supplier on s_suppkey = l_suppkey join part on p_partkey = l_partkey) where n % 4 <> 0) where r = 1)"


@query("normalize_entities", f"select k, name, 'https://' || l_s as website, details from {_FIRST}")
def normalize_entities(spark, d):
    return _entity_lists(spark, d).select("k", F.inline(records.normalize_entities(F.col("items"))))


@query("split_companies", f"select o.o_orderkey as k, coalesce(string_agg(name, '|' order by i), '') as names, coalesce(string_agg('https://' || l_s, '|' order by i), '') as websites from (select distinct l_orderkey as o_orderkey from lineitem) o left join {_FIRST} on k = o_orderkey group by 1")
def split_companies(spark, d):
    both = records.split_companies(records.normalize_entities(F.col("items")))
    return _entity_lists(spark, d).withColumn("x", both).select("k", F.array_join("x.names", "|").alias("names"), F.array_join("x.websites", "|").alias("websites"))


@query(
    "finalize_record",
    f"with {fx.BASE}, s as (select k, string_agg(name || '=' || details, '|' order by i) as speakers from {_FIRST} group by 1) select k, coalesce(speakers, '') as speakers, coalesce(case when k % 3 > 0 then city end, case when k % 2 = 0 then country end) as conference_group, coalesce(case when k % 2 = 0 then country end, case when k % 3 > 0 then city end) as conference_group_name, 'example.com' as conference_domain from base left join s using (k)",
)
def finalize_record(spark, d):
    k, empty = F.col("k"), F.array().cast(f"array<{records.ENTITY}>")
    made = fx.base(spark, d).join(_entity_lists(spark, d, speakers=True), "k").select(
        "k", F.col("items").alias("speakers"), empty.alias("attending_companies"), empty.alias("exhibitors"), empty.alias("sponsors"), F.when(k % 3 > 0, F.col("city")).alias("conference_group"),
        F.when(k % 2 == 0, F.col("country")).otherwise("").alias("conference_group_name"), F.lit("https://www.example.com/x").alias("event_url"), F.lit(None).cast("string").alias("conference_domain"),
    )
    out = records.finalize_record(records.finalize_record(made))
    return out.select("k", F.array_join(F.transform("speakers", lambda x: F.concat(x["name"], F.lit("="), x["title"])), "|").alias("speakers"), "conference_group", "conference_group_name", "conference_domain")


def _grounded(spark, d, speakers=False):
    body = F.array_join(F.transform(F.filter("items", lambda x, i: i < 2), lambda x: F.concat(F.trim(x["name"]), F.lit(" with "), x["details"])), "; ")
    return _entity_lists(spark, d, speakers).withColumn("body", text.normalize_for_match(body))


@query(
    "filter_speakers",
    "with l as (select l_orderkey as k, l_linenumber % 4 = 0 as blank, s_name as name, p_name as details, row_number() over (partition by l_orderkey order by l_linenumber, p_name, s_name) as i from lineitem join supplier on s_suppkey = l_suppkey join part on p_partkey = l_partkey), "
    "b as (select k, string_agg(lower(case when blank then '' else name end || ' with ' || details), '; ' order by i) filter (i <= 2) as body from l group by 1), "
    "w as (select l.*, body, list_filter(regexp_split_to_array(lower(name), '[^a-z0-9_]+'), lambda x: len(x) > 2)[1:4] as nw, list_filter(regexp_split_to_array(lower(details), '[^a-z0-9_]+'), lambda x: len(x) > 2)[1:4] as dw from l join b using (k)), "
    "g as (select *, not blank and (contains(body, lower(name)) or (len(nw) >= 2 and len(list_filter(nw, lambda x: not contains(body, x))) = 0)) as by_name, not blank and len(details) >= 8 and (contains(body, lower(details)) or (len(dw) >= 2 and len(list_filter(dw, lambda x: not contains(body, x))) = 0)) as by_model from w) "
    "select k, coalesce(string_agg(name, '|' order by i) filter (by_name), '') as kept, count(*) filter (not by_name)::int as stripped, coalesce(string_agg(name, '|' order by i) filter (by_model), '') as kept_of_model from g group by 1",
)
def filter_speakers(spark, d):
    rows = _grounded(spark, d, speakers=True)
    own, model = (evidence.filter_speakers(F.col("items"), F.col("body"), F.lit(m)) for m in (False, True))
    names = lambda c: F.array_join(F.transform(c, lambda x: F.trim(x["name"])), "|")
    return rows.select("k", own.alias("o"), model.alias("m")).select("k", names(F.col("o.kept")).alias("kept"), "o.stripped", names(F.col("m.kept")).alias("kept_of_model"))


@query(
    "validate_list_fields",
    f"with h as (select l_orderkey as k, lower(s_name) || '.' as body from lineitem join supplier on s_suppkey = l_suppkey where l_linenumber = 3), g as (select f.*, coalesce(contains(body, lower(name)), false) as good from {_FIRST} f left join (select k, max(body) as body from h group by 1) using (k)) "
    "select k, coalesce(string_agg(name, '|' order by i) filter (good), '') as kept, count(*) filter (not good)::int as stripped, bool_or(good) as has_provenance from g group by k",
)
def validate_list_fields(spark, d):
    third = fx.read(spark, d, "lineitem").filter("l_linenumber = 3").select(F.col("l_orderkey").alias("k"), "l_suppkey").join(fx.read(spark, d, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    body = third.groupBy("k").agg(F.concat(F.max("s_name"), F.lit(".")).alias("b"))
    prov = F.map_from_arrays(F.array(F.lit("sponsor_companies")), F.array(F.struct(F.lit("heuristic").alias("source"), F.lit(None).cast("string").alias("page_url"), F.lit(None).cast("string").alias("page_role"), F.lit(None).cast("string").alias("snippet"))))
    rows = _entity_lists(spark, d).withColumn("sponsors", records.normalize_entities(F.col("items"))).join(body, "k", "left").withColumns({"body": text.normalize_for_match(F.col("b")), "provenance": prov})
    out = evidence.validate_list_fields(rows.filter("size(sponsors) > 0"), {"sponsors": "sponsor_companies"}, "body")
    return out.select("k", F.array_join(F.transform("sponsors", lambda x: x["name"]), "|").alias("kept"), F.col("heuristic_stripped").alias("stripped"), F.map_contains_key("provenance", "sponsor_companies").alias("has_provenance"))


_EVIDENCE = "case when k % 2 = 0 then speaker || ' chairs it' else country || ' unheard of' end"


@query("validate_llm_record", ep.sql("main") + f"select k, case when contains(lower(' ' || replace(main, '><', '> <')), lower(city)) then city end as city, case when k % 3 = 0 then name end as event_name, case when k % 2 = 0 then speaker else '' end as speakers, ((k % 3 <> 0)::int + (k % 2 <> 0)::int)::int as stripped from pg")
def validate_llm_record(spark, d):
    k = F.col("k")
    rows = ep.events(spark, d).withColumn("_body", text.normalize_for_match(F.concat_ws(" ", "name", "city", F.concat("speaker", F.lit(" chairs it"))))).withColumns({
        "event_name": F.when(k % 3 == 0, F.col("name")).otherwise("No such event anywhere"), "zip_code": F.lit(""),
        "speakers": F.array(F.struct(F.col("speaker").alias("name"), F.expr(_EVIDENCE).alias("evidence_snippet"), F.lit(None).cast("string").alias("details"))),
    })
    out = evidence.validate_llm_record(rows, ["city", "event_name", "zip_code"], ["speakers"], "_body")
    return out.select("k", "city", "event_name", F.array_join(F.transform("speakers", lambda x: x["name"]), "|").alias("speakers"), F.col("llm_stripped").alias("stripped"))


# --- the job ---------------------------------------------------------------------------------------------------------


def _captured(spark, d):
    """Pages of each event by role, with its event id; an eighth of the events have none."""
    made = ep.pages(spark, d, "listing", "main", "sponsors").filter("k % 8 <> 7")
    page = lambda role, rank, url: F.struct(F.lit(role).alias("role"), F.lit(rank).alias("role_rank"), url.alias("page_url"), F.col(role).alias("html"), F.lit(True).alias("fetch_ok"), F.lit("ok").alias("fetch_note"))
    # listings are read before the others, and so are rows of their own; the others come from one run of the events' joins
    rows = lambda *parts: made.select(F.col("k").alias("event_id"), F.inline(F.array(*parts)))
    listing = page("listing", 0, F.concat(F.lit("https://conferenceindex.org/event/"), "slug"))
    return rows(listing).unionByName(rows(page("main", 2, F.col("site")), page("sponsors", 4, F.concat("site", F.lit("/sponsors-"), F.col("k").cast("string")))))


_JOB_NAME = f"coalesce(case when k % 5 < 3 then {_get(_EVENT, '$.name')} else {_OG} end, '')"
_THIRD = "'Third ' || speaker"


@query(
    "parse_event_pages",
    ep.sql("main", "sponsors") + f"select k as event_id, case when k % 2 = 0 then 'Seed of ' || name else {_OWN_NAME} end as event_name, {_OWN_START} as start_date, {_OWN_HOST} as hosting_entity, {_get(_PLACE, '$.name')} as venue_name, {_LOGO} || '|' || {_CARD.format(1)} || '|Site|' || {_THIRD} as sponsors, "
    f"case when k % 7 = 0 then 'heuristic,cleared' else 'heuristic' end as state, case when {_EVENT} is null then 'meta' else 'json_ld' end as name_source from pg",
)
def parse_event_pages(spark, d):
    made = ep.pages(spark, d, "main", "sponsors")
    seeds = made.select(F.col("k").alias("event_id"), *[(F.when(F.col("k") % 2 == 0, F.concat(F.lit("Seed of "), "name")) if f == "event_name" else F.col("site") if f == "event_url" else F.lit(None).cast("string")).alias(f) for f in event_page.RECORD])
    page = lambda role, rank: F.struct(F.lit(role).alias("role"), F.lit(rank).alias("role_rank"), F.col("site").alias("url"), F.col(role).alias("html"))
    out = enrich.parse_event_pages(seeds, made.select(F.col("k").alias("event_id"), F.inline(F.array(page("main", 2), page("sponsors", 4)))))
    of = lambda f: F.try_element_at("field_provenance", F.lit(f))["source"]
    return out.select("event_id", "event_name", "start_date", "hosting_entity", "venue_name", F.array_join("sponsor_companies", "|").alias("sponsors"), F.concat_ws(",", of("sponsor_companies"), F.when(F.col("program_unpublished_lists_cleared") > 0, "cleared")).alias("state"), of("event_name").alias("name_source"))


#: A model's answer to an event's main page: a text and companies of which the page holds some, in fences or not, and answers that can't be read.
_SAID = """'{"address_2":"' || case when k % 3 = 0 then partner else 'Nowhere Road 99999' end || '","attending_companies":[{"name":"' || host || '","details":"Guest","evidence_snippet":"Partner of ' || host || '"},{"name":"Ghost Corporation","evidence_snippet":"No such text on it"},"' || speaker || '"]}'"""
_ANSWER = f"case k % 4 when 0 then {_SAID} when 1 then '```json' || chr(10) || {_SAID} || chr(10) || '```' when 2 then '[1, 2]' else '{{\"address_2\": ' end"
_SAID_J = "json_extract_string(j, '$.{}')"


@query(
    "answered_event_pages",
    ep.sql("main") + f", a as (select *, {_ANSWER} as raw from pg), b as (select *, regexp_replace(regexp_replace(raw, '^```(json)?\\s*', ''), '\\s*```$', '') as t from a), "
    "c as (select *, case when json_valid(t) then case when json_type(t) = 'OBJECT' then t end end as j from b), "
    "e as (select *, lower(regexp_replace(regexp_replace(main, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) as shown, json_extract(j, '$.attending_companies[*]') as firms from c), "
    "f as (select *, list_transform(firms, lambda x: case when json_type(x) = 'OBJECT' then json_extract_string(x, '$.name') else json_extract_string(x, '$') end) as names, "
    "list_transform(firms, lambda x: contains(shown, lower(coalesce(json_extract_string(x, '$.evidence_snippet'), json_extract_string(x, '$'))))) as good, contains(shown, lower(json_extract_string(j, '$.address_2'))) as placed from e) "
    "select k as event_id, case when placed then json_extract_string(j, '$.address_2') end as address_2, "
    "coalesce(array_to_string(list_filter(names, lambda x, i: good[i]), '|'), '') as attending, "
    "(case when j is null then 0 else (not placed)::int + len(list_filter(good, lambda g: not g)) end)::int as stripped, "
    "(case when j is null then 0 else placed::int + (len(list_filter(good, lambda g: g)) > 0)::int end)::int as merged, "
    "case when j is not null then 'llm: used (stripped ' || ((not placed)::int + len(list_filter(good, lambda g: not g))) || ' ungrounded)' end as note, "
    "case when j is null then case when json_valid(t) then 'no object' else 'not JSON' end end as rejected from f",
)
def answered_event_pages(spark, d):
    made = ep.pages(spark, d, "main")
    seeds = made.select(F.col("k").alias("event_id"), *[(F.col("site") if f == "event_url" else F.lit(None).cast("string")).alias(f) for f in event_page.RECORD])
    main = made.select(F.col("k").alias("event_id"), F.lit("main").alias("role"), F.lit(2).alias("role_rank"), F.col("site").alias("url"), F.col("main").alias("html"))
    answers, rejected = files.read_answers(made.select(F.col("k").alias("event_id"), F.expr(_ANSWER).alias("raw")))
    out = enrich.parse_event_pages(seeds, main, answers).join(rejected.select("event_id", F.col("reason").alias("rejected")), "event_id", "left")
    note = F.get(F.filter("enrich_notes", lambda n: n.startswith("llm:")), 0)
    attending = F.array_join(F.transform("attending_companies", lambda x: x["name"]), "|")
    return out.select("event_id", "address_2", attending.alias("attending"), F.col("validation.llm_stripped").alias("stripped"), F.col("validation.llm_merged_fields").alias("merged"), note.alias("note"), "rejected")


@query(
    "enrich_events",
    ep.sql("listing", "main", "sponsors") + f", x as (select *, k % 8 = 7 as bare, k % 4 = 1 as own from pg), y as (select *, {_LISTING_URL} as listing_url from x) "
    "select k as event_id, name as event_name, case when own then site || '/' else listing_url end as event_url, case when not bare then city end as city, "
    f"case when not bare then day end as start_date, case when own then regexp_extract(site, '//www.(.*)', 1) else 'conferenceindex.org' end as conference_domain, "
    f"case when own then {_LOGO} || '|' || {_CARD.format(1)} || '|Site|' || {_THIRD} else '' end as sponsors, case when bare then 'no pages fetched' else 'pages_fetched: listing, main, sponsors' end as last_note from y",
)
def enrich_events(spark, d):
    made = ep.events(spark, d)
    listing = F.concat(F.lit("https://conferenceindex.org/event/"), "slug")
    items = made.select(F.col("k").alias("event_id"), "name", listing.alias("event_url"))
    hits = made.filter("k % 4 = 1").select(F.col("k").alias("event_id"), F.lit(0).alias("hit_pos"), F.concat("site", F.lit("/")).alias("url"), F.col("name").alias("title"), F.concat(F.lit("official site "), "city").alias("snippet"))
    out = enrich.enrich_events(items, _captured(spark, d), hits)
    return out.select("event_id", "event_name", "event_url", "city", "start_date", "conference_domain", F.array_join("sponsor_companies", "|").alias("sponsors"), F.element_at("enrich_notes", -1).alias("last_note"))


# --- readers ---------------------------------------------------------------------------------------------------------


@query("read_taxonomy", f"select doc_id, {_RULES.replace('x,', 't,')} as code from (select doc_id, lower(coalesce(text, '')) as t from documents)")
def read_taxonomy(spark, d):
    path = files.export_path(spark, "taxonomy")
    files.write_taxonomy(spark, taxonomy.DEFAULT, path)
    return fx.read(spark, d, "documents").select("doc_id", taxonomy.map_industry(F.col("text"), files.read_taxonomy(spark, path).industries).alias("x")).select("doc_id", "x.code")


def _saved(spark, d):
    """Pages as files ``<event>/<role>.html``, written by the tasks that hold them."""
    folder = files.export_path(spark, "saved")
    roles = F.get(F.array(*map(F.lit, ("listing", "main", "program"))), (F.col("page_id") % 3).cast("int"))
    rows = fx.read(spark, d, "pages").select(F.concat(F.lit("event-"), F.expr("page_id div 3").cast("string")).alias("event_id"), roles.alias("role"), "html")
    files.save_page_files(rows, folder)
    return folder


@query("read_page_bundle", "select 'event-' || (page_id // 3) as event_id, (['listing', 'main', 'program'])[(page_id % 3) + 1] as role, md5(html) as digest from pages")
def read_page_bundle(spark, d):
    return files.read_page_bundle(spark, _saved(spark, d)).select("event_id", "role", F.md5(F.col("html").cast("binary")).alias("digest"))


@query("read_listing_pages", "select 'event-' || (page_id // 3) || '/' || (['listing', 'main', 'program'])[(page_id % 3) + 1] || '.html' as file, len(html) as n_chars from pages")
def read_listing_pages(spark, d):
    return files.read_listing_pages(spark, _saved(spark, d) + "/*/*.html").select(F.regexp_extract("url", "[^/]+/[^/]+$", 0).alias("file"), F.length("html").cast("long").alias("n_chars"))
