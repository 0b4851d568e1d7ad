"""Queries of the readers, writers and record steps; what is written is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventloom.functions import taxonomy
from eventloom.jobs import event_pages as ep
from eventloom.jobs import event_queries
from eventloom.jobs import fixtures as fx
from eventloom.jobs.registry import _BLOB, _FLAG, _IN_SCOPE, _LINKS, _REASONS, _REVIEW, _SUMMARY, _UNESCAPE, _VERIFIED, W_RECORDS, _hits, _in, _scoped, query
from eventloom.operators import coverage, evidence, pages, records
from eventloom.sources import files

_REVIEWED = f"(select *, {_REASONS} as reasons from (select *, {_BLOB} as blob from rec))"


def _reviewed(spark, d):
    return coverage.with_review(_scoped(fx.records(spark, d)))


@query("review_reasons", W_RECORDS + f"select reason, count(*) as n from (select unnest(string_split(reasons, '; ')) as reason from {_REVIEWED} where reasons <> '') group by 1")
def review_reasons(spark, d):
    return _reviewed(spark, d).select(F.explode("review_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("needs_review", W_RECORDS + f"select k, reasons <> '' as needs_review from {_REVIEWED}")
def needs_review(spark, d):
    return _reviewed(spark, d).select("k", "needs_review")


@query("event_summary", W_RECORDS + f"select k, event_name, event_url, {_IN_SCOPE} as in_scope from {_REVIEWED}")
def event_summary(spark, d):
    return _scoped(fx.records(spark, d)).select("k", "event_name", "event_url", F.col("scope.in_scope").alias("in_scope"))


@query("scope_evidence", W_RECORDS + f"select k, {_hits(taxonomy.B2B, 8)} as b2b_hits, {_hits(taxonomy.NETWORKING, 8)} as networking_hits, {_hits(taxonomy.PENALTIES, 5)} as penalties from {_REVIEWED}")
def scope_evidence(spark, d):
    hits = F.col("scope.scope_evidence")
    joined = lambda n: F.array_join(hits[n], "; ")
    return _scoped(fx.records(spark, d)).select("k", joined("b2b_hits").alias("b2b_hits"), joined("networking_hits").alias("networking_hits"), joined("consumer_penalties").alias("penalties"))


@query("split_confidence_exports", W_RECORDS + f", v as (select k, reasons = '' as sure from {_REVIEWED}) select k, 'main' as part from v where sure or not (select bool_or(sure) from v) union all select k, 'review' from v where not sure or (select bool_and(sure) from v)")
def split_confidence_exports(spark, d):
    sure, unsure = files.split_by_confidence(_reviewed(spark, d))
    return sure.select("k", F.lit("main").alias("part")).unionByName(unsure.select("k", F.lit("review").alias("part")))


@query("write_review", W_RECORDS + _REVIEW.replace("reasons as review_reasons", "nullif(reasons, '') as review_reasons").replace(" as scope_evidence from", " as evidence from").replace("select k,", "select * exclude (evidence), nullif(evidence, '') as scope_evidence from (select k,", 1) + ")")
def write_review(spark, d):
    path = files.export_path(spark, "review")
    given = _scoped(fx.records(spark, d))
    files.write_review(given, path, "k")
    return files.read_rows(spark, path, coverage.review_rows(given, "k").schema)


@query("write_coverage", W_RECORDS + _SUMMARY.replace(" from (select *,", ", array_to_string(list_filter([" + ", ".join(f"case when {v} then '{f}' end" for f, v in _FLAG.items()) + "], lambda x: x is not null), ',') as filled, '17) Hosting Entity' as label from (select *,", 1))
def write_coverage(spark, d):
    path = files.export_path(spark, "coverage")
    given = _scoped(fx.records(spark, d))
    files.write_coverage(given, path, "k")
    rows = files.read_rows(spark, f"{path}/rows", coverage.summary_rows(given, "k").schema)
    events = spark.read.schema(coverage.coverage_details(given, "k").schema).json(f"{path}/events")
    return rows.join(events.select("k", F.array_join("filled", ",").alias("filled"), F.try_element_at("labels", F.lit("hosting_entity")).alias("label")), "k")


@query(
    "write_enriched",
    W_RECORDS + f"select k, event_name, listing_url, to_json(speakers)::varchar as speakers, to_json(sponsor_companies)::varchar as sponsor_companies, to_json(['picked ' || hosting_entity])::varchar as resolution_notes, to_json({{'llm_stripped': llm_stripped}})::varchar as validation, "
    f"case when mismatch then '[\"Location mismatch (expected x)\"]' else '[]' end as enrich_notes, {_IN_SCOPE} as scope_in_scope, '1.0-data-txt' as scope_rule_version, 42 as n_columns from {_REVIEWED}",
)
def write_enriched(spark, d):
    path = files.export_path(spark, "enriched")
    rows = files.enriched_rows(_scoped(fx.records(spark, d)), "k")
    files.write_rows(rows, path)
    out = files.read_rows(spark, path, rows.schema)
    return out.select("k", "event_name", "listing_url", "speakers", "sponsor_companies", "resolution_notes", "validation", "enrich_notes", "scope_in_scope", "scope_rule_version", F.lit(len(out.columns)).alias("n_columns"))


@query("write_event_list", f"with {fx.BASE} select k, name, case when k % 3 <> 0 then d end as start_date from base")
def write_event_list(spark, d):
    path = files.export_path(spark, "events")
    items = fx.base(spark, d).select("k", "name", F.when(F.col("k") % 3 != 0, F.col("d")).alias("start_date"))
    files.write_event_list(items, path)
    return spark.read.schema(items.schema).json(path)


@query("read_event_list", f"with {fx.BASE} select k, name, d from base union all select -k, upper(name), d from base")
def read_event_list(spark, d):
    path = files.export_path(spark, "lists")
    item = lambda k, name: F.struct(k.alias("k"), name.alias("name"), "d")
    k, name = F.col("k"), F.col("name")
    fx.base(spark, d).select(F.to_json(F.struct(F.array(item(k, name), item(-k, F.upper(name))).alias("events")))).write.text(path)
    return files.read_event_list(spark, path).select("k", "name", "d")


@query("write_page_bundle", "select page_id // 3 as event_id, (['listing', 'program', 'main'])[(page_id % 3) + 1] as role, url as page_url, md5(html) as digest from pages")
def write_page_bundle(spark, d):
    path = files.export_path(spark, "bundle")
    role = F.get(F.array(*map(F.lit, ("listing", "program", "main"))), (F.col("page_id") % 3).cast("int"))
    given = fx.read(spark, d, "pages").select(F.expr("page_id div 3").alias("event_id"), role.alias("role"), F.col("url").alias("page_url"), "html")
    files.write_page_bundle(given, path)
    return spark.read.parquet(f"{path}/pages").select("event_id", "role", "page_url", F.md5(F.col("html").cast("binary")).alias("digest"))


@query(
    "write_dom_elements",
    r"""select page_id, count(*) as element_count, count(*) filter (e like '<a %href=%') as n_href from (select page_id, unnest(regexp_extract_all(regexp_replace(html, '(?s)<!--.*?-->|(<script>).*?</script>', '\1', 'g'), '<[a-z0-9]+[^>]*>')) as e from pages) group by page_id""",
)
def write_dom_elements(spark, d):
    path = files.export_path(spark, "dom")
    files.write_dom_elements(pages.dom_elements(fx.read(spark, d, "pages")), path)
    counts = spark.read.schema("page_id long, element_count long").json(f"{path}/counts")
    links = spark.read.schema("page_id long, tag string, attrs_json string").json(f"{path}/elements").filter("tag = 'a' and get_json_object(attrs_json, '$.href') is not null")
    return counts.join(links.groupBy("page_id").agg(F.count(F.lit(1)).alias("n_href")), "page_id", "left").fillna(0, ["n_href"])


@query("input_limit", f"with {fx.BASE} select k, name from base order by k limit 100")
def input_limit(spark, d):
    return fx.base(spark, d).select("k", "name").orderBy("k").limit(100)


#: A stored answer, over ``base``: an object in code fences, one with plain names, JSON that is no object, a broken text, nothing.
_RAW = """case k % 5 when 0 then '```json' || chr(10) || '{"event_name":"' || name || '","city":"' || city || '","other":1,"speakers":[{"name":"' || speaker || '","title":"Chair ' || k || '","evidence_snippet":"by ' || speaker || '"},"' || host || '",7]}' || chr(10) || '```'
    when 1 then '{"event_name":"' || name || '","speakers":["' || speaker || '","' || host || '"],"sponsor_companies":"' || host || '"}' when 2 then '[1, "' || name || '"]' when 3 then '{"event_name": "' || name else '' end"""


@query(
    "parse_llm_response",
    f"with {fx.BASE}, t as (select k, {_RAW} as raw from base), b as (select k, raw, regexp_replace(regexp_replace(raw, '^```(json)?\\s*', ''), '\\s*```$', '') as j from t), "
    "o as (select *, json_valid(j) as good, case when json_valid(j) then json_type(j) = 'OBJECT' else false end as obj from b), "
    "x as (select *, case when obj then j end as d, case when obj then json_extract(j, '$.speakers[*]') end as people from o) "
    "select k, json_extract_string(d, '$.event_name') as event_name, json_extract_string(d, '$.city') as city, "
    "array_to_string(list_transform(list_filter(people, lambda p: json_type(p) in ('OBJECT', 'VARCHAR')), lambda p: case when json_type(p) = 'OBJECT' "
    "then coalesce(json_extract_string(p, '$.name'), '') || '/' || coalesce(json_extract_string(p, '$.title'), '') || '/' || coalesce(json_extract_string(p, '$.evidence_snippet'), '') else json_extract_string(p, '$') || '//' end), '|') as speakers, "
    "case when trim(raw) = '' then 'no answer' when not good then 'not JSON' when not obj then 'no object' end as rejected from x",
)
def parse_llm_response(spark, d):
    out = fx.base(spark, d).select("k", files.parse_answer(F.expr(_RAW)).alias("x"))
    told = F.transform("x.speakers", lambda p: F.concat(*[x for n in ("name", "title", "evidence_snippet") for x in (F.coalesce(p[n], F.lit("")), F.lit("/" if n != "evidence_snippet" else ""))]))
    return out.select("k", "x.event_name", "x.city", F.array_join(told, "|").alias("speakers"), "x.rejected")


@query("seed_records", f"with {fx.BASE} select k, case when k % 3 = 0 then host else name end as event_name, case when k % 2 = 0 then city else country end as listing_url, d as start_date from base")
def seed_records(spark, d):
    k = F.col("k")
    items = fx.base(spark, d).select("k", F.when(k % 3 != 0, F.col("name")).otherwise("").alias("name"), F.col("host").alias("title"), F.when(k % 2 == 0, F.col("city")).alias("url"), F.col("country").alias("href"), F.col("d").alias("start_date"))
    return records.seed_records(items, "k").select("k", "event_name", "listing_url", "start_date")


_FALLBACK = "case when k % 3 = 2 then 'no date' else 'Held on 20' || substr(d, 3) || ' to 20' || substr(d, 3, 2) || '-12-31.' end"


@query("date_fallback", f"with {fx.BASE}, s as (select *, {_FALLBACK} as said from base), r as (select *, list_sort(regexp_extract_all(said, '20[0-9]{{2}}-[0-9]{{2}}-[0-9]{{2}}')) as i from s) select k, case when k % 4 = 0 then d else i[1] end as \"start\", case when k % 4 = 0 then 'own' else i[-1] end as \"end\" from r")
def date_fallback(spark, d):
    k = F.col("k")
    out = fx.base(spark, d).select("k", records.date_fallback(F.when(k % 4 == 0, F.col("d")).otherwise(""), F.lit("own"), F.expr(_FALLBACK)).alias("x"))
    return out.select("k", "x.start", "x.end")


_RULE = "case " + " ".join(f"when {_in('lower(description)', w)} then '{{}}'" for _, _, w in taxonomy.INDUSTRIES) + " end"


@query("fill_industry", f"with {fx.BASE} select k, case when k % 2 = 0 then 'OWN' else {_RULE.format(*[c for c, _, _ in taxonomy.INDUSTRIES])} end as code, case when k % 3 = 0 then 'Own' else {_RULE.format(*[n for _, n, _ in taxonomy.INDUSTRIES])} end as label from base")
def fill_industry(spark, d):
    k = F.col("k")
    out = fx.base(spark, d).select("k", records.fill_industry(F.when(k % 2 == 0, "OWN"), F.when(k % 3 == 0, "Own").otherwise(""), F.col("description")).alias("x"))
    return out.select("k", "x.code", "x.label")


@query("combined_page_text", r"select conv_id, md5(string_agg('--- ' || role || ' ---' || chr(10) || left(text, 6000), chr(10) || chr(10) order by turn)) as digest from conversations where text is not null and role is not null group by conv_id")
def combined_page_text(spark, d):
    turns = fx.read(spark, d, "conversations").filter("text is not null and role is not null")
    return evidence.combined_text(turns, "conv_id", "turn").select("conv_id", F.md5(F.col("combined_text").cast("binary")).alias("digest"))


@query("verified_field_count", W_RECORDS + f"select k, {_VERIFIED} as verified from rec")
def verified_field_count(spark, d):
    return fx.records(spark, d).select("k", coverage.verified_fields().alias("verified"))


@query("meta_tags", ep.sql("main") + "select k as page_id, " + event_queries._META + " as description, " + event_queries._OG + " as title from pg")
def meta_tags(spark, d):
    return pages.meta_tags(event_queries._page(spark, d, "main")).select("page_id", F.try_element_at("by_name", F.lit("description")).alias("description"), F.try_element_at("by_property", F.lit("og:title")).alias("title"))


@query("resolve_href", _LINKS + f"select page_id, pos, {_UNESCAPE.format('resolved')} as resolved from l")
def resolve_href(spark, d):
    return pages.page_links(fx.read(spark, d, "pages")).select("page_id", "pos", "resolved")
