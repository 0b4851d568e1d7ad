"""Event records derived from the relational tables: one event per order.

The library's inputs are captured pages, stored hits and stored answers. Where the given tables hold none,
queries derive them here from orders and their lines, so that their work grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORDS = ("summit", "expo", "conference", "marathon", "networking forum", "workshop", "trade fair", "software retreat")


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, name, d, city, country, host, speaker, description`` per order."""
    t = lambda n: read(spark, sf_dir, n)
    places = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "n_name", "r_name")
    first = F.min(F.struct("l_linenumber", "l_partkey", "l_suppkey")).alias("f")
    lines = t("lineitem").groupBy("l_orderkey").agg(first).select("l_orderkey", "f.l_partkey", "f.l_suppkey")
    joined = t("orders").select("o_orderkey", "o_custkey", "o_orderdate").join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
    joined = joined.join(t("part").select("p_partkey", "p_name", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    joined = joined.join(t("supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    joined = joined.join(t("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    word = F.get(F.array(*map(F.lit, WORDS)), (F.col("o_orderkey") % 8).cast("int"))
    return joined.select(
        F.col("o_orderkey").alias("k"), F.concat_ws(" ", "p_name", word).alias("name"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"),
        F.col("n_name").alias("city"), F.col("r_name").alias("country"), F.col("s_name").alias("host"), F.col("c_name").alias("speaker"),
        F.concat(F.col("p_type"), F.lit(" for "), F.col("c_mktsegment"), F.lit(" "), F.col("p_brand")).alias("description"),
    )


BASE = (
    "base as (select o_orderkey as k, p_name || ' ' || (["
    + ", ".join(f"'{w}'" for w in WORDS)
    + "])[(o_orderkey % 8) + 1] as name, strftime(o_orderdate, '%Y-%m-%d') as d, n_name as city, r_name as country, s_name as host, c_name as speaker, p_type || ' for ' || c_mktsegment || ' ' || p_brand as description "
    "from orders join (select l_orderkey, f.l_partkey as l_partkey, f.l_suppkey as l_suppkey from (select l_orderkey, min(struct_pack(l_linenumber, l_partkey, l_suppkey)) as f from lineitem group by 1)) on l_orderkey = o_orderkey join part on p_partkey = l_partkey join supplier on s_suppkey = l_suppkey "
    "join customer on c_custkey = o_custkey join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey)"
)


def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``k, url``: ten shapes of URLs by order, and those of the pages."""
    host = F.lower(F.replace("host", F.lit("#"), F.lit("-")))
    k = F.col("k").cast("string")
    shapes = [
        F.concat(F.lit("HTTPS://WWW."), host, F.lit(".Example.com/Event/"), k, F.lit("/?q=1#top")),
        F.concat(F.lit("http://allevents.in/events/item-"), k, F.lit(";v=2")),
        F.concat(F.lit("https://conferenceindex.org/conferences/"), k),
        F.concat(F.lit(" https://m.example.net/conference/"), k, F.lit("//")),
        F.concat(F.lit("/relative/event/"), k),
        F.concat(F.lit("https://news.example.org/blog/"), k, F.lit(".pdf")),
        F.concat(F.lit("https://x.eventbrite.com/e/summit-2026-july-oslo-no-"), k),
        F.lit(""),
        F.concat(F.lit("https://example.com:8080/events/create-"), k),
        F.concat(F.lit("https://www.wework.example.com/register?id="), k),
    ]
    made = base(spark, sf_dir).select("k", F.element_at(F.array(*shapes), (F.col("k") % 10 + 1).cast("int")).alias("url"))
    return made.unionByName(read(spark, sf_dir, "pages").select((-1 - F.col("page_id")).alias("k"), "url"))


URLS = (
    "urls as (select k, ([ 'HTTPS://WWW.' || lower(replace(host, '#', '-')) || '.Example.com/Event/' || k || '/?q=1#top', 'http://allevents.in/events/item-' || k || ';v=2', "
    "'https://conferenceindex.org/conferences/' || k, ' https://m.example.net/conference/' || k || '//', '/relative/event/' || k, 'https://news.example.org/blog/' || k || '.pdf', "
    "'https://x.eventbrite.com/e/summit-2026-july-oslo-no-' || k, '', 'https://example.com:8080/events/create-' || k, 'https://www.wework.example.com/register?id=' || k ])[(k % 10) + 1] as url from base "
    "union all select -1 - page_id, url from pages)"
)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with the fields of the coverage table, some of them empty by order key."""
    b = base(spark, sf_dir)
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey").join(read(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), F.col("l_suppkey") == F.col("s_suppkey"))
    sponsors = lines.groupBy(F.col("l_orderkey").alias("k")).agg(F.array_sort(F.collect_set("s_name")).alias("sponsors"))
    r = b.join(sponsors, "k")
    none, k = F.lit(None).cast("string"), F.col("k")
    empty = F.array().cast("array<string>")
    slug = F.lower(F.replace("host", F.lit("#"), F.lit("-")))
    official = F.concat(F.lit("https://www."), slug, F.lit(".example.com/event/"), k.cast("string"))
    listing = F.concat(F.lit("https://conferenceindex.org/event/"), k.cast("string"))
    when = lambda m, c: F.when(k % m != 0, c)
    return r.select(
        "k", F.col("name").alias("event_name"), when(5, F.col("d")).alias("start_date"), when(6, F.col("d")).alias("end_date"), when(7, F.col("city")).alias("city"),
        F.when(k % 4 == 0, " ").otherwise(F.col("country")).alias("country"), F.when(k % 3 == 0, listing).otherwise(official).alias("event_url"), F.when(k % 2 == 0, listing).alias("listing_url"),
        F.col("host").alias("hosting_entity"), F.col("description").alias("event_description_methodology"), when(9, F.col("host")).alias("conference_group"),
        F.concat(slug, F.lit(".example.com")).alias("conference_domain"), F.when(k % 8 == 1, F.lit("Software")).alias("industry"), none.alias("industry_methodology"),
        none.alias("conference_group_name"), none.alias("conference_group_description"), none.alias("exhibitor_crawler_url"), none.alias("sponsor_crawler_url"),
        F.when(k % 11 == 0, F.lit("Hall 1")).alias("venue_name"), none.alias("address_1"), none.alias("address_2"), none.alias("state_province"), none.alias("zip_code"),
        empty.alias("attending_companies"), empty.alias("exhibitor_companies"), empty.alias("exhibitor_company_websites"),
        F.when(k % 3 == 1, F.col("sponsors")).otherwise(empty).alias("sponsor_companies"), empty.alias("sponsor_company_websites"),
        F.when(k % 4 == 1, F.array("speaker")).otherwise(empty).alias("speakers"),
        (k % 3).cast("int").alias("llm_stripped"), F.when(k % 4 == 0, 2).otherwise(0).alias("heuristic_stripped"), F.when(k % 6 == 0, 1).otherwise(0).alias("program_unpublished_lists_cleared"),
        ((k % 10) / 10.0).alias("resolution_confidence"), F.when(k % 13 == 0, F.array(F.lit("Location mismatch (expected x)"))).otherwise(empty).alias("enrich_notes"),
        F.create_map(F.lit("speakers"), F.struct(F.when(k % 8 == 1, "llm").otherwise("heuristic").alias("source"), none.alias("page_url"), none.alias("page_role"), none.alias("snippet")), F.lit("city"), F.struct(F.lit("meta").alias("source"), none.alias("page_url"), none.alias("page_role"), F.col("city").alias("snippet"))).alias("field_provenance"),
        F.array(F.concat(F.lit("picked "), "host")).alias("resolution_notes"), F.struct((k % 3).cast("int").alias("llm_stripped")).alias("validation"),
    )


RECORDS = (
    "sp as (select l_orderkey as k, list_sort(list(distinct s_name)) as sponsors from lineitem join supplier on s_suppkey = l_suppkey group by 1), "
    "rec as (select base.k, name as event_name, case when base.k % 5 <> 0 then d end as start_date, case when base.k % 6 <> 0 then d end as end_date, case when base.k % 7 <> 0 then city end as city, "
    "case when base.k % 4 = 0 then ' ' else country end as country, case when base.k % 3 = 0 then 'https://conferenceindex.org/event/' || base.k else 'https://www.' || lower(replace(host, '#', '-')) || '.example.com/event/' || base.k end as event_url, "
    "case when base.k % 2 = 0 then 'https://conferenceindex.org/event/' || base.k end as listing_url, host as hosting_entity, description as event_description_methodology, case when base.k % 9 <> 0 then host end as conference_group, "
    "lower(replace(host, '#', '-')) || '.example.com' as conference_domain, case when base.k % 8 = 1 then 'Software' end as industry, case when base.k % 11 = 0 then 'Hall 1' end as venue_name, "
    "case when base.k % 3 = 1 then sponsors else []::varchar[] end as sponsor_companies, case when base.k % 4 = 1 then [speaker] else []::varchar[] end as speakers, (base.k % 3)::int as llm_stripped, "
    "case when base.k % 4 = 0 then 2 else 0 end as heuristic_stripped, case when base.k % 6 = 0 then 1 else 0 end as cleared, (base.k % 10) / 10.0 as confidence, base.k % 13 = 0 as mismatch, case when base.k % 8 = 1 then 'llm' else 'heuristic' end as speaker_source "
    "from base join sp using (k))"
)
#: Which of the fields hold something, as SQL over ``rec``; the others never do.
FLAGS = {
    "conference_domain": "true", "event_name": "true", "start_date": "start_date is not null", "end_date": "end_date is not null", "event_url": "true", "venue_name": "venue_name is not null",
    "city": "city is not null", "country": "trim(country) <> ''", "event_description_methodology": "true", "hosting_entity": "true", "conference_group": "conference_group is not null",
    "industry": "industry is not null", "sponsor_companies": "len(sponsor_companies) > 0", "speakers": "len(speakers) > 0",
}
