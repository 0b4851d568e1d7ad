"""Steps of a record's life: its seed from a list, dates and industry filled in later."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.taxonomy import INDUSTRIES, map_industry
from eventloom.functions.text import extract_dates, is_junk_speaker_record
from eventloom.functions.urls import domain_from_url, let, strip, text_of
from eventloom.operators.merge import first_of_each, nonempty

ENTITY = "struct<name:string,website:string,details:string>"
SPEAKER = "struct<name:string,title:string,company:string,details:string>"


def first_of(items: DataFrame, *names: str) -> Column:
    """The first of the columns, of those that there are, whose value isn't empty."""
    found = [F.when(nonempty(F.col(n)), F.col(n)) for n in names if n in items.columns]
    return F.coalesce(*found, F.lit(None).cast("string"))


def seed_records(items: DataFrame, *keys: str) -> DataFrame:
    url = first_of(items, "event_url", "url", "href")
    return items.select(
        *keys, first_of(items, "name", "title", "event_name").alias("event_name"), url.alias("listing_url"), url.alias("event_url"),
        first_of(items, "start_date").alias("start_date"), first_of(items, "end_date").alias("end_date"), first_of(items, "venue").alias("venue_name"),
    )


def date_fallback(start: Column, end: Column, text: Column, most: int = 12_000) -> Column:
    """``struct<start, end>``: where the start is missing, both come from the text, or are null with it."""
    own = F.struct(start.alias("start"), end.alias("end"))
    return let(own, lambda o: F.when(F.coalesce(nonempty(o["start"]), F.lit(False)), o).otherwise(extract_dates(F.substring(text, 1, most))))


def fill_industry(code: Column, label: Column, blob: Column, rules=INDUSTRIES) -> Column:
    """``struct<code, label>``: each is filled by the rules only where it is empty."""
    return let(map_industry(blob, rules), lambda found: F.struct(filled(code, found["code"]).alias("code"), filled(label, found["label"]).alias("label")))


def filled(*values: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.get(F.filter(F.array(*values), lambda v: v != ""), 0)


def normalize_entities(items: Column, speakers: bool = False) -> Column:
    """``array<struct<name, website, details>>`` of named items, the first of each name in lower case.

    A speaker's title, then the company, stands in for details that are missing. Null gives an empty list.
    """

    def one(x: Column) -> Column:
        details = filled(x["details"], x["title"], x["company"]) if speakers else filled(x["details"])
        website = F.lit(None).cast("string") if speakers else filled(x["website"])
        return F.struct(strip(text_of(x["name"])).alias("name"), website.alias("website"), details.alias("details"))

    empty = F.array().cast(f"array<{SPEAKER if speakers else ENTITY}>")
    named = F.filter(F.transform(F.coalesce(items, empty), one), lambda x: x["name"] != "")
    return first_of_each(named, lambda x: F.lower(x["name"]))


def split_companies(items: Column) -> Column:
    """``struct<names, websites>``: parallel lists of an entity list that is normalised already."""
    return F.struct(F.transform(items, lambda x: x["name"]).alias("names"), F.transform(items, lambda x: x["website"]).alias("websites"))


def finalize_speakers(items: Column) -> Column:
    """Speakers without what isn't a person; the details are the title too, unless they hold an address. Doing it twice changes nothing."""
    kept = F.filter(normalize_entities(items, speakers=True), lambda x: ~is_junk_speaker_record(x["name"]))
    title = lambda x: F.when(~text_of(x["details"]).contains("@"), x["details"])
    return F.transform(kept, lambda x: F.struct(x["name"].alias("name"), title(x).alias("title"), F.lit(None).cast("string").alias("company"), x["details"].alias("details")))


def finalize_record(records: DataFrame) -> DataFrame:
    """Normalised lists, the group and its name each standing in for the other, and the domain of the event's URL.

    ``exhibitors`` and ``sponsors`` are entity lists here; they are split into names and websites by ``with_company_lists``.
    """
    group, name = F.col("conference_group"), F.col("conference_group_name")
    return records.withColumns(
        {
            "speakers": finalize_speakers(F.col("speakers")),
            **{n: normalize_entities(F.col(n)) for n in ("attending_companies", "exhibitors", "sponsors")},
            "conference_group": filled(group, name),
            "conference_group_name": filled(name, group),
            "conference_domain": filled(F.col("conference_domain"), domain_from_url(F.col("event_url"))),
        }
    )


def with_company_lists(records: DataFrame) -> DataFrame:
    """The parallel name and website lists in place of ``exhibitors`` and ``sponsors``."""
    made = {}
    for kind in ("exhibitor", "sponsor"):
        both = split_companies(F.col(f"{kind}s"))
        made |= {f"{kind}_companies": both["names"], f"{kind}_company_websites": both["websites"]}
    return records.withColumns(made).drop("exhibitors", "sponsors")
