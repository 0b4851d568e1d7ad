"""Field coverage and the review queue: all row by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.urls import is_listing_host, review_url_norm, strip, text_of
from eventloom.operators.merge import verified_field_count

# The fields of a record, in order.
SCALARS = (
    "conference_domain", "conference_group_name", "conference_group_description", "industry_methodology", "event_name", "start_date", "end_date",
    "event_url", "exhibitor_crawler_url", "sponsor_crawler_url", "venue_name", "address_1", "address_2", "city", "country", "state_province",
    "zip_code", "event_description_methodology", "hosting_entity", "conference_group", "industry",
)
LISTS = ("attending_companies", "exhibitor_companies", "exhibitor_company_websites", "sponsor_companies", "sponsor_company_websites", "speakers")
FIELDS = SCALARS + LISTS
NAMED = {"conference_domain": "Conference Domain", "conference_group_name": "Conference Group Name", "conference_group_description": "Conference Group Description", "industry_methodology": "Industry (methodology code)",
    "event_name": "Event Name", "start_date": "Start Date", "end_date": "End Date", "event_url": "Event URL", "exhibitor_crawler_url": "Exhibitor Crawler URL", "sponsor_crawler_url": "Sponsor Crawler URL", "venue_name": "Venue Name",
    "address_1": "Address 1", "address_2": "Address 2", "city": "City", "country": "Country", "state_province": "State/Province", "zip_code": "Zip code", "event_description_methodology": "Event Description",
    "hosting_entity": "Hosting Entity", "conference_group": "Conference Group", "industry": "Industry"}
#: Fields that share their number with the one before.
SAME_NUMBER = ("end_date", "address_2")
SCOPE_FLAGS = ("b2b", "networking", "has_exhibitors", "has_sponsors", "has_speakers", "in_scope")


def labels() -> dict[str, str]:
    """Each field's numbered label."""
    out, number = {}, 0
    for f in FIELDS:
        number += f not in SAME_NUMBER
        out[f] = f"{number}) {NAMED.get(f) or f.replace('_', ' ').title()}"
    return out


def filled(field: str) -> Column:
    """Whether a field counts: a scalar of more than white space, a list of one or more."""
    return F.coalesce(F.size(field) > 0, F.lit(False)) if field in LISTS else strip(text_of(F.col(field))) != ""


def field_coverage(records: DataFrame) -> DataFrame:
    """Adds ``has_<field>`` for all fields, ``filled_count, total_count, coverage_pct, missing_fields`` and ``data_completeness``."""
    out = records.withColumns({f"has_{f}": filled(f) for f in FIELDS})
    return coverage_of_flags(out)


def coverage_of_flags(flags: DataFrame) -> DataFrame:
    missing = F.array_compact(F.array(*[F.when(~F.col(f"has_{f}"), f) for f in FIELDS]))
    out = flags.withColumn("_missing", missing).withColumn("total_count", F.lit(len(FIELDS)))
    out = out.withColumn("filled_count", F.lit(len(FIELDS)) - F.size("_missing"))
    out = out.withColumn("coverage_pct", F.round(F.lit(100.0) * F.col("filled_count") / F.col("total_count"), 1))
    out = out.withColumn("missing_fields", F.array_join("_missing", ", ")).drop("_missing")
    return out.withColumn("data_completeness", data_completeness(F.col("coverage_pct")))


def data_completeness(pct: Column) -> Column:
    return F.when(pct >= 70, "full").when(pct >= 40, "partial").otherwise("minimal")


def review_reasons(confidence_least: float = 0.5, coverage_least: float = 45.0) -> Column:
    """Why a person should look at a record, in order. Needs the columns of ``field_coverage``, validation counts and scope."""
    listing = F.coalesce(F.nullif(F.col("listing_url"), F.lit("")), F.col("event_url"))
    official = F.col("event_url")
    both = (text_of(official) != "") & (text_of(listing) != "")
    by_llm = F.exists(F.array(*[F.struct((F.size(n) > 0).alias("has"), F.try_element_at("field_provenance", F.lit(n))["source"].alias("s")) for n in ("speakers", "exhibitor_companies", "sponsor_companies")]), lambda x: x["has"] & (F.coalesce(x["s"], F.lit("")) == "llm"))
    engaged = F.col("scope.has_exhibitors") | F.col("scope.has_sponsors") | F.col("scope.has_speakers")
    return F.array_compact(
        F.array(
            F.when(F.col("llm_stripped") > 0, F.concat(F.lit("llm_ungrounded:"), F.col("llm_stripped"))),
            F.when(F.col("heuristic_stripped") > 0, F.concat(F.lit("heuristic_ungrounded:"), F.col("heuristic_stripped"))),
            F.when(F.col("program_unpublished_lists_cleared") > 0, "program_not_published"),
            F.when((F.col("resolution_confidence") < confidence_least) & both & (review_url_norm(official) != review_url_norm(listing)), "low_official_url_confidence"),
            F.when(is_listing_host(listing) & is_listing_host(official), "aggregator_only_no_official_site"),
            F.when(F.col("coverage_pct") < coverage_least, "low_field_coverage"),
            F.when(F.col("scope.in_scope") & ~engaged, "in_scope_without_engagement_lists"),
            F.when(by_llm, "llm_sourced_lists"),
            F.when(F.exists("enrich_notes", lambda n: F.lower(n).contains("location mismatch")), "official_url_location_mismatch"),
        )
    )


def with_review(records: DataFrame) -> DataFrame:
    """``records`` with coverage, ``review_reasons`` and ``needs_review``."""
    out = field_coverage(records).withColumn("review_reasons", review_reasons())
    return out.withColumn("needs_review", F.size("review_reasons") > 0)


def coverage_flags(records: DataFrame, *keys: str) -> DataFrame:
    """All that ``summary_rows`` and ``coverage_details`` read: name, URL, the scope's flags, and a flag per field."""
    return records.select(*keys, "event_name", "event_url", F.struct(*[F.col(f"scope.{n}").alias(n) for n in SCOPE_FLAGS]).alias("scope"), *[filled(f).alias(f"has_{f}") for f in FIELDS])


def summary_rows(records: DataFrame, *keys: str) -> DataFrame:
    """A flat row per record: name, URL, counts, what is missing, scope, and a flag per field."""
    return summary_of_flags(coverage_flags(records, *keys), *keys)


def summary_of_flags(flags: DataFrame, *keys: str) -> DataFrame:
    out = coverage_of_flags(flags)
    return out.select(*keys, "event_name", "event_url", "filled_count", "total_count", "coverage_pct", "missing_fields", F.col("scope.in_scope").alias("scope_in_scope"), *[f"has_{f}" for f in FIELDS])


def coverage_details(records: DataFrame, *keys: str) -> DataFrame:
    """Per record: counts, filled and missing fields, a flag and a label per field, and the scope's flags."""
    return details_of_flags(coverage_flags(records, *keys), *keys)


def details_of_flags(flags: DataFrame, *keys: str) -> DataFrame:
    out = coverage_of_flags(flags)
    names = lambda has: F.array_compact(F.array(*[F.when(F.col(f"has_{f}") == has, f) for f in FIELDS]))
    pairs = lambda kv: F.map_from_arrays(F.array(*[F.lit(k) for k, _ in kv]), F.array(*[v for _, v in kv]))
    return out.select(
        *keys, "filled_count", "total_count", F.col("coverage_pct").alias("pct"), names(True).alias("filled"), names(False).alias("missing"), pairs([(f, F.col(f"has_{f}")) for f in FIELDS]).alias("fields"),
        pairs([(f"scope_{n}", F.coalesce(f"scope.{n}", F.lit(False))) for n in SCOPE_FLAGS]).alias("scope"), pairs([(f, F.lit(n)) for f, n in labels().items()]).alias("labels"),
    )


def verified_fields(provenance: str = "field_provenance") -> Column:
    """How many of a record's texts and entity lists come from another source than a model, or from one with a snippet."""
    told = lambda f: F.try_element_at(provenance, F.lit(f))
    texts = [(F.coalesce(F.col(f) != "", F.lit(False)), told(f)["source"], told(f)["snippet"]) for f in (*SCALARS, "listing_url")]
    lists = [(F.coalesce(F.size(f) > 0, F.lit(False)), told(f)["source"], told(f)["snippet"]) for f in ("attending_companies", "exhibitor_companies", "sponsor_companies", "speakers")]
    return verified_field_count(texts + lists)


def review_rows(records: DataFrame, *keys: str) -> DataFrame:
    """The 17 columns of the review table for every record."""
    out = with_review(records)
    return out.select(
        *keys, "event_name", "event_url", "listing_url", "needs_review", F.array_join("review_reasons", "; ").alias("review_reasons"), "data_completeness", "coverage_pct", "filled_count", "missing_fields",
        F.col("resolution_confidence").cast("double").alias("resolution_confidence"), verified_fields().alias("verified_field_count"), "llm_stripped", "heuristic_stripped", F.col("scope.in_scope").alias("scope_in_scope"),
        F.col("scope.b2b").alias("scope_b2b"), F.col("scope.networking").alias("scope_networking"), F.array_join(F.slice("scope.scope_evidence.b2b_hits", 1, 3), "; ").alias("scope_evidence"),
    )
