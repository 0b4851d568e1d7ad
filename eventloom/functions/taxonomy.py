"""Industry and scope rules as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.urls import any_of, let, text_of

# The taxonomy. Industry rules go in order, and a rule holds where one of its strings is found.
RULE_VERSION = "1.0-data-txt"
B2B = ("b2b", "trade show", "trade fair", "expo", "exhibition", "conference", "summit", "congress", "symposium", "forum", "professional", "industry", "business", "networking", "exhibitor", "sponsor", "delegate", "corporate")
PENALTIES = ("music festival", "food festival", "beer festival", "comic con fan", "consumer fair", "ticketed concert", "marathon", "fun run")
NETWORKING = ("networking", "matchmaking", "b2b meetings", "1:1 meetings", "meetups", "connect with", "business meetings", "researchers", "scientists", "scholars", "practitioners", "paper submission", "call for papers", "presentations", "authors")
INDUSTRIES = (
    ("HT", "Health Technology", ("health", "medical", "clinical", "hospital", "pharma", "biotech", "life science")),
    ("AI", "Artificial Intelligence", ("artificial intelligence", " machine learning", " deep learning", " ai ", "ml summit", "data science")),
    ("TECH", "Technology", ("tech", "software", "digital", "cloud", "cyber", "developer", "startup", "saas")),
    ("FIN", "Finance", ("finance", "fintech", "banking", "investment", "capital markets")),
    ("EDU", "Education", ("education", "learning", "university", "academic", "research")),
    ("MFG", "Manufacturing", ("manufacturing", "industrial", "engineering", "automation")),
    ("GEN", "General Business", ("business", "leadership", "management", "enterprise")),
)


@dataclass(frozen=True)
class Taxonomy:
    """Rules as the job takes them; see ``read_taxonomy`` for those of a file."""

    version: str = RULE_VERSION
    b2b: tuple[str, ...] = B2B
    penalties: tuple[str, ...] = PENALTIES
    networking: tuple[str, ...] = NETWORKING
    industries: tuple = INDUSTRIES
    require_b2b: bool = True
    require_engagement: bool = True


DEFAULT = Taxonomy()


def map_industry(blob: Column, rules=INDUSTRIES) -> Column:
    """``struct<code, label>`` of the first rule that holds, else null."""
    first = lambda low: F.coalesce(*[F.when(any_of(low, words), F.struct(F.lit(code).alias("code"), F.lit(label).alias("label"))) for code, label, words in rules])
    return let(F.lower(text_of(blob)), first)


def hits(blob: Column, words: tuple[str, ...], most: int) -> Column:
    return F.slice(F.filter(F.array(*map(F.lit, words)), lambda w: F.contains(blob, w)), 1, most)


def scope_blob(name: Column, description: Column, industry: Column, group: Column, raw: Column | None = None) -> Column:
    parts = [name, description, raw if raw is not None else F.lit(""), industry, group]
    return F.lower(F.concat_ws(" ", *[text_of(p) for p in parts]))


def evaluate_scope(blob: Column, exhibitors: Column, sponsors: Column, speakers: Column, taxonomy: Taxonomy = DEFAULT) -> Column:
    """The scope struct; the last three columns are arrays. ``blob`` is lower-case."""
    none = F.lit(False)
    has_any = lambda words: any_of(blob, words) if words else none
    b2b = has_any(taxonomy.b2b) & ~has_any(taxonomy.penalties)
    networking = has_any(taxonomy.networking)
    has = [F.coalesce(F.size(c) > 0, none) for c in (exhibitors, sponsors, speakers)]
    engaged = networking | has[0] | has[1] | has[2]
    in_scope = (b2b & engaged if taxonomy.require_b2b else engaged) if taxonomy.require_engagement else b2b
    evidence = F.struct(
        hits(blob, taxonomy.b2b, 8).alias("b2b_hits"), hits(blob, taxonomy.networking, 8).alias("networking_hits"), hits(blob, taxonomy.penalties, 5).alias("consumer_penalties"),
        F.struct(has[0].alias("exhibitors"), has[1].alias("sponsors"), has[2].alias("speakers")).alias("engagement"),
    )
    return F.struct(
        b2b.alias("b2b"), networking.alias("networking"), has[0].alias("has_exhibitors"), has[1].alias("has_sponsors"), has[2].alias("has_speakers"),
        in_scope.alias("in_scope"), F.lit(taxonomy.version).alias("scope_rule_version"), evidence.alias("scope_evidence"),
    )
