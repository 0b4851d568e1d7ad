"""Merging by key: first non-empty values, and provenance by priority of sources.

Merges of values are aggregations with ``min_by`` or ``max_by``, which combine before the shuffle: a key that
very many rows share costs no task more than others. A merged list is one row, as long as what its key merges.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.urls import let

# How much a source is trusted.
PRIORITY = {"json_ld": 90, "meta": 80, "listing": 75, "heuristic": 60, "regex": 55, "taxonomy": 50, "derived": 40, "llm": 20, "seed": 10}
SOURCE_RANK = {"listing": 0, "featured": 1, "jsonld": 2, "window_open": 3, "anchor": 4}


def nonempty(c: Column) -> Column:
    return c.isNotNull() & (c != "")


def priority(source: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for p in PRIORITY.items() for x in p]), source), F.lit(0))


def first_nonempty(column: str, *order: str) -> Column:
    """An aggregate: the value of the first row, by ``order``, whose value is neither null nor empty."""
    c = F.col(column)
    return F.min_by(F.when(nonempty(c), c), F.when(nonempty(c), F.struct(*order))).alias(column)


def merge_events(found: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """One row per canonical URL: first raw URL, sources in order, first non-empty value of each field.

    ``found`` has ``canonical, event_url, source, src_rank, pos`` and the fields. Rows without a canonical URL go.
    """
    order = F.struct("src_rank", "pos")
    merged = found.filter(F.col("canonical") != "").groupBy(*keys, "canonical").agg(
        F.min_by("event_url", order).alias("event_url"),
        F.array_sort(F.collect_set(F.struct("src_rank", "source"))).alias("_s"),
        *[first_nonempty(f, "src_rank", "pos") for f in fields],
    )
    return merged.withColumn("sources", F.transform("_s", lambda s: s["source"])).drop("_s")


def merge_records(partials: DataFrame, key: str, scalars: list[str], lists: list[str], rank: str) -> DataFrame:
    """Folds the partial records of a key in order: scalars by first non-empty, lists one after the other."""
    return partials.groupBy(key).agg(
        *[first_nonempty(s, rank) for s in scalars],
        *[F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(n).alias("v")))), lambda x: F.coalesce(x["v"], F.array()))).alias(n) for n in lists],
    )


def merge_provenance(facts: DataFrame, key: str, rank: str, entry: list[str], field: str = "field", source: str = "source") -> DataFrame:
    """Of each key and field, the entry of the most trusted source; of equals, the last."""
    best = F.max_by(F.struct(*entry), F.struct(priority(F.col(source)).alias("p"), F.col(rank).alias("r")))
    return facts.groupBy(key, field).agg(best.alias("_e")).select(key, field, "_e.*")


def first_of_each(items: Column, key) -> Column:
    """An array's items, of those of equal ``key(item)`` the first; their order stays."""

    def pick(values: Column) -> Column:
        at = lambda keys: lambda k: F.get(values, F.array_position(keys, k).cast("int") - 1)
        return let(F.transform(values, key), lambda keys: F.transform(F.array_distinct(keys), at(keys)))

    return let(items, pick)


def merge_of_entries(held: Column, more: Column, always: bool = False) -> Column:
    """Two maps of provenance by field: the newer entry is taken where its source is trusted as much as the older's, or ``always``."""

    def taken(x: Column) -> Column:
        def newer(field: Column, entry: Column) -> Column:
            own = F.try_element_at(x["held"], field)
            return own.isNull() | F.lit(always) | (priority(entry["source"]) >= priority(own["source"]))

        return F.struct(x["held"].alias("held"), F.map_filter(x["more"], newer).alias("taken"))

    # each map is worked out once, not for every entry of the other
    joined = lambda x: F.map_concat(F.map_filter(x["held"], lambda f, _: ~F.map_contains_key(x["taken"], f)), x["taken"])
    return let(let(F.struct(held.alias("held"), more.alias("more")), taken), joined)


def _accepted(facts: DataFrame, key: str, rank: str, field: str, source: str) -> DataFrame:
    """Facts whose source is trusted at least as much as that of the last accepted one before them.

    A source that is missing counts as heuristic for the test, and doesn't become the current one. As accepted
    sources only rise, the current one is the highest before: a fact goes where a fact of a higher source
    has a smaller rank. For each of the few sources its first rank is aggregated, so no key's facts are sorted.
    """
    own = F.coalesce(F.col(source), F.lit("heuristic"))
    rows = facts.withColumn("_p", priority(own))
    levels = sorted({0, *PRIORITY.values()})
    sourced = F.when(F.col(source).isNotNull(), F.col("_p"))
    first = rows.groupBy(key, field).agg(*[F.min(F.when(sourced > p, F.col(rank))).alias(f"_a{p}") for p in levels])
    above = F.lit(None)
    for p in levels:
        above = F.when(F.col("_p") == p, F.col(f"_a{p}")).otherwise(above)
    late = F.coalesce(above < F.col(rank), F.lit(False))
    return rows.join(first, [key, field]).filter(~late).drop(*[f"_a{p}" for p in levels], "_p")


def merge_lists_with_provenance(facts: DataFrame, key: str, rank: str, value: str, field: str = "field", source: str = "source") -> DataFrame:
    """Appends a list's values while their source is trusted at least as much as that of the last accepted one."""
    kept = _accepted(facts, key, rank, field, source)
    return kept.groupBy(key, field).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(rank).alias("r"), F.col(value).alias("v")))), lambda x: x["v"]).alias("merged"))


def merge_scalars_with_provenance(facts: DataFrame, key: str, rank: str, value: str, field: str = "field", source: str = "source") -> DataFrame:
    """Each field's first value that isn't empty, and the source that it came with; what comes later replaces neither."""
    own = facts.filter(nonempty(F.col(value)))
    first = F.min_by(F.struct(F.col(value).alias("value"), F.col(source).alias("source")), rank)
    sourced = F.min_by(source, F.when(F.col(source).isNotNull(), F.col(rank)))
    out = own.groupBy(key, field).agg(first.alias("f"), sourced.alias("_later"))
    return out.select(key, field, "f.value", F.coalesce("f.source", "_later").alias("source"))


def ordered_dedupe(rows: DataFrame, keys: list[str], name: str, order: str) -> DataFrame:
    """The first row of each name, compared in lower case and trimmed; empty names go.

    An aggregation that combines before the shuffle, so a name that very many rows share is no task of its own.
    """
    named = rows.filter(F.coalesce(F.trim(F.col(name)), F.lit("")) != "").withColumn("_folded", F.lower(F.trim(F.col(name))))
    rest = [c for c in rows.columns if c not in keys]
    return named.groupBy(*keys, "_folded").agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def verified_field_count(entries: list[tuple[Column, Column, Column]]) -> Column:
    """Filled fields from another source than a model, or from a model with a snippet: (filled, source, snippet) each."""
    one = [F.when(filled & source.isNotNull() & ((source != "llm") | nonempty(snippet)), 1).otherwise(0) for filled, source, snippet in entries]
    return sum(one[1:], one[0])
