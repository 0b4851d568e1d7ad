"""JSON-LD of pages as VARIANT expressions: nodes, event fields, addresses and the events of listing pages.

Scripts that aren't JSON are skipped. ``try_variant_get`` gives null for what is missing or of another kind, so no
shape of the data fails. Keys that an object holds twice, and NaN, make a script unreadable here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.text import methodology_description
from eventloom.functions.urls import is_event_detail_url, let
from eventloom.operators.merge import nonempty

#: How deep lists and graphs may lie in each other.
DEPTH = 3


def get(node: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(node, path, kind)


def items(node: Column, path: str = "$") -> Column:
    return get(node, path, "array<variant>")


def kind_of(node: Column) -> Column:
    """``STRING``, ``OBJECT<...>``, ``ARRAY<...>`` and so on."""
    return F.coalesce(F.schema_of_variant(node), F.lit("VOID"))


def is_object(node: Column) -> Column:
    return kind_of(node).startswith("OBJECT")


def said(node: Column, path: str) -> Column:
    """The value at a path if it is a text, and null if it is anything else."""
    return F.when(kind_of(get(node, path, "variant")) == "STRING", get(node, path))


def json_ld_nodes(scripts: Column, depth: int = 1) -> Column:
    """The objects of all scripts in order: lists are flattened, and graphs down to ``depth``."""
    values = F.filter(F.transform(scripts, F.try_parse_json), lambda v: v.isNotNull())
    nodes = F.flatten(F.transform(values, lambda v: F.coalesce(items(v), F.array(v))))
    for _ in range(depth):
        nodes = F.flatten(F.transform(nodes, lambda n: F.coalesce(items(n, '$["@graph"]'), items(n), F.array(n)) if depth > 1 else F.coalesce(items(n, '$["@graph"]'), F.array(n))))
    return F.filter(nodes, is_object)


def type_matches(node: Column, name: str, strict: bool = False) -> Column:
    """The node's type is ``name``, or a list that holds it or, unless ``strict``, a text with it as one of its words."""
    own = said(node, '$["@type"]')
    one = F.coalesce(own == name, F.lit(False)) if strict else F.coalesce(F.array_contains(F.split(own, r"(?U)\s+"), name), F.lit(False))
    return one | F.coalesce(F.array_contains(get(node, '$["@type"]', "array<string>"), name), F.lit(False))


def event_node(nodes: Column) -> Column:
    return F.get(F.filter(nodes, lambda n: type_matches(n, "Event", strict=True)), 0)


def organization_node(nodes: Column) -> Column:
    firm = lambda n: type_matches(n, "Organization", strict=True) | F.coalesce(said(n, '$["@type"]') == "Corporation", F.lit(False))
    return F.get(F.filter(nodes, firm), 0)


def address(event: Column) -> Column:
    """``struct`` of venue and postal fields of an event's place, or of the first of its places."""
    place = F.coalesce(F.get(items(event, "$.location"), 0), get(event, "$.location", "variant"))

    def read(p: Column) -> Column:
        plain = said(p, "$.address")
        venue = F.when(nonempty(get(p, "$.name")), get(p, "$.name")).otherwise(F.when(plain.isNull(), get(p, "$.address.name")))
        part = lambda n: get(p, f"$.address.{n}")
        return F.struct(
            venue.alias("venue_name"), F.coalesce(F.nullif(plain, F.lit("")), part("streetAddress")).alias("address_1"), part("addressLine2").alias("address_2"),
            part("addressLocality").alias("city"), part("addressRegion").alias("state_province"), part("postalCode").alias("zip_code"), part("addressCountry").alias("country"),
        )

    return let(place, read)


def event_fields(nodes: Column) -> Column:
    """``struct`` of what the first event says of itself, with the first organization as host where it names none.

    ``is_event``: there is an event. An organization that stands in as host also names and describes the group.
    """

    def read(both: Column) -> Column:
        event, firm = both["e"], both["o"]
        organizer = F.coalesce(F.when(is_object(get(event, "$.organizer", "variant")), get(event, "$.organizer.name")), said(event, "$.organizer"))
        stands_in = firm.isNotNull() & ~F.coalesce(nonempty(organizer), F.lit(False))
        return F.struct(
            event.isNotNull().alias("is_event"), get(event, "$.name").alias("event_name"), get(event, "$.startDate").alias("start_date"), get(event, "$.endDate").alias("end_date"),
            methodology_description(said(event, "$.description")).alias("event_description_methodology"),
            F.when(stands_in, get(firm, "$.name")).otherwise(organizer).alias("hosting_entity"), F.when(stands_in, get(firm, "$.name")).alias("conference_group_name"),
            F.when(stands_in, methodology_description(said(firm, "$.description"))).alias("conference_group_description"), address(event).alias("address"),
        )

    return let(let(nodes, lambda n: F.struct(event_node(n).alias("e"), organization_node(n).alias("o"))), read)


def _web(url: Column) -> Column:
    return F.when(url.startswith("http"), url)


def _event(node: Column, order: Column, position: Column) -> Column:
    """A listed event, null where the node is none or has no URL of its own or of its place."""
    places = F.coalesce(items(node, "$.location"), F.array(get(node, "$.location", "variant")))
    own = F.coalesce(_web(get(node, "$.url")), F.get(F.filter(F.transform(places, lambda p: _web(get(p, "$.url"))), lambda u: u.isNotNull()), 0))
    venue = get(F.get(F.filter(places, lambda p: type_matches(p, "Place")), 0), "$.name")
    row = F.struct(
        order.alias("order"), own.alias("event_url"), get(node, "$.name").alias("name"), get(node, "$.startDate").alias("start_date"), get(node, "$.endDate").alias("end_date"),
        venue.alias("venue"), position.alias("jsonld_position"), get(node, "$.image").alias("jsonld_image"),
    )
    return F.when(type_matches(node, "Event") & own.isNotNull(), row)


def listed_events(scripts: Column) -> Column:
    """``array<struct<order,event_url,name,start_date,end_date,venue,jsonld_position,jsonld_image>>`` of events and item lists."""
    none = F.lit(None).cast("string")

    def entry(e: Column, order: Column) -> Column:
        link, position = said(e, "$.item"), get(e, "$.position")
        row = F.struct(order.alias("order"), link.alias("event_url"), get(e, "$.name").alias("name"), none.alias("start_date"), none.alias("end_date"), none.alias("venue"), position.alias("jsonld_position"), none.alias("jsonld_image"))
        return F.when(link.isNotNull(), F.when(link.startswith("http") & is_event_detail_url(link), row)).otherwise(_event(get(e, "$.item", "variant"), order, position))

    def rows(n: Column, i: Column) -> Column:
        order = lambda j: F.struct(i.alias("node"), j.alias("entry"))
        listed = F.transform(F.coalesce(items(n, "$.itemListElement"), F.array().cast("array<variant>")), lambda e, j: entry(e, order(j)))
        return F.when(type_matches(n, "Event"), F.array(_event(n, order(F.lit(0)), none))).when(type_matches(n, "ItemList"), listed)

    found = F.flatten(F.filter(F.transform(json_ld_nodes(scripts, DEPTH), rows), lambda r: r.isNotNull()))
    return F.filter(found, lambda r: r.isNotNull())
