"""URL functions as column expressions.

Regular expressions on the raw string take the place of ``parse_url``, which raises on bad URLs and loses ports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SCHEME = r"^([A-Za-z][A-Za-z0-9+.-]*):"
NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
BEGIN = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]+)?"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"

# Hosts, path parts and names that decide what a URL is.
LISTING_HOSTS = ("conferenceindex.org", "10times.com", "allevents.in", "eventbrite")
HUB_PREFIXES = ("/conferences/", "/disciplines", "/locations", "/search", "/auth/", "/user/", "/page/", "/static/", "/favicon")
EVENTS_PAGES = ("create", "list", "index")
BAD_SUBPAGE = ("donor-form", "blackbaud", "login", "signup", "register", "cookie", "privacy", "terms", "facebook.com", "twitter.com", "linkedin.com")
BLOCKED_PATHS = ("/news/", "/article/", "/articles/", "/blog/", "/press/", "/press-release", "/donor-form", "/donate")
BLOCKED_HOSTS = (
    "conferenceindex.org", "10times.com", "allevents.in", "eventbrite.com", "eventbrite.co.uk", "facebook.com", "linkedin.com", "instagram.com",
    "twitter.com", "x.com", "youtube.com", "wikipedia.org", "meetup.com", "lanyrd.com", "conferencealerts.com", "expocenter.com", "tradefairdates.com",
    "google.com", "bing.com", "bookmyshow.com", "loc.gov", "archive.org", "scribd.com", "researchgate.net", "academia.edu", "travelandtourworld.com",
    "medium.com", "prnewswire.com", "businesswire.com", "globenewswire.com", "yahoo.com", "msn.com", "reddit.com", "pinterest.com", "tiktok.com", "blackbaud.com",
)
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
COUNTRIES = {
    "au": "Australia", "ca": "Canada", "us": "United States", "uk": "United Kingdom", "gb": "United Kingdom", "de": "Germany", "fr": "France",
    "in": "India", "cn": "China", "jp": "Japan", "kr": "South Korea", "sg": "Singapore", "my": "Malaysia", "ae": "United Arab Emirates",
    "nl": "Netherlands", "es": "Spain", "it": "Italy", "ch": "Switzerland", "se": "Sweden", "no": "Norway", "dk": "Denmark", "fi": "Finland",
    "pl": "Poland", "at": "Austria", "be": "Belgium", "ie": "Ireland", "nz": "New Zealand", "za": "South Africa", "br": "Brazil", "mx": "Mexico",
    "tr": "Turkey", "sa": "Saudi Arabia", "il": "Israel", "hk": "Hong Kong", "tw": "Taiwan", "th": "Thailand", "id": "Indonesia",
    "ph": "Philippines", "vn": "Vietnam", "pt": "Portugal", "gr": "Greece", "cz": "Czech Republic", "hu": "Hungary", "ro": "Romania",
}


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def any_of(column: Column, needles: tuple[str, ...]) -> Column:
    """Whether one of the needles is part of the string."""
    return reduce(Column.__or__, (column.contains(n) for n in needles))


#: Unicode's white space, as ``(?U)\\s`` has it.
SPACES = "".join(map(chr, (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(column: Column) -> Column:
    """Without white space at both ends, Unicode's included. Looks at the ends only, as no pattern does."""
    return F.btrim(column, F.lit(SPACES))


def text_of(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def netloc(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_of(url), NETLOC, 1))


def path(url: Column) -> Column:
    """The path without the parameters of its last segment."""
    return F.regexp_replace(F.regexp_extract(text_of(url), PATH, 1), r";[^/]*$", "")


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_of(url), SCHEME, 1))


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, path without slashes at its end; query, fragment and parameters go."""

    def joined(u: Column) -> Column:
        begin = F.lower(F.regexp_extract(u, BEGIN, 0))
        rest = F.regexp_replace(path(u), "/+$", "")
        return F.when(u == "", "").otherwise(F.concat(begin, F.when(rest == "", "/").otherwise(rest)))

    return let(strip(text_of(url)), joined)


def join_url(base: Column, href: Column) -> Column:
    """A reference without a scheme, resolved against an absolute http(s) URL; any other base leaves it as it is.

    Dot segments are folded, the base's query goes unless the reference has neither path nor query, and empty queries and
    fragments vanish.
    """
    begin = F.concat(scheme(base), F.regexp_extract(base, "^[^:]*(:[^?#]*?//[^/?#]+)", 1))
    own_path = F.regexp_extract(base, PATH, 1)
    part = lambda pattern: F.regexp_extract(href, pattern, 1)

    def folded(segments: Column) -> Column:
        up = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        step = lambda done, x: F.when(x == "..", up(done)).when(x == ".", done).otherwise(F.concat(done, F.array(x)))
        kept = F.aggregate(segments, F.array().cast("array<string>"), step)
        last = F.when(F.element_at(segments, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
        joined = F.array_join(F.concat(kept, last), "/")
        return F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))

    def below(path_: Column) -> Column:
        """The segments of a path that doesn't begin with a slash: those of the base's folder before it, without empty ones inside."""
        whole = F.split(F.concat(F.regexp_replace(own_path, "[^/]*$", ""), path_), "/")
        inside = F.filter(whole, lambda x, i: (i == 0) | (i == F.size(whole) - 1) | (x != ""))
        return F.when(own_path.rlike("^/"), inside).otherwise(F.concat(F.array(F.lit("")), F.filter(F.split(path_, "/"), lambda x, i: (i == F.size(F.split(path_, "/")) - 1) | (x != ""))))

    def resolved(p: Column) -> Column:
        there = F.when(p == "", own_path).when(p.startswith("/"), folded(F.split(p, "/"))).otherwise(folded(below(p)))
        query = part(r"^[^?#]*\?([^#]*)")
        query = F.when((p == "") & (query == ""), F.regexp_extract(base, r"^[^?#]*\?([^#]*)", 1)).otherwise(query)
        fragment = part("#(.*)$")
        return F.concat(begin, there, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))

    return (
        F.when(~F.coalesce(base.rlike("(?i)^https?://[^/?#]"), F.lit(False)), href).when(href == "", base)
        .when(href.startswith("//"), F.concat(scheme(base), F.lit(":"), F.regexp_replace(F.regexp_replace(href, r"^([^?#]*)\?(?=#|$)", "$1"), "#$", ""))).otherwise(let(part("^([^?#]*)"), resolved))
    )


def domain_from_url(url: Column) -> Column:
    return F.nullif(F.regexp_replace(netloc(url), r"^www\.", ""), F.lit(""))


def bare_host(url: Column, compat: bool = False) -> Column:
    """For comparing hosts. ``compat``: any ``w`` and ``.`` at the start go, not only one ``www.``."""
    return F.ltrim(netloc(url), F.lit("w.")) if compat else F.regexp_replace(netloc(url), r"^www\.", "")


def is_listing_host(url: Column) -> Column:
    return let(netloc(url), lambda host: any_of(host, LISTING_HOSTS))


def is_event_detail_url(url: Column) -> Column:
    """A detail page of one event, not a hub. Relative references never are.

    The path has a part ``event``, ``events`` or ``conference`` with a name after it; after ``events`` that
    isn't one of its own pages. Hubs are known by how the path begins; a plural ``conferences`` is one, unless events come after it.
    """

    def detail(parts: Column) -> Column:
        """``parts``: the path in lower case, split at slashes."""

        def names_event(part: Column, i: Column) -> Column:
            then = F.coalesce(F.get(parts, i + 1), F.lit(""))
            listed = (part == "events") & ~reduce(Column.__or__, (then.startswith(x) for x in EVENTS_PAGES))
            return (then != "") & (part.isin("event", "conference") | listed)

        return F.size(F.filter(parts, names_event)) > 0

    def fit(low: Column) -> Column:
        bare = F.regexp_replace(low, "/+$", "")
        hub = reduce(Column.__or__, (low.startswith(x) | (bare == x.rstrip("/")) for x in HUB_PREFIXES))
        plural = low.contains("/conferences/") & ~low.contains("/event/") & ~low.contains("/events/")
        return ~hub & ~plural & let(F.split(low, "/"), detail)

    u = strip(text_of(url))
    return scheme(u).isin("http", "https") & let(F.lower(path(u)), fit)


def is_bad_subpage(url: Column) -> Column:
    return let(F.lower(text_of(url)), lambda low: low.endswith(".pdf") | any_of(low, BAD_SUBPAGE))


def is_blocked_url(url: Column) -> Column:
    listed = lambda host: host.rlike(r"(^|\.)(" + "|".join(h.replace(".", r"\.") for h in BLOCKED_HOSTS) + ")$")
    by_text = let(F.lower(text_of(url)), lambda low: low.endswith(".pdf") | any_of(low, BLOCKED_PATHS))
    return by_text | let(domain_from_url(url), lambda host: host.isNull() | F.coalesce(listed(host), F.lit(False)))


def event_slug(name: Column, url: Column) -> Column:
    """A name for an event's folder: its own name, cut at 55 characters, and 8 digits of its URL's hash."""
    named = F.coalesce(F.nullif(name, F.lit("")), F.lit("event"))
    safe = F.substring(F.regexp_replace(F.regexp_replace(F.lower(named), r"(?U)[^\w\-]+", "-"), "^-+|-+$", ""), 1, 55)
    digest = F.substring(F.sha2(text_of(url), 256), 1, 8)
    return F.when(safe == "", digest).otherwise(F.concat_ws("-", safe, digest))


def parse_url_slug(url: Column) -> Column:
    """``struct<year, month, city, country>`` from a slug that ends in year, month, city and country code."""
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTHS) for x in (m, f"{k + 1:02d}")])
    codes = F.create_map(*[F.lit(x) for pair in COUNTRIES.items() for x in pair])

    def from_year(parts: Column) -> Column:
        at = F.array_position(F.transform(parts, lambda x: x.rlike("^20(2[0-9]|3[0-5])$")), True).cast("int")  # from 1, 0: none
        return let(at, lambda a: F.when(a > 0, F.slice(parts, F.greatest(a, F.lit(1)), 4)))

    def read(p: Column) -> Column:
        country = let(F.lower(F.get(p, 3)), lambda code: F.coalesce(F.try_element_at(codes, code), F.upper(code)))
        return F.struct(F.get(p, 0).alias("year"), F.try_element_at(months, F.lower(F.get(p, 1))).alias("month"), F.initcap(F.get(p, 2)).alias("city"), country.alias("country"))

    parts = F.split(F.element_at(F.split(F.regexp_replace(path(url), "/+$", ""), "/"), -1), "-")
    return let(let(parts, from_year), read)


def review_url_norm(url: Column) -> Column:
    return F.lower(F.regexp_replace(text_of(url), "/+$", ""))


def ensure_scheme(url: Column) -> Column:
    u = strip(text_of(url))
    return F.when(u == "", u).when(F.lower(u).rlike("^https?://"), u).otherwise(F.concat(F.lit("https://"), u))
