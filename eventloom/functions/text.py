"""Text, date and name functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eventloom.functions.urls import any_of, let, strip, text_of

# Markers of challenge and block pages, and of names that aren't names.
CHALLENGE = ("cdn-cgi/challenge-platform", "cf-challenge", "__cf_chl_jschl_tk__", "chk_jschl", "cf-browser-verification", "checking your browser", "just a moment", "turnstile", "cf-chl-bypass")
HARD_BLOCK = ("error 1020", "access denied", "banned your ip", "your ip has been blocked", "blocked by cloudflare")
JUNK_NAMES = (
    "logo", "icon", "image", "banner", "sponsor", "partner", "exhibitor", "home", "contact", "conferences", "disciplines", "locations", "search",
    "login", "log in", "donate", "cookie policy", "read more", "icons", "noted", "related events", "more events", "submit your event for free",
    "conference index", "members", "faculty", "publications", "who we are", "photo gallery",
)
NAV_PREFIXES = ("home", "contact", "conference", "past conference", "search for", "cookie", "log in", "donate", "download", "read more", "want more information")
SPEAKER_PHRASES = (
    "registration", "sign-in", "welcome message", "opening session", "a.m.", "p.m.", "conference index", " on august", " on september", " on october",
    " on november", " on december", " on january", " on february", " on march", " on april", " on may", " on june", " on july",
    "program will be released", "creative commons", "licensed under", "noun project", "except where otherwise", "content on this site",
)
SPEAKER_PLACES = ("australia", "sydney", "online", "virtual", "remote")
MONTH_NAMES = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

#: What ends a day's schedule line from being a name; ``break`` and what follows only as whole words.
SCHEDULE_PHRASES = ("registration", "sign-in", "welcome message", "opening session", "closing session", "location:")
SCHEDULE_WORDS = ("break", "lunch", "coffee", "networking", "cpeu")

_MONTH = "|".join(sorted({*(m.title() for m in MONTH_NAMES), *(m[:3].title() for m in MONTH_NAMES), "Sept"}))
_YEAR, _DAY = r"(20\d{2})", r"(\d{1,2})"
ISO = r"\b20\d{2}([-/])(?:0[1-9]|1[0-2])[-/](?:0[1-9]|[12]\d|3[01])\b"
LONG = rf"(?i)\b({_MONTH})\s+{_DAY},?\s*{_YEAR}\b"
RANGE = rf"(?i)\b([A-Za-z]{{3,9}})\s+{_DAY}(?:\s*[-–—]\s*{_DAY})?,?\s*{_YEAR}\b"


def normalize_for_match(c: Column) -> Column:
    return strip(F.regexp_replace(F.lower(text_of(c)), r"(?U)\s+", " "))


def methodology_description(c: Column) -> Column:
    """Trimmed; null where empty; over 500 characters cut to 497 and an ellipsis."""
    cut = lambda t: F.concat(F.regexp_replace(F.substring(t, 1, 497), r"(?U)\s+$", ""), F.lit("..."))
    return let(strip(text_of(c)), lambda t: F.when(t == "", None).when(F.length(t) > 500, cut(t)).otherwise(t))


def _month(name: Column) -> Column:
    """Two digits of a month by the first three letters of its name."""
    months = F.create_map(*[F.lit(x) for k, m in enumerate(MONTH_NAMES) for x in (m[:3], f"{k + 1:02d}")])
    return F.try_element_at(months, F.substring(F.lower(name), 1, 3))


def extract_dates(c: Column) -> Column:
    """``struct<start, end>``: all ISO dates, else a full date, else a range within a month, else nulls."""
    iso_days = lambda t: F.transform(F.regexp_extract_all(t, F.lit(ISO), F.lit(0)), lambda d: F.replace(d, F.lit("/"), F.lit("-")))
    pick = lambda t, p, *ks: F.array(*[F.regexp_extract(t, p, k) for k in ks])

    def days(m: Column) -> Column:
        """From month, first day, last day or nothing, and year; a month that isn't known gives nulls."""
        day = lambda d: F.concat(F.get(m, 3), F.lit("-"), _month(F.get(m, 0)), F.lit("-"), F.lpad(d, 2, "0"))
        return F.struct(day(F.get(m, 1)).alias("start"), day(F.when(F.get(m, 2) == "", F.get(m, 1)).otherwise(F.get(m, 2))).alias("end"))

    def choose(x: Column) -> Column:
        isos = x["i"]
        ours = F.struct(F.array_min(isos).alias("start"), F.array_max(isos).alias("end"))
        nothing = F.struct(F.lit(None).cast("string").alias("start"), F.lit(None).cast("string").alias("end"))
        # the day of a full date stands for the last one too; a pattern is tried only where those before found nothing
        by_part = let(pick(x["t"], RANGE, 1, 2, 3, 4), lambda part: F.when(F.get(part, 0) != "", days(part)).otherwise(nothing))
        by_long = let(pick(x["t"], LONG, 1, 2, 2, 3), lambda long: F.when(F.get(long, 0) != "", days(long)).otherwise(by_part))
        return F.when(F.size(isos) > 0, ours).otherwise(by_long)

    return let(let(text_of(c), lambda t: F.struct(t.alias("t"), iso_days(t).alias("i"))), choose)


def parse_location(c: Column) -> Column:
    """``struct<venue, city, state, country, zip>`` from a comma-separated place."""

    def code(raw: Column) -> Column:
        return F.struct(raw.alias("raw"), F.nullif(F.regexp_extract(raw, r"\b(\d{5}(?:-\d{4})?)\b", 1), F.lit("")).alias("zip"))

    def parts(x: Column) -> Column:
        rest = F.when(x["zip"].isNotNull(), F.replace(x["raw"], x["zip"], F.lit(""))).otherwise(x["raw"])
        return F.struct(x["zip"].alias("zip"), F.filter(F.transform(F.split(rest, ","), strip), lambda p: p != "").alias("p"))

    def place(x: Column) -> Column:
        p, n = x["p"], F.size(x["p"])
        at = lambda k: F.try_element_at(p, F.lit(k))
        remote = F.lower(at(1)).isin("online", "virtual", "remote")
        return F.struct(
            F.when(n > 3, F.array_join(F.slice(p, 1, F.greatest(n - 3, F.lit(0))), ", ")).when((n == 1) & remote, at(1)).alias("venue"),
            F.when(n >= 3, at(-3)).when(n == 2, at(1)).when((n == 1) & ~remote, at(1)).alias("city"),
            F.when(n >= 3, at(-2)).alias("state"),
            F.when(n >= 3, at(-1)).when(n == 2, at(2)).alias("country"),
            x["zip"].alias("zip"),
        )

    return let(let(let(strip(F.regexp_replace(text_of(c), r"(?U)\s+", " ")), code), parts), place)


def tokenize_name(c: Column) -> Column:
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(text_of(c)), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: F.length(t) > 2))


def page_quality(html: Column, thin: bool = True) -> Column:
    """``hard_block``, ``challenge``, ``thin`` (under 400 characters) or ``ok``."""
    low = F.lower(text_of(html))
    return F.when(any_of(low, HARD_BLOCK), "hard_block").when(any_of(low, CHALLENGE), "challenge").when(F.lit(thin) & (F.length(low) < 400), "thin").otherwise("ok")


def program_not_published(c: Column) -> Column:
    return text_of(c).rlike(r"(?i)program will be released|coming soon|to be announced|tba\b")


def is_junk_name(c: Column) -> Column:
    prefixed = "^(" + "|".join(NAV_PREFIXES) + ")"
    n_words = lambda x: F.size(F.filter(F.split(x, r"(?U)\s+"), lambda w: w != ""))
    return let(strip(F.lower(text_of(c))), lambda x: x.isin(*JUNK_NAMES) | x.contains(" logo") | x.rlike(prefixed) | (n_words(x) > 8))


def is_junk_speaker_name(c: Column) -> Column:
    schedule = "(?i)" + "|".join([*SCHEDULE_PHRASES, *(w + r"\b" for w in SCHEDULE_WORDS)])
    # the cheapest tests first: most texts are decided by them
    return let(text_of(c), lambda t: (F.length(t) > 70) | strip(t).rlike(r"^\d") | (t.contains(":") & (F.length(F.regexp_replace(t, "[^:]", "")) >= 2)) | is_junk_name(t) | t.rlike(schedule))


def is_junk_speaker_record(c: Column) -> Column:
    """The last filter of speakers."""
    said = lambda low: any_of(low, SPEAKER_PHRASES) | low.isin(*SPEAKER_PLACES) | low.contains(" logo")
    return let(strip(text_of(c)), lambda t: (F.length(t) < 2) | t.rlike(r"\d{1,2}:\d{2}") | (F.length(t) > 70) | let(F.lower(t), said))


def parse_speaker_candidate(c: Column) -> Column:
    """``struct<name, title, company, details>`` of a speaker's line, null for what isn't a name.

    A long dash, or the only hyphen after six words at most, begins the title; ``at`` after five words at most begins the company.
    """
    n_words = lambda x: F.size(F.filter(F.split(x, " "), lambda w: w != ""))

    def titled(raw: Column) -> Column:
        dash, hyphen = F.split(raw, " — ", 2), F.split(raw, " - ", -1)
        by_dash = F.size(dash) > 1
        parts = F.when(by_dash, dash).when((F.size(hyphen) == 2) & (n_words(F.get(hyphen, 0)) <= 6), hyphen).otherwise(F.array(raw))
        return F.struct(raw.alias("raw"), F.transform(parts, strip).alias("parts"))

    def placed(x: Column) -> Column:
        name = F.get(x["parts"], 0)
        at = F.split(name, r"(?i)\s+at\s+", 2)
        works = F.lower(name).contains(" at ") & (F.size(at) == 2) & (n_words(F.get(at, 0)) <= 5)
        return F.struct(F.when(works, strip(F.get(at, 0))).otherwise(name).alias("name"), F.get(x["parts"], 1).alias("title"), F.when(works, strip(F.get(at, 1))).alias("company"), x["raw"].alias("details"))

    person = lambda x: F.when((x["details"] != "") & ~is_junk_speaker_name(x["details"]) & ((x["name"] == x["details"]) | ~is_junk_speaker_name(x["name"])), x)
    raw = F.regexp_replace(F.regexp_replace(text_of(c), "^[ ,;•]+|[ ,;•]+$", ""), r"(?U)\s+", " ")
    return let(let(let(raw, titled), placed), person)


def snippet_in_normalized(snippet: Column, body: Column, min_len: int = 8) -> Column:
    """Whether a text supports a snippet; ``body`` is normalised already."""

    def every(s: Column) -> Column:
        found = F.filter(F.split(s, r"(?U)\W+"), lambda w: F.length(w) > 2)
        return let(found, lambda ws: (F.size(ws) >= 2) & F.forall(F.slice(ws, 1, 4), lambda w: body.contains(w)))

    return let(normalize_for_match(snippet), lambda s: (F.length(s) >= min_len) & (body.contains(s) | ((F.length(s) > 40) & body.contains(F.substring(s, 1, 40))) | every(s)))


def snippet_in_text(snippet: Column, text: Column, min_len: int = 8) -> Column:
    return snippet_in_normalized(snippet, normalize_for_match(text), min_len)


def scalar_in_text(value: Column, text: Column) -> Column:
    return scalar_in_normalized(value, normalize_for_match(text))


def scalar_in_normalized(value: Column, body: Column) -> Column:
    return let(normalize_for_match(value), lambda v: (v != "") & (body.contains(v) | ((F.length(v) > 6) & body.contains(F.substring(v, 1, 30)))))


def speakers_from_text(text: Column, most: int = 80) -> Column:
    """``array<struct<name, title, company, details>>`` of a page's text, the first of each name.

    Names come from lists, those after ``Panelists:`` up to a description or a location, and then from lines
    that speak of speakers.
    """
    from eventloom.operators.merge import first_of_each

    before = lambda c, mark: F.get(F.split(c, mark.replace(".", "[.]")), 0)
    parts = lambda c, pattern: F.split(c, pattern)
    chunks = F.filter(F.split(text_of(text), r"(?i)\bPanelists?:\s*"), lambda c: strip(c) != "")
    listed = F.flatten(F.transform(chunks, lambda c: parts(before(before(c, ". Description:"), " Location:"), r"(?<=[a-z])\s+(?=Dr\.|Prof\.)|[,;•\n]")))
    lines = F.filter(F.transform(F.split(text_of(text), "\n"), strip), lambda x: (x != "") & (F.length(x) <= 200) & x.rlike(r"(?i)\b(keynote|speaker|presenter|panelist)\b"))
    spoken = F.flatten(F.transform(lines, lambda x: parts(x, "[,;•]")))
    found = F.filter(F.transform(F.concat(listed, spoken), parse_speaker_candidate), lambda s: s.isNotNull())
    return F.slice(first_of_each(found, lambda s: F.lower(s["name"])), 1, most)
