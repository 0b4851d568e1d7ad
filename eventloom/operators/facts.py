"""What one parse of a page gives: a row of arrays and maps, after which everything is column expressions."""

from __future__ import annotations

import re
from functools import cached_property, lru_cache
from itertools import islice
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import JUNK_NAMES, NAV_PREFIXES, SCHEDULE_PHRASES, SCHEDULE_WORDS
from eventloom.functions.urls import SCHEME, SPACES, join_url
from eventloom.operators.html import Page, among, parsed, per_page, resolved, visible_text

# Words that name a section of companies, marks of such a section, and of parts of a page that aren't its own.
SPONSOR_WORDS = ("sponsor", "partner", "partners")
EXHIBITOR_WORDS = ("exhibitor", "exhibitors", "expo")
ATTENDING_WORDS = ("attend", "attendee", "who attends", "delegates", "companies")
SPEAKER_WORDS = ("speaker", "keynote", "panelist", "presenter", "faculty")
LIST_MARKS = ("partners-root", "sponsors-list", "sponsor-list", "exhibitors-list", "exhibitor-list", "partner-grid", "sponsor-grid")
CARD_MARKS = ("partner-card", "gold-grid", "gold-cell")
FRAME_TAGS = frozenset(("footer", "nav", "header", "aside"))
FRAME_MARKS = ("footer", "navbar", "nav-menu", "site-nav", "breadcrumb", "cookie")
WINDOW_OPEN = r"window\.open\s*\(\s*(['\"])(https?://[^'\"]+)\1"

MAX_ENTITIES, MAX_CARDS, MAX_BLOCK, MAX_SPEAKERS = 120, 200, 100, 80
TEXT_CHARS = 15_000

LINK = "struct<pos:int,kind:string,href:string,resolved:string,text:string,title:string,rel:array<string>,classes:array<string>,hidden:boolean,in_item:boolean>"
ENTITY = "struct<name:string,website:string,details:string>"
CARD = "struct<name:string,title:string,company:string,details:string>"
ITEM = "struct<pos:int,event_url:string,event_id:string,edition_id:string,name:string,date_display:string,start_date:string,end_date:string,venue:string,description:string,categories:string,footer_stats:string>"
LABEL = "struct<text:string,strong:string>"
PARTS = {
    "text": "string", "links": f"array<{LINK}>", "by_name": "map<string,string>", "by_property": "map<string,string>", "json_ld": "array<string>",
    "h1": "string", "labels": f"array<{LABEL}>", "description_pane": "string", "organization_pane": "string", "organizer_name": "string", "organizer_href": "string",
    "ticket_url": "string", "ajax_url": "string", "listing": f"array<{ITEM}>", "featured": f"array<{ITEM}>", "attending": f"array<{ENTITY}>",
    "exhibitors": f"array<{ENTITY}>", "sponsors": f"array<{ENTITY}>", "speaker_cards": f"array<{CARD}>", "speakers": f"array<{CARD}>",
}


def page_facts(pages: DataFrame, keys: list[str], *parts: str, skip: str | None = None) -> DataFrame:
    """The key columns of ``pages(url, html)`` and the named parts of each page, all from one parse; html goes no further.

    A null html is an empty page. Markup never fails: what can't be read is missing. ``skip`` names a column of arrays:
    lists among the parts that aren't read from that page and come out empty.
    """
    want = parts or tuple(PARTS)

    def make(url: str | None, html: str | None, without: list[str] | None = None) -> list[tuple]:
        page = parsed(html)
        return [tuple([] if without and p in without else _READ[p](page, url or "") for p in want)]

    return per_page(pages, keys, ["url", "html", *([skip] if skip else [])], ", ".join(f"{p} {PARTS[p]}" for p in want), make)


def rebased(links: Column, base: Column) -> Column:
    """Links as they resolve against another URL; absolute ones stay."""
    return F.transform(links, lambda x: x.withField("resolved", F.when(x["href"].rlike(SCHEME), x["resolved"]).otherwise(join_url(base, x["href"]))))


# --- links and heads ---------------------------------------------------------------------------------------------


def _links(page: Page, url: str) -> list[dict]:
    out = []
    for at in page.all("a", "link"):
        own = page.attrs[at]
        if "href" in own and (page.tags[at] == "a" or "rel" in own):
            href = own["href"].strip()
            item = any(page.tags[up] == "li" for up in page.above(at)) if "/conferences/" in href else False
            out.append({"pos": len(out), "kind": page.tags[at], "href": href, "resolved": resolved(url, href), "text": page.text(at), "title": own.get("title"), "rel": own.get("rel", "").split(), "classes": page.names(at), "hidden": page.hidden[at], "in_item": item})
    return out


def _metas(key: str):
    def read(page: Page, url: str) -> list[tuple[str, str]]:
        found: dict[str, str] = {}
        for at in page.all("meta"):
            if key in page.attrs[at]:
                found.setdefault(page.attrs[at][key], page.attrs[at].get("content", "").strip())
        return list(found.items())

    return read


def _first_text(*tags: str):
    return lambda page, url: next((page.text(at) for at in page.all(*tags)), None)


def _pane(name: str):
    return lambda page, url: next((page.text(at, "\n") for at in page.all() if page.attrs[at].get("id") == name), None)


def _labels(page: Page, url: str) -> list[dict]:
    """List items that could be ``Label: value``, with what is in bold in them."""
    out = []
    for at in page.all("li"):
        text = page.text(at)
        if ":" in text:
            bold = page.first(at, "strong")
            out.append({"text": text, "strong": page.text(bold) if bold >= 0 else None})
    return out


def _organizer(page: Page, url: str) -> tuple[str | None, str | None]:
    card = next((at for at in page.all() if "eps-org-container" in page.names(at)), -1)
    if card < 0:
        return None, None
    name = next((at for at in page.inside(card) if page.tags[at] == "h2" or "eps-org-name" in page.names(at)), -1)
    href = page.attrs[card].get("href") or None
    if href and not href.startswith("http"):
        href = resolved("https://allevents.in", href)
    return (page.text(name) or None) if name >= 0 else None, href


def _ticket(page: Page, url: str) -> str | None:
    return next((x for at in page.all() if "go.php" in page.attrs[at].get("data-ehref", "") and (x := page.attrs[at]["data-ehref"].strip())), None)


def _ajax(page: Page, url: str) -> str | None:
    first = next((page.attrs[at].get("value", "") for at in page.all("input") if page.attrs[at].get("id") == "desktopdropdown"), "")
    return first.strip() or None


# --- rows of listing pages -----------------------------------------------------------------------------------------


def _opened(page: Page, at: int) -> str | None:
    """The URL that a click on the element opens."""
    for name in ("onclick", "oncontextmenu"):
        if at >= 0 and (m := re.search(WINDOW_OPEN, page.attrs[at].get(name, ""), re.I)):
            return m[2]
    return None


def _time(page: Page, at: int) -> int:
    return next((k for k in page.inside(at, "div") if "eventTime" in page.names(k)), -1)


def _dates(page: Page, at: int) -> dict:
    get = (lambda n: page.attrs[at].get(n)) if at >= 0 else (lambda n: None)
    return {"start_date": get("data-start-date"), "end_date": get("data-end-date")}


def _listing(page: Page, url: str) -> list[dict]:
    """Rows of the directory's table; each cell has its meaning by its place."""
    table = next((at for at in page.all("table") if page.attrs[at].get("id") == "listing-events"), -1)
    body = page.first(table, "tbody") if table >= 0 else -1
    out: list[dict] = []
    for row in page.inside(body, "tr") if body >= 0 else ():
        cells = page.children(row, "td")
        if "event-card" not in page.names(row) or len(cells) < 2:
            continue
        when, named = cells[0], cells[1]
        title, time = page.first(named, "h2"), _time(page, when)
        link = _opened(page, named) or _opened(page, title)
        if not link:
            continue
        head = page.attrs[title] if title >= 0 else {}
        cell = lambda k: (page.text(cells[k]) or None) if k < len(cells) else None  # noqa: B023, E731
        out.append({
            "pos": len(out), "event_url": link, "event_id": page.attrs[named].get("data-id") or head.get("id"), "edition_id": head.get("data-edition"),
            "name": (page.text(title) if title >= 0 else "") or page.text(named) or None, "date_display": (page.text(time) if time >= 0 else "") or cell(0),
            **_dates(page, time), "venue": cell(2), "description": cell(3), "categories": cell(4), "footer_stats": cell(5),
        })
    return out


def _featured(page: Page, url: str) -> list[dict]:
    """Cards of the premium rail; the first element in a card that opens a page names its URL."""
    rail = next((at for at in page.all("div") if page.attrs[at].get("id") == "featured-events"), -1)
    out: list[dict] = []
    for card in page.inside(rail, "div") if rail >= 0 else ():
        if not {"premium-event", "event-card"} <= set(page.names(card)):
            continue
        el = next((k for k in page.inside(card) if re.search(WINDOW_OPEN, page.attrs[k].get("onclick", ""), re.I)), -1)
        if el < 0:
            continue
        time, title = _time(page, card), page.first(card, "h2", "h3")
        out.append({
            "pos": len(out), "event_url": _opened(page, el), "event_id": page.attrs[el].get("data-id"), "edition_id": page.attrs[el].get("data-edition"),
            "name": page.text(title if title >= 0 else el) or None, "date_display": page.text(time) if time >= 0 else None, **_dates(page, time),
            "venue": None, "description": None, "categories": None, "footer_stats": None,
        })
    return out


# --- sections of companies and speakers ----------------------------------------------------------------------------


class Frames:
    """Of each element of a page: its class and id, and what its ancestors are, whatever kind of company is looked for."""

    def __init__(self, page: Page):
        self.marks: list[str] = []
        #: an ancestor is a page's frame; an ancestor's class speaks of pictures or partners
        self.framed: list[bool] = []
        self.pictured: list[bool] = []
        frame: list[bool] = []
        partners: list[bool] = []
        for k, up in enumerate(page.parent):
            attrs = page.attrs[k]
            framed, pictured = up >= 0 and frame[up], up >= 0 and partners[up]
            mark, own = " ", attrs.get("class", "") if attrs else ""
            if own or (attrs and "id" in attrs):
                mark = f"{' '.join(own.split())} {attrs.get('id', '')}".lower()
            self.marks.append(mark)
            self.framed.append(framed)
            self.pictured.append(pictured)
            frame.append(framed or page.tags[k] in FRAME_TAGS or (mark != " " and any(m in mark for m in FRAME_MARKS)))
            partners.append(pictured or (own != "" and ("pic" in own.split() or "partner" in own or "sponsor" in own)))
        free = [k for k in range(len(page.tags)) if not self.framed[k] and not page.hidden[k]]
        self.classed = [k for k in free if "class" in page.attrs[k]]
        shown = set(free)
        self.heads = [(k, said.lower()) for k in page.all("h1", "h2", "h3", "h4") if k in shown and (said := page.short_text(k, 100))]
        self.parts = [k for k in page.all("section", "main") if k in shown]
        self.described = [k for k in page.all("img") if "alt" in page.attrs[k]]
        self.linked = [k for k in page.all("a") if "href" in page.attrs[k]]


class Section:
    """Which elements of a page belong to a kind of company, and the part of the page that lists them."""

    def __init__(self, page: Page, words: tuple[str, ...]):
        if page.frames is None:
            page.frames = Frames(page)
        self.page, self.words, self.frames = page, words, page.frames
        self.marks, self.framed, self.pictured = self.frames.marks, self.frames.framed, self.frames.pictured
        self.joined = tuple({w.replace(" ", j) for w in words for j in "-_"})
        self.known: dict[str, bool] = {" ": False}

    @cached_property
    def within(self) -> list[bool]:
        """The element or an ancestor is named after the kind."""
        out: list[bool] = []
        for k, up in enumerate(self.page.parent):
            out.append((up >= 0 and out[up]) or self.named(k))
        return out

    def first_of(self, places: list[int], at: int) -> int:
        """The first of the ``places`` inside an element, -1 where there is none."""
        return next(among(places, at + 1, self.page.past[at]), -1)

    def named(self, at: int) -> bool:
        mark = self.marks[at]
        if mark not in self.known:
            self.known[mark] = any(w in mark for w in self.joined)
        return self.known[mark]

    def _said(self, at: int) -> bool:
        return self.named(at) or any(w in self.marks[at] for w in self.words)

    def _weight(self, at: int) -> int:
        mark = self.marks[at]
        return 1 + 10 * any(m in mark for m in LIST_MARKS) + 5 * any(m in mark for m in CARD_MARKS)

    def root(self) -> int:
        """The best element that a class names; else a heading's section; else a section named after the kind. -1: none."""
        page = self.page
        if classed := [k for k in self.frames.classed if self._said(k)]:
            return max(classed, key=lambda k: (self._weight(k), -k))
        for k, said in self.frames.heads:
            if any(w in said for w in self.words):
                part = next((up for up in page.above(k) if page.tags[up] in ("section", "main", "article")), -1)
                return part if part >= 0 and not self.framed[part] else k
        return next((k for k in self.frames.parts if any(w in self.marks[k] for w in self.words)), -1)


def _outer_website(section: Section, at: int, host: str) -> str | None:
    """The first link out of the site: the element's own, else that of the first link in it."""
    page = section.page
    own = page.attrs[at].get("href", "").strip() if page.tags[at] == "a" else ""
    if own.startswith("http") and host not in netloc(own):
        return own
    link = section.first_of(section.frames.linked, at)
    href = page.attrs[link]["href"].strip() if link >= 0 else ""
    return href if href.startswith("http") and netloc(href) and host not in netloc(href) else None


def netloc(url: str) -> str:
    try:
        return urlsplit(url).netloc.lower()
    except ValueError:
        return ""


def _is_junk(name: str) -> bool:
    low = name.lower().strip()
    return low in JUNK_NAMES or " logo" in low or low.startswith(NAV_PREFIXES) or len(low.split()) > 8


def _described(page: Page, img: int) -> str | None:
    alt = page.attrs[img]["alt"].strip()
    return alt if 2 <= len(alt) <= 120 and alt.lower() not in JUNK_NAMES else None


def entities(page: Page, url: str, words: tuple[str, ...]) -> list[dict]:
    """Companies of a kind: described logos, then cards, then links of sections for partners; the first of each name."""
    section, host = Section(page, words), netloc(url)
    root = section.root()
    if root < 0 and {"partner", "partners", "sponsor", "sponsors"} & set(words):
        main = next(page.all("main"), next((k for k in page.all() if page.attrs[k].get("id") == "main-content"), -1))
        root = main if main >= 0 and not section.framed[main] else -1
    if root < 0:
        return []
    found: dict[str, dict] = {}

    def add(name: str | None, website: str | None, details: str | None = None) -> None:
        name = " ".join((name or "").split())
        if 2 <= len(name) <= 120 and not _is_junk(name) and name.lower() not in found and not (website and host and netloc(website) == host):
            found[name.lower()] = {"name": name, "website": website, "details": details}

    hidden, framed = page.hidden, section.framed
    for img in (k for k in page.inside(root, "img") if not hidden[k] and not framed[k] and "alt" in page.attrs[k]):
        holder = next((up for up in page.above(img) if page.tags[up] in ("a", "div", "li", "article")), -1)
        own = " ".join(page.names(img)).lower()
        if (holder >= 0 and section.within[holder]) or any(w in own for w in ("logo", "partner", "sponsor")):
            if name := _described(page, img):
                up = page.parent[img]
                add(name, _outer_website(section, up if up >= 0 else img, host))
    for card in islice((k for k in page.inside(root, "article", "li", "div") if not hidden[k]), MAX_CARDS):
        img = section.first_of(section.frames.described, card)
        if framed[card] or not (img >= 0 or section.named(card)):
            continue
        name = _described(page, img) if img >= 0 else None
        if name is None:
            title = page.first(card, "h3", "h4", "h5", "strong")
            name = page.text(title) if title >= 0 else None
        if name:
            said = page.first(card, "p")
            add(name, _outer_website(section, card, host), (page.text(said) or None) if said >= 0 else None)
    for a in (k for k in page.inside(root, "a") if not hidden[k] and not framed[k] and "href" in page.attrs[k]):
        if "logo" in page.names(a) or section.pictured[a]:
            label, href = page.text(a), page.attrs[a]["href"].strip()
            if label and len(label) <= 80 and href.startswith("http") and host not in netloc(href):
                add(label, href)
    return list(found.values())[:MAX_ENTITIES]


def speaker_cards(page: Page, url: str) -> list[dict]:
    """Named cards of the blocks that a heading about speakers stands in: name, then up to two paragraphs."""
    out: list[dict] = []
    for head in page.all("h1", "h2", "h3", "h4"):
        if page.hidden[head]:
            continue
        said = page.text(head).lower()
        if not any(w in said for w in SPEAKER_WORDS):
            continue
        block = next((up for up in page.above(head) if page.tags[up] in ("section", "main", "div")), head)
        for card in islice((k for k in page.inside(block, "article", "li", "div") if not page.hidden[k]), MAX_BLOCK):
            named = page.first(card, "h3", "h4", "h5", "strong")
            name = page.text(named) if named >= 0 else ""
            if name:
                said = [page.text(k) or None for k in islice(page.inside(card, "p"), 2)]
                title = said[0] if said and said[0] != name else None
                out.append({"name": name, "title": title, "company": said[1] if len(said) > 1 else None, "details": page.text(card)})
    return out


# --- speakers: ``functions.text`` as plain code, for a page's lines are many and few of them name anyone ------------

PANELISTS = re.compile(r"\b(?ai:Panelists?:\s*)")
SPEAKER_PARTS = re.compile(r"(?<=[a-z])(?a:\s+)(?=Dr\.|Prof\.)|[,;•\n]")
LINE_PARTS = re.compile("[,;•]")
SPEAKER_HINTS = ("keynote", "speaker", "presenter", "panelist")
SPEAKER_LINE = re.compile(r"\b(?ai:" + "|".join(SPEAKER_HINTS) + r")\b")
AT_COMPANY = re.compile(r"(?ai:\s+at\s+)")
SCHEDULE = re.compile("(?ai:" + "|".join(SCHEDULE_PHRASES) + ")|(?ai:" + "|".join(SCHEDULE_WORDS) + r")\b")
SPACE = re.compile(f"[{SPACES}]+")
SCHEDULE_HINTS = (*SCHEDULE_PHRASES, *SCHEDULE_WORDS)
DIGITS, PRINTED = frozenset("0123456789"), frozenset(map(chr, range(0x21, 0x7F)))
_JUNK_NAMES = frozenset(JUNK_NAMES)
#: Parts of lines up to that length, and so many of them, are remembered by a worker: pages of a site repeat theirs.
KNOWN_CHARS, KNOWN_PARTS = 80, 8192


def _n_words(text: str) -> int:
    """How many words white space parts the text into."""
    return len((text if text.isprintable() else SPACE.sub(" ", text).replace("\x1f", "x")).split())


def is_junk_speaker(name: str) -> bool:
    """``is_junk_speaker_name``."""
    if len(name) > 70 or name.count(":") >= 2:
        return True
    low = name.lower()
    if low[:1] not in PRINTED or low[-1:] not in PRINTED:
        low = low.strip(SPACES)
    if low[:1] in DIGITS or low in _JUNK_NAMES or low.startswith(NAV_PREFIXES) or " logo" in low or (len(low) > 16 and _n_words(low) > 8):
        return True
    # the pattern only where one of its words is
    return any(w in low for w in SCHEDULE_HINTS) and SCHEDULE.search(name) is not None


def speaker_candidate(said: str) -> dict | None:
    """``parse_speaker_candidate``, of a part of a line; never to be changed."""
    raw = said.strip(" ,;•")
    if not raw.isprintable() or "  " in raw:
        raw = SPACE.sub(" ", raw)
    if not raw or is_junk_speaker(raw):
        return None
    name, title, company = raw, None, None
    if " — " in raw:
        name, title = (p.strip(SPACES) for p in raw.split(" — ", 1))
    elif raw.count(" - ") == 1 and len(raw.split(" - ")) == 2:
        left, right = raw.split(" - ")
        if _n_words(left) <= 6:
            name, title = left.strip(SPACES), right.strip(SPACES)
    else:
        name = raw.strip(SPACES)
    if " at " in name.lower():
        parts = AT_COMPANY.split(name, 1)
        if len(parts) == 2 and _n_words(parts[0]) <= 5:
            name, company = parts[0].strip(SPACES), parts[1].strip(SPACES)
    return None if name != raw and is_junk_speaker(name) else {"name": name, "title": title, "company": company, "details": raw}


known_candidate = lru_cache(KNOWN_PARTS)(speaker_candidate)


def said_speakers(text: str) -> dict[str, dict]:
    """``speakers_from_text`` of a page's visible text, whose lines hold no ends of lines: by name in lower case, in order."""
    found: dict[str, dict] = {}

    def add(parts: list[str]) -> None:
        for part in parts:
            person = known_candidate(part) if len(part) <= KNOWN_CHARS else speaker_candidate(part)
            if person is not None:
                found.setdefault(person["name"].lower(), person)

    low = text.lower()
    for chunk in PANELISTS.split(text) if "panelist" in low else (text,):
        if chunk.strip(SPACES):
            add(SPEAKER_PARTS.split(chunk.split(". Description:", 1)[0].split(" Location:", 1)[0]))
    if any(w in low for w in SPEAKER_HINTS):
        for line in text.split("\n"):
            # in other lines the pattern finds nothing, which it takes long to see
            if any(w in line.lower() for w in SPEAKER_HINTS):
                line = line.strip(SPACES)
                if len(line) <= 200 and SPEAKER_LINE.search(line):
                    add(LINE_PARTS.split(line))
    return dict(islice(found.items(), MAX_SPEAKERS))


def speakers(page: Page, url: str) -> list[dict]:
    """Speakers of the page's text, then those of its cards; the first of each name."""
    found = said_speakers(shown_text(page))
    for card in speaker_cards(page, url):
        if not is_junk_speaker(card["name"]):
            found.setdefault(card["name"].lower(), card)
    return list(found.values())[:MAX_SPEAKERS]


def shown_text(page: Page) -> str:
    """The page's visible text as far as it is read."""
    if page.shown is None:
        page.shown = visible_text(page)[:TEXT_CHARS]
    return page.shown


_READ = {
    "text": lambda page, url: shown_text(page),
    "links": _links,
    "by_name": _metas("name"),
    "by_property": _metas("property"),
    "json_ld": lambda page, url: page.scripts("application/ld+json"),
    "h1": _first_text("h1"),
    "labels": _labels,
    "description_pane": _pane("event-description"),
    "organization_pane": _pane("event-organization"),
    "organizer_name": lambda page, url: _organizer(page, url)[0],
    "organizer_href": lambda page, url: _organizer(page, url)[1],
    "ticket_url": _ticket,
    "ajax_url": _ajax,
    "listing": _listing,
    "featured": _featured,
    "attending": lambda page, url: entities(page, url, ATTENDING_WORDS),
    "exhibitors": lambda page, url: entities(page, url, EXHIBITOR_WORDS),
    "sponsors": lambda page, url: entities(page, url, SPONSOR_WORDS),
    "speaker_cards": speaker_cards,
    "speakers": speakers,
}
