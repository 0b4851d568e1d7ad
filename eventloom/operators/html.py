"""A page as flat lists of elements and texts, and the one pass that turns captured pages into columns.

Tags are read as the standard library's parser reads them: void elements close at once, an end tag closes up to its
nearest open match, an unmatched one is ignored, and nothing else closes an element. Plain tags are known by their text or read by
one pattern, in a small part of that parser's time; from the first one that isn't plain on, the standard parser itself reads on. Elements are
numbered in document order, so that an element's descendants and its texts are ranges of numbers and no text is ever
copied to its ancestors.
"""

from __future__ import annotations

import heapq
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from html import entities, unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import DataFrame

VOID = frozenset("area base br col command embed hr img input keygen link menuitem meta param source track wbr".split())
HIDDEN = frozenset(("script", "style", "noscript", "svg"))
CODE = frozenset(("script", "style"))
#: Elements of several tags inside one of so many are sorted at once.
FEW = 256
#: Pages in an Arrow batch at most.
BATCH_PAGES = 256

#: A plain tag (end mark, name, attributes, closing slash) and the text after it. Whatever it matches the standard parser reads alike.
PLAIN = re.compile(
    r"""<(?:(/)([a-zA-Z][-.a-zA-Z0-9:_]*)[ \t\n\r\f]*|([a-zA-Z][-a-zA-Z0-9:_]*)((?:[ \t\n\r\f]+[a-zA-Z_:@][-a-zA-Z0-9_:.]*(?:="[^"]*"|='[^']*'|=[^\s"'<>=`/][^\s"'<>=`]*)?)*)[ \t\n\r\f]*(/?))>([^<]*)"""
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:@][-a-zA-Z0-9_:.]*)(?:=(?:"([^"]*)"|'([^']*)'|([^\s"'<>=`]+)))?""")
COMMENT_END = re.compile(r"--\s*>")
CODE_END = {tag: re.compile(rf"</\s*{tag}\s*>", re.I) for tag in CODE}
#: What is between a plain tag's brackets.
PLAIN_TAG = re.compile(PLAIN.pattern.removeprefix("<").removesuffix(">([^<]*)")).fullmatch
#: That many different tags are remembered by a worker.
KNOWN_TAGS = 4096
_known: dict[str, tuple[bool, str, dict[str, str], str]] = {}


class Page(HTMLParser):
    """``tags, attrs, parent, past`` by element; ``texts, owner`` by text; ``first_text, past_text`` bound an element's texts.

    ``places`` holds each tag's elements in order, so that those inside an element are found by halving.
    """

    def __init__(self) -> None:
        self.tags: list[str] = []
        self.attrs: list[dict[str, str]] = []
        self.parent: list[int] = []
        self.past: list[int] = []
        self.hidden: list[bool] = []
        self.first_text: list[int] = []
        self.past_text: list[int] = []
        self.texts: list[str] = []
        self.owner: list[int] = []
        self.open: list[int] = []
        self.n_open: defaultdict[str, int] = defaultdict(int)
        self.places: dict[str, list[int]] = {}
        #: what readers work out once for all lists of a page
        self.frames: object | None = None
        self.shown: str | None = None

    def read(self, html: str) -> None:
        """Plain markup by one pattern, and the rest, if there is one, by the standard parser."""
        at = self._read_plain(html)
        if at < len(html):
            super().__init__(convert_charrefs=True)
            self.feed(html[at:])
            super().close()
        self._shut(0)

    def _read_plain(self, html: str) -> int:
        """Where the plain markup ends.

        What stands between two opening brackets is a tag and the text after it, if its part before the first closing
        bracket is a whole plain tag.
        """
        tags, texts, owner, open_, n_open = self.tags, self.texts, self.owner, self.open, self.n_open
        attrs, parent, past, hidden, first_text, past_text, places = self.attrs, self.parent, self.past, self.hidden, self.first_text, self.past_text, self.places
        pieces = html.split("<")
        if pieces[0]:
            self.handle_data(unescape(pieces[0]))
        n, known = 1, _known.get
        while n < len(pieces):
            head, closed, text = pieces[n].partition(">")
            tag_of = known(head) or _tag_of(head)
            if tag_of is None or not closed:
                n = self._read_odd(html, pieces, n)
                if n < 0:
                    return ~n
                continue
            n += 1
            shut, tag, own, slash = tag_of
            if shut:
                if open_ and tags[open_[-1]] == tag:
                    last = open_.pop()
                    past[last], past_text[last] = len(tags), len(texts)
                    n_open[tag] -= 1
                else:
                    self.handle_endtag(tag)
            else:
                code = tag in CODE and not slash
                if code and not (n < len(pieces) and pieces[n].startswith(f"/{tag}>")):
                    n = self._read_odd(html, pieces, n - 1)
                    if n < 0:
                        return ~n
                    continue
                at, up = len(tags), open_[-1] if open_ else -1
                tags.append(tag)
                if tag in places:
                    places[tag].append(at)
                else:
                    places[tag] = [at]
                attrs.append(own)
                parent.append(up)
                past.append(at + 1)
                hidden.append(tag in HIDDEN or (up >= 0 and hidden[up]))
                n_texts = len(texts)
                first_text.append(n_texts)
                past_text.append(n_texts)
                if tag not in VOID:
                    open_.append(at)
                    n_open[tag] += 1
                    if slash:
                        self.handle_endtag(tag)
                if code:
                    if text:
                        texts.append(text)
                        owner.append(at)
                    continue
            if text:
                texts.append(unescape(text) if "&" in text else text)
                owner.append(open_[-1] if open_ else -1)
        return len(html)

    def _read_odd(self, html: str, pieces: list[str], n: int) -> int:
        """Reads what isn't a plain tag with its text: a comment, a declaration, a tag with brackets in its values, or a script with any.

        The number of the piece after it; where nothing of the kind stands, the complement of its bracket's place.
        """
        i = len(pieces[0]) + sum(map(len, pieces[1:n])) + n - 1
        end, text, m = -1, None, None
        if html.startswith("<!--", i):
            end = gone.end() if (gone := COMMENT_END.search(html, i + 4)) else -1
        elif html[i : i + 9].lower() == "<!doctype":
            end = html.find(">", i + 9) + 1 or -1
        elif (m := PLAIN.match(html, i)) is not None:
            tag, slash, end = (m[3] or "").lower(), m[5], m.start(6)
            if tag in CODE and not slash:
                code = CODE_END[tag].search(html, end)
                if code is None:
                    return ~i
                text, end = html[end : code.start()], code.end()
        if end < 0:
            return ~i
        if m is not None:
            if m[1]:
                self.handle_endtag(m[2].lower())
            else:
                self.handle_starttag(tag, list(_attributes_of(m[4]).items()))
                if slash and tag not in VOID:
                    self.handle_endtag(tag)
                if text is not None:
                    if text:
                        self.handle_data(text)
                    self.handle_endtag(tag)
        to = html.find("<", end)
        to = len(html) if to < 0 else to
        if end < to:
            self.handle_data(unescape(html[end:to]))
        while i < to:
            i += len(pieces[n]) + 1
            n += 1
        return n

    def handle_starttag(self, tag: str, attrs: list) -> None:
        at, up = len(self.tags), self.open[-1] if self.open else -1
        self.tags.append(tag)
        self.places.setdefault(tag, []).append(at)
        self.attrs.append({k: v or "" for k, v in attrs})
        self.parent.append(up)
        self.past.append(at + 1)
        self.hidden.append(tag in HIDDEN or (up >= 0 and self.hidden[up]))
        self.first_text.append(len(self.texts))
        self.past_text.append(len(self.texts))
        if tag not in VOID:
            self.open.append(at)
            self.n_open[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if not self.n_open[tag]:
            return
        for k in range(len(self.open) - 1, -1, -1):
            if self.tags[self.open[k]] == tag:
                self._shut(k)
                return

    def handle_data(self, data: str) -> None:
        self.texts.append(data)
        self.owner.append(self.open[-1] if self.open else -1)

    def _shut(self, depth: int) -> None:
        for at in self.open[depth:]:
            self.past[at], self.past_text[at] = len(self.tags), len(self.texts)
            self.n_open[self.tags[at]] -= 1
        del self.open[depth:]

    def text(self, at: int, between: str = " ") -> str:
        """The element's stripped texts, those of its descendants included but not of scripts and styles."""
        k = self.first_text[at]
        if self.past_text[at] == k + 1 and self.owner[k] == at and self.tags[at] not in CODE:
            return self.texts[k].strip()
        return between.join(self._said(at))

    def short_text(self, at: int, most: int) -> str | None:
        """``text`` where it has at most that many characters, else null; reads no further than that takes."""
        out, size = [], -1
        for t in self._said(at):
            size += len(t) + 1
            if size > most:
                return None
            out.append(t)
        return " ".join(out)

    def _said(self, at: int) -> Iterator[str]:
        for k in range(self.first_text[at], self.past_text[at]):
            owner = self.owner[k]
            if (owner < 0 or self.tags[owner] not in CODE) and (t := self.texts[k].strip()):
                yield t

    def inside(self, at: int, *tags: str) -> Iterator[int]:
        """The element's descendants, or those of some tags, in document order."""
        if not tags:
            return iter(range(at + 1, self.past[at]))
        past = self.past[at] if at >= 0 else len(self.tags)
        held = [self.places[t] for t in tags if t in self.places]
        if len(held) == 1:
            return among(held[0], at + 1, past)
        if past - at <= FEW:
            return iter(sorted(k for p in held for k in p[bisect_left(p, at + 1) : bisect_left(p, past)]))
        return heapq.merge(*(among(p, at + 1, past) for p in held))

    def first(self, at: int, *tags: str) -> int:
        past = self.past[at] if at >= 0 else len(self.tags)
        found = (p[k] for t in tags if (p := self.places.get(t)) and (k := bisect_left(p, at + 1)) < len(p) and p[k] < past)
        return min(found, default=-1)

    def children(self, at: int, tag: str) -> list[int]:
        out, k = [], at + 1
        while k < self.past[at]:
            if self.tags[k] == tag:
                out.append(k)
            k = self.past[k]
        return out

    def above(self, at: int) -> Iterator[int]:
        """The element's ancestors, from its parent up."""
        while (at := self.parent[at]) >= 0:
            yield at

    def names(self, at: int) -> list[str]:
        return self.attrs[at].get("class", "").split()

    def all(self, *tags: str) -> Iterator[int]:
        return self.inside(-1, *tags) if tags else iter(range(len(self.tags)))

    def scripts(self, kind: str) -> list[str]:
        return ["".join(self.texts[self.first_text[k] : self.past_text[k]]) for k in self.all("script") if self.attrs[k].get("type") == kind]


def among(places: Sequence[int], first: int, past: int) -> Iterator[int]:
    """Those of ascending ``places`` from ``first`` to before ``past``, found by halving."""
    for k in range(bisect_left(places, first), len(places)):
        if places[k] >= past:
            return
        yield places[k]


def _tag_of(head: str) -> tuple[bool, str, dict[str, str], str] | None:
    """Of what stands between a tag's brackets: whether it is an end tag, the name, the attributes and the closing slash; null if it isn't plain.

    The same object for equal texts, so never to be changed.
    """
    m = PLAIN_TAG(head)
    if m is None:
        return None
    shut, shut_tag, tag, said, slash = m.groups()
    out = (True, shut_tag.lower(), {}, "") if shut else (False, tag.lower(), _attributes_of(said) if said else {}, slash)
    if len(head) <= 200:
        if len(_known) >= KNOWN_TAGS:
            _known.clear()
        _known[head] = out
    return out


def _attributes_of(said: str) -> dict[str, str]:
    """The attributes of a plain tag by name, of equal names the last."""
    own = {}
    for name, double, single, bare in ATTRIBUTE.findall(said):
        value = double or single or bare
        own[name.lower()] = unescape(value) if "&" in value else value
    return own


#: An ampersand, and the reference up to its semicolon that it may begin.
REFERENCE = re.compile(r"&(?:#[0-9]+;|#[xX][0-9a-fA-F]+;|([A-Za-z][A-Za-z0-9]*;))?")


def only_closed_references(html: str) -> str:
    """Markup in which ampersands stand for themselves where no known reference with its semicolon begins.

    HTML also reads some names without one, as in ``x &amp</b>``.
    """

    def kept(m: re.Match) -> str:
        known = len(m[0]) > 1 if m[1] is None else m[1] in entities.html5
        return m[0] if known else f"&amp;{m[0][1:]}"

    return REFERENCE.sub(kept, html)


def parsed(html: str | None) -> Page:
    page = Page()
    page.read(html or "")
    return page


def visible_text(page: Page) -> str:
    """Text lines without scripts and styles, then the images' descriptions; lines are trimmed and never empty."""
    lines = [t for t, at in zip(page.texts, page.owner, strict=True) if at < 0 or not page.hidden[at]]
    lines += [page.attrs[k].get("alt", "") for k in page.all("img") if not page.hidden[k]]
    return "\n".join(x for t in lines for line in t.splitlines() if (x := line.strip()))


#: A base and references to which ``urljoin`` just adds one to the other, or takes the reference alone.
PLAIN_BASE = re.compile(r"https?://[a-z0-9][a-z0-9.-]*(?=/|$)(?:/[A-Za-z0-9_~/-]*)?").fullmatch
PLAIN_HOST = re.compile(r"https?://[a-z0-9][a-z0-9.-]*").match
PLAIN_PATH = re.compile(r"/[A-Za-z0-9_~-][A-Za-z0-9_~/-]*(?:\?[A-Za-z0-9_=&-]+)?(?:#[A-Za-z0-9_=&-]+)?").fullmatch
PLAIN_URL = re.compile(r"https?://[a-z0-9][a-z0-9.-]*(?:/[A-Za-z0-9_~/-]*)?(?:\?[A-Za-z0-9_=&-]+)?(?:#[A-Za-z0-9_=&-]+)?").fullmatch
PLAIN_FRAGMENT = re.compile(r"#[A-Za-z0-9_=&-]+").fullmatch


def resolved(base: str | None, href: str) -> str:
    if base and PLAIN_BASE(base):
        if PLAIN_PATH(href):
            return PLAIN_HOST(base)[0] + href
        if PLAIN_FRAGMENT(href):
            return base + href
        if PLAIN_URL(href):
            return href
    try:
        return urljoin(base or "", href)
    except ValueError:
        return href


def per_page(pages: DataFrame, keys: list[str], inputs: list[str], made: str, make: Callable[..., list[tuple]]) -> DataFrame:
    """``make(*inputs)`` gives a page's rows, of the columns ``made``; the key columns go before them as they are.

    Pages are large, so the session's Arrow batches are lowered to ``BATCH_PAGES`` rows and stay so.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    spark = pages.sparkSession
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > BATCH_PAGES:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_PAGES)
    fresh = StructType.fromDDL(made)
    target = to_arrow_schema(fresh)
    source = pages.select(*keys, *inputs)
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, of = [], []
            for k, page in enumerate(zip(*(c.to_pylist() for c in batch.columns[n_keys:]), strict=True)):
                own = make(*page)
                rows.extend(own)
                of.extend([k] * len(own))
            kept = [batch.column(k).take(pa.array(of, pa.int64())) for k in range(n_keys)]
            columns = [pa.array([r[k] for r in rows], f.type) for k, f in enumerate(target)]
            yield pa.RecordBatch.from_arrays([*kept, *columns], names=[*batch.schema.names[:n_keys], *target.names])

    return source.mapInArrow(run, StructType([*source.schema.fields[:n_keys], *fresh.fields]))
