"""Main text of web pages, with site templates removed by counting equal element subtrees per host.

First pass: each page's elements are hashed from the leaves up (name, classes, text and the children's
hashes). Spark counts, for each host and hash, on how many different pages the subtree stands; pages whose
article is the same count once, so that a copied article isn't taken for a template. What holds the article is
the markup's ``article`` and ``main`` or, without them, the smallest element with more than half of the page's
text; it is never a template itself. How often a subtree has to recur depends on the host's number of pages and
on where it stands: little around the article, far more in it (see ``recurring_subtrees``). Lists of links count by their
shape too, for menus change their labels. Second pass: subtrees that recur are deleted; a page whose article is mostly recurring prose
is a copy and keeps its prose. Then the article is looked for in what is left, and what markup itself declares to
be a menu, header, footer, sidebar, notice, advert, form or comment goes as well.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches, staged, table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
#: Start tags that end an open paragraph.
ENDS_P = BLOCK - {"br", "body", "html", "head", "option", "caption", "td", "th", "tr", "tbody", "thead", "tfoot", "title"}
#: Start tags that end an open element of the second set, up to an element of the third.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "article": ({"nav", "header", "footer", "aside", "form", "button", "select", "p"}, {"article", "main"}),
    "main": ({"nav", "header", "footer", "aside", "form", "button", "select", "p"}, {"article", "main"}),
}
NEVER = frozenset("script style noscript template head title iframe svg math object canvas audio video nav footer aside form button select option textarea dialog menu input".split())
#: Names in class, id and role attributes that declare an element not to be part of the article.
OUTSIDE = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsored promo promotion menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead sidebar cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription "
    "comment comments commentlist respond disqus share sharing social related recommended recommendations widget toolbar pagination pager login signup search "
    "contentinfo complementary dialog form".split()
)
#: Words that a name may add to those and mean the same.
LAYOUT = frozenset("site page main global top bottom left right box bar block area section wrap wrapper container inner outer list links buttons".split())
#: Words that declare as the first or last of a name, whatever the others are, and those that do so beside a plain word for things shown.
SURE = frozenset("comment comments commentlist disqus ad ads advert adverts advertisement advertising adsense sponsored newsletter breadcrumb breadcrumbs sidebar recommended recommendations".split())
BESIDE = frozenset("social share sharing related promo banner".split())
SHOWN = frozenset("icon icons post posts article articles item items story stories content media slot unit card cards grid row feed follow tools thread".split())
#: With these a name says what an element has, lacks or is about, and not what it is.
ABOUT = frozenset("has have no not non without with in is as category cat tag topic type format open closed enabled disabled count".split())
#: In the article a subtree is a template on this share of its host's pages, and on no fewer pages than that.
SHARE, FLOOR = 0.5, 3
#: Around the article it is one on two pages or on this share of the root of their number.
AROUND, ROOT_SHARE = 2, 0.2
#: Tells the hash of a subtree around the article from that of the same one in it.
_AROUND = 0x5DEECE66D
#: Tells the hash of what holds most of a page's text, which is a template itself where menus outweigh the article.
_MOST = 0x2545F4914F6CDD1D
#: What holds the article is never a template.
FRAME = frozenset("html body main article".split())
#: Their subtrees are mostly the article's own words: only the share of pages makes them a template.
PROSE = frozenset("html body main article p h1 h2 h3 h4 h5 h6 blockquote pre li td th dt dd figcaption caption".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_WORDS = re.compile(r"[^a-z0-9]+")


class Node:
    """``size``: characters of the subtree's text, ``linked``: those in links; ``inside``: it stands in the article; ``shape``: of a list of links."""

    __slots__ = ("tag", "words", "names", "children", "digest", "holds_article", "size", "linked", "inside", "shape", "tops", "foreign", "declared")

    def __init__(self, tag: str, words: frozenset[str] = frozenset(), names: frozenset[str] = frozenset()):
        self.tag, self.words, self.names, self.children, self.digest, self.holds_article = tag, words, names, [], 0, False
        self.size, self.linked, self.inside, self.shape = 0, 0, False, ""
        #: it stands in what isn't the page's article, though it may be one itself
        self.foreign = False
        #: of a page's root: how many elements say that they are an article
        self.declared = 0
        #: of a page's root: where its article is, None if markup doesn't say so
        self.tops: list[Node] | None = None

    def key(self) -> int:
        return self.digest if self.inside else self.digest ^ _AROUND

    def shape_key(self, host: str) -> int:
        """Of three links or more and no other text, around the article; else 0."""
        return 0 if self.inside or self.shape.count("a") < 3 or self.tag == "a" else _hash(f"{host}\x02{self.shape}".encode("utf-8", "surrogatepass"))


@functools.lru_cache(maxsize=100_000)
def _words_of(said: str) -> frozenset[str]:
    return frozenset(_WORDS.split(said.lower()))


@functools.lru_cache(maxsize=100_000)
def _names_of(said: str) -> frozenset[str]:
    return frozenset(said.lower().split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def updatepos(self, i: int, j: int) -> int:
        """Lines aren't counted."""
        return j

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("html", "body") and len(self.open) == 1:
            return
        if tag in ENDS_P:
            self._end({"p"}, {"div", "article", "section", "main", "td", "th", "li", "blockquote", "aside", "nav", "table", "form", "header", "footer"})
        if tag in ENDS:
            self._end(*ENDS[tag])
        said = [(k, v) for k, v in attrs if v and k in ("class", "id", "role")] if attrs else ()
        if said:
            # a heading's id is an anchor and says nothing of its kind
            named = [v for k, v in said if k != "id" or tag not in HEADINGS]
            node = Node(tag, _words_of(" ".join(v for _, v in said)), _names_of(" ".join(named)))
        else:
            node = Node(tag)
        self.open[-1].children.append(node)
        self.root.declared += _declares(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and len(self.open) > 1 and tag in ("svg", "path"):
            self.handle_endtag(tag)

    def _end(self, tags: set[str], border: set[str]) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag in tags:
                cut = k
                while tags & {"nav", "tr"} and cut > 1 and self.open[cut - 1].tag in tags:
                    cut -= 1
                del self.open[cut:]
                return
            if self.open[k].tag in border:
                return

    def handle_endtag(self, tag: str) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return

    def handle_data(self, data: str) -> None:
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    return tree.root


def _post_order(root: Node) -> list[Node]:
    """Parents after their children, without recursion: pages may nest deeply."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo.extend(c for c in node.children if not isinstance(c, str))
    return order[::-1]


def _hash(value: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(value, digest_size=8).digest(), "little", signed=True)


def hash_subtrees(root: Node, host: str) -> list[Node]:
    """Sets what each node says of its subtree, the digest 0 where it has no text; returns the nodes, children first."""
    nodes = _post_order(root)
    if root.declared > 1:
        _mark_foreign(root)
    for node in nodes:
        parts, shape = [node.tag, *sorted(node.words)], []
        for c in node.children:
            if isinstance(c, str):
                if text := " ".join(c.split()):
                    parts.append("t" + text)
                    node.size += len(text)
            else:
                node.holds_article |= c.holds_article or _declares(c) and not c.foreign
                if c.digest:
                    parts.append(f"n{c.digest}")
                    shape.append(c.shape)
                    node.size += c.size
                    node.linked += c.linked
        if node.tag == "a":
            node.linked = node.size
        if node.size and node.linked == node.size:
            node.shape = "a" if node.tag == "a" else f"{node.tag}({','.join(shape)})"
        node.digest = (_hash("\x00".join((host, *parts)).encode("utf-8", "surrogatepass")) or 1) if node.size else 0
    declared = root.holds_article
    tops = article_roots(root)
    root.tops = None if declared else tops
    for top in tops:
        for node in _post_order(top):
            node.inside = True
    return nodes


def most_text(root: Node) -> Node | None:
    """What stands for the article without markup of its own; None with it, or where it is the whole page."""
    return root.tops[0] if root.tops and root.tops[0] is not root else None


def without_dominant(root: Node, known) -> None:
    """Empties what holds most of the page's text if that recurs itself; then the article is what is left."""
    most = most_text(root)
    if most is not None and most.digest and known(most.digest ^ _MOST):
        for node in _post_order(most):
            node.inside = False
        most.children, most.holds_article = [], False


def _mark_foreign(root: Node) -> None:
    """Marks articles of comments, adverts and related posts, with all around and in them, where the page has another article."""
    own, foreign, todo = False, [], [(root, False)]
    for node in _post_order(root):
        # what holds the main container is never furniture, whatever its name
        node.holds_article = node.tag == "main" or any(not isinstance(c, str) and c.holds_article for c in node.children)
    while todo:
        node, out = todo.pop()
        mixed = node.holds_article or node.tag in PROSE and node.tag != "article"
        out = out or not mixed and (node.tag in NEVER or _named_outside(node))
        if out:
            foreign.append(node)
        own |= _declares(node) and not out
        todo.extend((c, out) for c in node.children if not isinstance(c, str))
    for node in _post_order(root):
        node.holds_article = False
    for node in foreign if own else ():
        node.foreign = True


def _named_outside(node: Node) -> bool:
    """An article is by a whole name only, for its classes say what it is about too."""
    return any(_says_outside(n, node.tag == "article") for n in node.names)


@functools.lru_cache(maxsize=100_000)
def _says_outside(name: str, whole: bool) -> bool:
    return _declared(name, OUTSIDE, whole)


def _declares(node: Node) -> bool:
    return node.tag in ("article", "main") or ("main" in node.words and node.tag == "div")


def article_roots(root: Node) -> list[Node]:
    """Where the article is: its outermost declared elements, else the smallest element with more than half of all text.

    Such an element is a container: where it would be a paragraph or the like, it is what holds this. It and what it stands in
    hold the article from then on.
    """
    if root.holds_article:
        return _outermost(root, lambda _: False)
    path = [root]
    while (inner := next((c for c in path[-1].children if not isinstance(c, str) and 2 * c.size > root.size), None)) is not None:
        path.append(inner)
    while len(path) > 1 and (path[-1].tag in PROSE - FRAME or path[-1].tag not in BLOCK):
        path.pop()
    for node in path:
        node.holds_article = True
    return path[-1:]


def _outside(node: Node, in_article: bool) -> bool:
    if node.tag in NEVER or node.foreign:
        return True
    if node.tag == "header" and not in_article:
        return True
    if node.tag in FRAME or node.holds_article or in_article and node.tag in PROSE:
        return False
    return _named_outside(node) or (not in_article and node.tag not in PROSE and any(_declared(n, {"header"}) for n in node.names))


def _declared(name: str, known: frozenset[str] | set[str], whole: bool = False) -> bool:
    """The whole name says so or, unless ``whole``, one of its ends; a word in the middle, or beside what it has or is about, doesn't."""
    words = [w for w in _WORDS.split(name) if w]
    if set(words) & known and set(words) <= known | LAYOUT:
        return True
    told = [w for w in words if w not in LAYOUT]
    if whole or len(told) < 2 or known is not OUTSIDE or ABOUT & set(words):
        return False
    ends = {told[0], told[-1]}
    return bool(ends & SURE) or bool(ends & BESIDE) and bool(ends & SHOWN)


def _furniture(node: Node) -> bool:
    """A block that is no prose."""
    return node.tag in BLOCK and node.tag not in PROSE and not node.holds_article


def _template(node: Node, templates) -> bool:
    return bool(node.digest) and node.tag not in FRAME and not node.holds_article and templates(node)


def _candidates(nodes: list[Node]) -> list[Node]:
    return [n for n in nodes if n.digest and n.tag not in FRAME and not n.holds_article]


def _alone(parent: Node, node: Node) -> bool:
    """Blocks, and inline elements that stand in no sentence of their parent."""
    return node.tag in BLOCK or not any(isinstance(c, str) and c.strip() for c in parent.children)


def _outermost(root: Node, gone) -> list[Node]:
    """The outermost articles and main containers in page order, but for what is furniture by its own name."""
    out: list[Node] = []
    todo = [root]
    while todo:
        node = todo.pop()
        if node.tag in NEVER or _outside(node, False) or gone(node):
            continue
        if _declares(node):
            out.append(node)
        else:
            todo.extend(c for c in reversed(node.children) if not isinstance(c, str))
    return out or [root]


def _roots(root: Node, templates) -> list[Node]:
    """What to read once templates are gone: declared articles and main containers, else the whole page."""
    return _outermost(root, lambda n: _furniture(n) and _template(n, templates))


def blocks(root: Node, templates) -> list[str]:
    """The article's blocks in page order, white space made single; a page that is mostly recurring prose keeps it."""
    hits = 0

    def counted(node: Node) -> bool:
        nonlocal hits
        found = templates(node)
        hits += found
        return found

    out = _blocks(root, counted, True)
    if not hits:
        return out
    strict = _blocks(root, templates, False)
    return out if 2 * sum(map(len, out)) >= sum(map(len, strict)) else strict


def _blocks(root: Node, templates, prose: bool) -> list[str]:
    return [text for top in _roots(root, templates) for text in _read(top, _declares(top), templates, prose)]


def _read(top: Node, in_article: bool, templates, prose: bool) -> list[str]:
    """The blocks of one element. Templates around the article and furniture always go, and with ``prose`` any other."""
    out: list[str] = []
    buffer: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(buffer).split()):
            out.append(text)
        buffer.clear()

    todo: list[object] = [top]
    while todo:
        item = todo.pop()
        if item is None:
            flush()
        elif isinstance(item, str):
            buffer.append(item)
        elif item is not top and _outside(item, in_article):
            flush()
        else:
            if item.tag in BLOCK:
                flush()
                todo.append(None)
            for c in reversed(item.children):
                if isinstance(c, str) or not ((prose or not c.inside or _furniture(c)) and _template(c, templates) and _alone(item, c)):
                    todo.append(c)
                else:
                    todo.append(None if c.tag in BLOCK else " ")
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", url or "")
    return (m[1] if m else "").rpartition("@")[2].lower()


def _never(_: Node) -> bool:
    return False


#: Kinds of counted subtrees.
_PROSE, _BLOCK, _SHAPE = 0, 1, 2


def subtree_hashes(pages: DataFrame) -> DataFrame:
    """``h, page, host, inside, kind``: each page's distinct candidate subtrees (the host is part of the hash).

    ``page`` is the hash of the article's text. A row with 0 for its subtree stands for the page itself.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, bool, int]] = []
            for url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                root, host = parse(html or ""), host_of(url)
                nodes = hash_subtrees(root, host)
                tops = root.tops or article_roots(root)
                page = _hash("\n".join(t for top in tops for t in _read(top, True, _never, False)).encode("utf-8", "surrogatepass"))
                name = _hash(host.encode("utf-8", "surrogatepass"))
                mine = {(n.key(), n.inside, _BLOCK if _furniture(n) else _PROSE) for n in _candidates(nodes)}
                mine.update((k, False, _SHAPE) for n in nodes if n.shape and (k := n.shape_key(host)))
                rows.append((0, page, name, False, _PROSE))
                if (most := most_text(root)) is not None and most.digest:
                    whole, other = root.digest, _hash(f"{host}\x03".encode("utf-8", "surrogatepass"))
                    rows += [(0, whole, other, False, _PROSE), (most.digest ^ _MOST, whole, other, True, _PROSE)]
                rows.extend((h, page, name, inside, kind) for h, inside, kind in mine)
            columns = list(zip(*rows, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["h", "page", "host", "inside", "kind"])

    return pages.select("url", "html").mapInArrow(run, "h long, page long, host long, inside boolean, kind int")


def recurring_subtrees(pages: DataFrame, min_pages: int) -> DataFrame:
    """Hashes of subtrees that stand on enough different pages of their host, of which there are n.

    Around the article: on 2 pages, or on a fifth of the root of n if that is more. In it: prose on half of the pages and at
    least 3; other blocks also on ``min_pages`` or the root of n. Shapes of link lists: on half of the pages and at least 3.
    """
    found = subtree_hashes(pages).groupBy("h", "page", "host").agg(F.max("inside").alias("inside"), F.max("kind").alias("kind"))
    counts = found.groupBy("h", "host").agg(F.count(F.lit(1)).alias("pages"), F.max("inside").alias("inside"), F.max("kind").alias("kind"))
    # few subtrees recur: written once, so that pages are parsed once
    counts = staged(counts.filter((F.col("pages") >= min(AROUND, min_pages)) | (F.col("h") == 0)), "subtrees")
    whole = counts.filter("h = 0").select("host", F.col("pages").alias("n"))
    n, seen = F.col("n").cast("double"), F.col("pages")
    half = seen >= F.greatest(F.lit(float(FLOOR)), SHARE * n)
    around = ~F.col("inside") & (F.col("kind") != _SHAPE) & (seen >= F.greatest(F.lit(float(AROUND)), F.floor(ROOT_SHARE * F.sqrt(n))))
    block = F.col("inside") & (F.col("kind") == _BLOCK) & (seen >= F.greatest(F.lit(float(min_pages)), F.sqrt(n)))
    return counts.filter("h <> 0").join(whole, "host").filter(half | around | block).select("h").dropDuplicates()


def main_text(pages: DataFrame, min_pages: int = 10, broadcast_limit: int = 1_000_000) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    A null or empty html, and a page without an article's text, give an empty text; a null url is
    a host of its own. Repeated rows count as one page and get equal results. If at most
    ``broadcast_limit`` subtrees recur (8 bytes each), every task gets them all; beyond, each page
    gets its own by a join. Columns of ``pages`` besides the three named ones are not used.
    """
    spark = pages.sparkSession
    small_batches(spark)
    pages = pages.select("page_id", "url", "html")
    recurring = staged(recurring_subtrees(pages, min_pages), "templates")
    schema = pages.select("page_id", "url", F.lit("").alias("text"), F.lit(0).cast("long").alias("n_chars")).schema

    def texts(rows, lookup) -> list[str]:
        out = []
        for url, html, own in rows:
            root = parse(html or "")
            host = host_of(url)
            hash_subtrees(root, host)
            known = lookup if own is None else set(own).__contains__
            without_dominant(root, known)
            out.append("\n".join(blocks(root, lambda n: known(n.key()) or (n.shape != "" and known(n.shape_key(host))))).encode("utf-8", "replace").decode())  # noqa: B023
        return out

    def answer(batch: pa.RecordBatch, text: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], names=["page_id", "url", "text", "n_chars"])

    if recurring.count() <= broadcast_limit:
        known = spark.sparkContext.broadcast(np.sort(recurring.toArrow().column("h").to_numpy()))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            lookup = frozenset(known.value.tolist()).__contains__
            for batch in batches:
                urls, htmls = batch.column(1).to_pylist(), batch.column(2).to_pylist()
                yield answer(batch, texts(((u, h, None) for u, h in zip(urls, htmls, strict=True)), lookup))

        return pages.mapInArrow(run, schema)

    def own_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys, hashes = [], [], []
            for page, key, url, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                host, root = host_of(url), parse(html or "")
                nodes = _candidates(hash_subtrees(root, host))
                most = most_text(root)
                mine = {n.key() for n in nodes} | ({most.digest ^ _MOST} if most is not None else set()) | {k for n in nodes if n.shape and (k := n.shape_key(host))}
                ids.extend([page] * len(mine))
                keys.extend([key] * len(mine))
                hashes.extend(mine)
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.int64()), pa.array(hashes, pa.int64())], names=["page_id", "k", "h"])

    keyed = pages.withColumn("k", F.xxhash64("url", "html"))
    kind = dict(pages.dtypes)["page_id"]
    owned = keyed.select("page_id", "k", "url", "html").mapInArrow(own_hashes, f"page_id {kind}, k long, h long").join(recurring, "h", "left_semi")
    owned = owned.groupBy("page_id", "k").agg(F.collect_set("h").alias("own"))
    joined = keyed.alias("a").join(owned.alias("b"), F.col("a.page_id").eqNullSafe(F.col("b.page_id")) & (F.col("a.k") == F.col("b.k")), "left")

    def run_own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)
            yield answer(batch, texts(((u, h, o or ()) for u, h, o in rows), None))

    return joined.select("a.page_id", "a.url", "a.html", "b.own").mapInArrow(run_own, schema)


def op3_html_text(spark, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))
