"""Exact token counts of every prefix of a text, by dynamic programming over byte-pair encodings.

A sequence of tokens is the encoding of its text exactly if each two neighbours are the encoding of
their own concatenation. So the last token of a word's prefix is the one token that ends there and
agrees with the last token of what precedes it, and a prefix's count is one more than the count
before that token. Each word is worked on from left to right once; the table of its prefixes'
counts then answers how long a text is, where it has to be cut for a budget, and what any slice
costs, without encoding again.

White space always separates words, so a text's table is its words' tables added up. Words are
kept in a cache of bounded size in each Python worker.
"""

from __future__ import annotations

import functools
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches, table, utf8

#: Words whose tables a worker keeps at most.
CACHE_WORDS = 600_000
#: Pairs of tokens whose agreement a worker keeps at most.
CACHE_PAIRS = 500_000
#: Lower-case Latin letters, then ASCII marks but the apostrophe: each character is one of NFC and of lower case.
_USUAL = re.compile(r"([a-z\u00df-\u00f6\u00f8-\u00ff]*)([!-&(-/:-@\[-`{-~]*)")
_CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def _byte_letters() -> list[str]:
    """Byte-level vocabularies write a byte as a printable character: itself, or one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]


class _Word:
    """A word that grows: its last symbols, and for as many of its prefixes the last token and the number of tokens."""

    __slots__ = ("keep", "text", "off", "token", "count")

    def __init__(self, keep: int):
        self.keep, self.text, self.off, self.token, self.count = keep, "", 0, [""], [0]

    def branch(self) -> _Word:
        other = _Word(self.keep)
        cut = max(0, len(self.text) - self.keep)
        other.text, other.off, other.token, other.count = self.text[cut:], self.off + cut, self.token[cut:], self.count[cut:]
        return other

    def add(self, c: PrefixCounter, symbols: str) -> None:
        for symbol in symbols:
            self.text += symbol
            end = len(self.text)
            for q in range(max(0, end - self.keep), end):
                piece = self.text[q:]
                if piece in c.open and (q + self.off == 0 or c.agrees(self.token[q], piece)):
                    self.token.append(piece)
                    self.count.append(self.count[q] + 1)
                    break
            if len(self.text) > 8 * self.keep:
                cut = len(self.text) - self.keep
                self.text, self.off, self.token, self.count = self.text[cut:], self.off + cut, self.token[cut:], self.count[cut:]

    def ended(self, c: PrefixCounter) -> int:
        end = len(self.text)
        for q in range(max(0, end - self.keep), end):
            piece = self.text[q:]
            if piece in c.shut and (q + self.off == 0 or c.agrees(self.token[q], piece + c.end)):
                return self.count[q] + 1
        raise ValueError(f"no token of the vocabulary ends {self.text!r}")


class _Line:
    """Normalised, lower-case text read character by character; ``value`` is its number of tokens if it ended there."""

    __slots__ = ("c", "base", "word", "kind", "short")

    def __init__(self, c: PrefixCounter):
        self.c, self.base, self.word, self.kind, self.short = c, 0, None, "", ""

    def branch(self) -> _Line:
        other = _Line(self.c)
        other.base, other.kind, other.short = self.base, self.kind, self.short
        other.word = self.word.branch() if self.word else None
        return other

    def _end(self) -> None:
        if self.word:
            self.base += self.word.ended(self.c)
            self.word = None
        self.kind = self.short = ""

    def feed(self, low: str) -> None:
        """One character."""
        c, short = self.c, self.short + low
        if self.short and short in _CONTRACTIONS:
            # an apostrophe that began a word and what it takes with it are a word of their own
            if len(self.short) == 2:
                self.base -= self.before_short()
            self.word = None
            self.base += c.whole(c.spelled(short))
            self.kind = self.short = ""
            return
        begins = bool(self.short) and any(x.startswith(short) for x in _CONTRACTIONS)
        kind = _kind(low)
        if kind == "W":
            self._end()
            return
        if not self.word or kind != self.kind or kind == "N":
            fresh_quote = low == "'"
            self._end()
            self.word, self.kind = _Word(c.longest), kind
            self.short = short if begins else "'" if fresh_quote else ""
        else:
            self.short = ""
        self.word.add(c, c.spelled(low))

    def before_short(self) -> int:
        """Tokens that an apostrophe cost as a word, before it turned out to begin a longer contraction."""
        return self.c.whole(self.c.spelled("'"))

    def value(self) -> int:
        return self.base + (self.word.ended(self.c) if self.word else 0)


def _lower(text: str) -> str:
    """Each character by itself; some become several."""
    return "".join(ch.lower() for ch in text)


def _kind(low: str) -> str:
    kind = unicodedata.category(low[0])[0]
    return kind if kind in "LN" else "W" if low.isspace() and not "\x1c" <= low <= "\x1f" else "S"


@functools.cache
def _joining() -> frozenset[str]:
    """Characters of class 0 that normalising may join to the one before."""
    parts = (unicodedata.decomposition(chr(k)).split() for k in range(0x20000))
    return frozenset(x for p in parts if len(p) == 2 and not p[0].startswith("<") for x in [chr(int(p[1], 16))] if not unicodedata.combining(x)) | frozenset(map(chr, [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]))


def _apart(ch: str) -> bool:
    """Normalising never joins or moves the character across its left border."""
    if ch < "\u0300":
        return True
    first = unicodedata.normalize("NFD", ch)[0]
    return not unicodedata.combining(ch) and not unicodedata.combining(first) and ch not in _joining() and first not in _joining()


class PrefixCounter:
    """Counts for a vocabulary file of the kind: NFC, lower case, words by letters, digits and marks, BPE with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.end = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or not self.end:
            raise ValueError("a BPE vocabulary with word ends is asked for")
        self.vocab = model["vocab"]
        self.ranks: dict[tuple[str, str], int] = {}
        self.halves: dict[str, tuple[int, str, str]] = {}  # token -> rank of the merge that makes it, its halves
        for k, m in enumerate(model["merges"]):
            x, y = m if isinstance(m, list) else m.split(" ")
            self.ranks[x, y] = k
            self.halves.setdefault(x + y, (k, x, y))
        self.open = {t for t in self.vocab if not t.endswith(self.end)} | set(_byte_letters())
        self.shut = {t.removesuffix(self.end) for t in self.vocab if t.endswith(self.end) and t != self.end}
        self.longest = max(map(len, self.open | self.shut))
        self.special = tuple(t["content"] for t in spec["added_tokens"])
        self.letters = _byte_letters()
        self.agreed: dict[tuple[str, str], bool] = {}
        self.spell = dict(enumerate(self.letters))
        self.last: dict[bytes, int] = {}
        self.words: dict[str, int] = {}

    def agrees(self, left: str, right: str) -> bool:
        """Whether no merge across the border comes before the merges that make the two tokens.

        The later of the merges that reach the border is undone, again and again; a merge of the
        two pieces at the border that ranks before it would have been made first.
        """
        if (known := self.agreed.get((left, right))) is not None:
            return known
        a, b, limit, known = left, right, 1 << 30, True
        while True:
            if self.ranks.get((a, b), 1 << 30) < limit:
                known = False
                break
            x, y = self.halves.get(a), self.halves.get(b)
            if x is None and y is None:
                break
            if y is None or x is not None and x[0] > y[0]:
                limit, a = x[0], x[2]
            else:
                limit, b = y[0] + 1, y[1]
        if len(self.agreed) > CACHE_PAIRS:
            self.agreed.clear()
        self.agreed[left, right] = known
        return known

    def states(self, s: str, upto: int) -> tuple[list[str], list[int]]:
        """The table: of each prefix of a word that goes on, the last token and the number of tokens."""
        opens, longest, agreed = self.open, self.longest, self.agreed
        token, count = [""], [0]
        for p in range(1, upto + 1):
            for q in range(p - longest if p > longest else 0, p):
                piece = s[q:p]
                if piece in opens:
                    if q:
                        left = token[q]
                        fine = agreed.get((left, piece))
                        if not (self.agrees(left, piece) if fine is None else fine):
                            continue
                    token.append(piece)
                    count.append(count[q] + 1)
                    break
        return token, count

    def ended(self, s: str, p: int, token: list[str], count: list[int]) -> int:
        """Tokens of a word's prefix of ``p`` symbols that ends there."""
        for q in range(max(0, p - self.longest), p):
            piece = s[q:p]
            if piece in self.shut and (q == 0 or self.agrees(token[q], piece + self.end)):
                return count[q] + 1
        raise ValueError(f"no token of the vocabulary ends {s[:p]!r}")

    def word(self, s: str) -> list[int]:
        """Token counts of all prefixes of one word, given in byte letters."""
        token, count = self.states(s, len(s) - 1)
        return [self.ended(s, p, token, count) for p in range(1, len(s) + 1)]

    def whole(self, s: str) -> int:
        """Tokens of one word, kept for the next time."""
        if not s:
            return 0
        if (n := self.words.get(s)) is None:
            token, count = self.states(s, len(s) - 1)
            n = self.words[s] = self.ended(s, len(s), token, count)
        return n

    def spelled(self, low: str) -> str:
        return "".join(self.letters[b] for b in low.encode())

    def total(self, chunk: bytes) -> int:
        """Tokens of a chunk: most are letters and then marks, two words; of the rest each word is counted once."""
        text = chunk.decode().lower()
        if (m := _USUAL.fullmatch(text)) and "<|" not in text:
            return self.whole(m[1].encode().decode("latin-1").translate(self.spell)) + self.whole(m[2])
        out = 0
        for stretch, mark in self._stretches(chunk.decode()):
            line = _Line(self)
            for low in _lower(unicodedata.normalize("NFC", stretch)):
                line.feed(low)
            out += line.value() + bool(mark)
        return out

    def _stretches(self, text: str) -> Iterator[tuple[str, str]]:
        """What lies between special strings, each with the one that ends it; they are found before anything is normalised."""
        at = 0
        while True:
            found = [(k, s) for s in self.special for k in [text.find(s, at)] if k >= 0]
            if not found:
                yield text[at:], ""
                return
            k, mark = min(found)
            yield text[at:k], mark
            at = k + len(mark)

    def _plain(self, chars: str) -> list[int]:
        """Counts after each character of a stretch without special strings."""
        kinds = []
        lowered = []
        for ch in chars:
            low = ch.lower()
            lowered.append(low)
            kind = unicodedata.category(low[0])[0]
            kinds.append("L" if kind == "L" else "N" if kind == "N" else "W" if low.isspace() and not "\x1c" <= low <= "\x1f" else "S")
        out, base, i, n = [], 0, 0, len(chars)
        while i < n:
            if kinds[i] == "W":
                out.append(base)
                i += 1
                continue
            j = i + 1
            short = next((c for c in _CONTRACTIONS if chars[i] == "'" and "".join(lowered[i : i + len(c)]) == c), None)
            if short:
                j = i + len(short)
            elif kinds[i] != "N":
                while j < n and kinds[j] == kinds[i]:
                    j += 1
            spelled = ["".join(self.letters[b] for b in low.encode()) for low in lowered[i:j]]
            table = self.word("".join(spelled))
            at, done = 0, []
            for part in spelled:
                at += len(part)
                done.append(table[at - 1])
            if short and len(short) == 3:  # its first two characters alone are a mark and a letter
                done[1] = done[0] + self.word(spelled[1])[-1]
            out.extend(base + c for c in done)
            base += done[-1]
            i = j
        return out

    def table(self, chunk: str) -> array:
        """Token counts of the prefixes of a chunk without ASCII white space, by code points."""
        out, base = array("l"), 0
        for stretch, mark in self._stretches(chunk):
            text = stretch + mark[:-1]
            if not text:
                continue
            plain = unicodedata.is_normalized("NFC", text) and all(len(c.lower()) == 1 for c in text)
            counts = self._plain(text) if plain else self._composed(text)
            out.extend(base + c for c in counts)
            if mark:
                base += (counts[len(stretch) - 1] if stretch else 0) + 1
                out.append(base)
        return out

    def _composed(self, text: str) -> list[int]:
        """The same where normalising joins or moves characters: a stretch up to where it can't is normalised by itself.

        One line is fed with whole stretches; prefixes that end in a stretch branch off it. A branch goes on where the
        longer prefix only adds to the shorter one, so that a long stretch of marks is read once as well.
        """
        borders = [k for k, ch in enumerate(text) if k == 0 or _apart(ch)] + [len(text)]
        line, out = _Line(self), []
        for a, b in zip(borders, borders[1:]):
            made, side, had = "", line.branch() if b - a > 1 else line, ""
            for k in range(a, b):
                own = unicodedata.combining(text[k])
                if own and len(made) > 1 and own == unicodedata.combining(made[-1]) and unicodedata.combining(text[k - 1]) and not unicodedata.decomposition(text[k]):
                    made += text[k]  # blocked and in order: it stays as it is, after the last
                else:
                    made = unicodedata.normalize("NFC", text[a : k + 1])
                if not made.startswith(had):
                    side, had = line.branch(), ""
                for low in _lower(made[len(had) :]):
                    side.feed(low)
                had = made
                out.append(side.value())
            line = side
        return out

    def learn(self, chunks: set[bytes]) -> None:
        """Counts of chunks that aren't in the cache yet."""
        if len(self.last) + len(chunks) > CACHE_WORDS:
            self.last.clear()
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        for chunk in chunks:
            self.last[chunk] = self.total(chunk)

    def prefixes(self, text: bytes) -> array:
        """The whole table of a text: the counts of its prefixes of 0, 1, 2 ... code points."""
        out, base, at = array("l", [0]), 0, 0
        for chunk in text.split():
            start = text.index(chunk, at)
            out.extend([base] * (start - at))
            counts = self.table(chunk.decode())
            out.extend(base + c for c in counts)
            base += counts[-1]
            at = start + len(chunk)
        out.extend([base] * (len(text) - at))
        return out


_counters: dict[str, PrefixCounter] = {}


def counter(path: str) -> PrefixCounter:
    if path not in _counters:
        _counters[path] = PrefixCounter(path)
    return _counters[path]


def _fit(c: PrefixCounter, text: bytes, chunks: list[bytes], limit: int) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens, from the words' tables."""
    base = at = 0
    for chunk in chunks:
        total = base + c.last[chunk]
        if total > limit:
            inside = max((k + 1 for k, t in enumerate(c.table(chunk.decode())) if base + t <= limit), default=0)
            start = text.index(chunk, at)
            return len(text[:start].decode()) + inside
        at = text.index(chunk, at) + len(chunk)
        base = total
    return len(text.decode())


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = 2048, store: bool = False) -> DataFrame:
    """``docs`` less its text, with ``n_tokens``, ``fit_chars`` and, with ``store``, ``prefix_tokens``.

    ``fit_chars`` is the length of the longest prefix of at most ``limit`` tokens; ``prefix_tokens``
    is the table of all prefixes, which ``tokens_at`` and ``longest_prefix`` read. A null text
    counts as empty: no tokens, and a table of one 0. An empty table gives an empty result. A word of any length is
    read once, from left to right. Rows are independent, so repeated rows get equal results; there is no shuffle. A column of ``docs`` with one of the new names is replaced.
    """
    small_batches(docs.sparkSession)
    made = ("n_tokens", "fit_chars", "prefix_tokens")
    kept = [c for c in docs.columns if c != text and c not in made]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(f"`{text}`").alias("_text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("n_tokens"), F.lit(0).cast("long").alias("fit_chars"), *([F.array(F.lit(0)).alias("prefix_tokens")] if store else [])).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            split = [t.split() for t in texts]
            totals, fits, tables = [], [], []
            for t, chunks in zip(texts, split, strict=True):
                if new := set(chunks).difference(c.last):
                    c.learn(new)
                    if lost := set(chunks).difference(c.last):
                        c.learn(lost)
                n = sum(map(c.last.__getitem__, chunks))
                totals.append(n)
                fits.append(len(t.decode()) if n <= limit else _fit(c, t, chunks, limit))
                if store:
                    tables.append(c.prefixes(t))
            columns = [*batch.columns[:-1], pa.array(totals, pa.int64()), pa.array(fits, pa.int64())]
            if store:
                columns.append(pa.array([list(t) for t in tables], pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], *made[: len(columns) - len(kept)]])

    return source.mapInArrow(run, schema)


def tokens_at(prefix_tokens, length):
    """Tokens of the prefix of ``length`` code points, from a stored table."""
    return F.get(prefix_tokens, length)


def longest_prefix(prefix_tokens, budget):
    """Code points of the longest prefix of at most ``budget`` tokens, from a stored table."""
    return F.array_max(F.transform(prefix_tokens, lambda t, k: F.when(t <= budget, k)))


def op2_token_counts(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = table(spark, sf_dir, "documents").select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "text")
    out = count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 2048).alias("over_limit"), "fit_chars")
