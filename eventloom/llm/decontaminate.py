"""Benchmark decontamination with a generalised suffix automaton of the items' words.

The automaton holds every run of consecutive words of every item, each item inserted from the start
state, so that no run crosses items. A document's words are streamed through it: the state and matched
length after each word tell the longest run of item words that ends there. Where it reaches ``window`` words
(or a whole item that is shorter), the words of that window are hit, and the automaton tells whose they are.

Items are taken in blocks of bounded size, so an automaton's memory is bounded; a document is streamed
through each block's automaton. Words that no item has are told apart first, and only stretches of
known words long enough to hold a window are streamed.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import by_position, small_batches, table, utf8

#: Word bytes are 0-9, a-z and all of multi-byte characters; A-Z become a-z, anything else a blank.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words of items in one automaton at most, but for a single longer item.
BLOCK_WORDS = 200_000


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


class SuffixAutomaton:
    """Of several word sequences; ``window`` words, or all of a shorter sequence, make an occurrence."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: list[tuple[int, int, str]] = []  # state, words of the prefix that it holds, item
        for item, sequence in items:
            last = 0
            for n, w in enumerate(sequence, 1):
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
                if n >= window or n == len(sequence):
                    ends.append((last, min(n, window), item))
        # the state of a window is the one above the prefix's state that holds the window's length
        owners: dict[tuple[int, int], set[str]] = {}
        for state, size, item in ends:
            while self.length[self.link[state]] >= size:
                state = self.link[state]
            owners.setdefault((state, size), set()).add(item)
        self.owners: list[list[tuple[int, tuple[str, ...]]]] = [[] for _ in self.next]
        for (state, size), items_ in owners.items():
            self.owners[state].append((size, tuple(sorted(items_))))
        # the nearest state at or above that owns an occurrence, so that few links are followed
        self.up = [-1] * len(self.next)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__):
            parent = self.link[state]
            self.up[state] = parent if parent >= 0 and self.owners[parent] else self.up[parent] if parent >= 0 else -1
        self.shortest = min((min(len(s), window) for _, s in items if s), default=window)

    def _extend(self, last: int, c: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if (q := nxt[last].get(c)) is not None:
            return q if length[q] == length[last] + 1 else self._clone(last, q, c)
        cur = self._state(length[last] + 1, {}, 0)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, q, c)
        return cur

    def _state(self, length: int, edges: dict[int, int], link: int) -> int:
        self.next.append(edges)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        copy = self._state(self.length[p] + 1, dict(self.next[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def match(self, sequence: list[bytes]) -> tuple[list[tuple[int, int]], set[str], int]:
        """Hit spans ``[first, past the last)`` of words, disjoint and in order; items; the longest matched run."""
        get = self.vocab.get
        ids = np.fromiter((get(w, -1) for w in sequence), np.int32, len(sequence))
        edges = np.flatnonzero(np.diff(np.concatenate(([False], ids >= 0, [False])).astype(np.int8)))
        starts, stops = edges[::2], edges[1::2]
        long = stops - starts >= self.shortest
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        longest = 0
        # shorter stretches hold no window, but may hold the longest match
        short = sorted(zip(starts[~long].tolist(), stops[~long].tolist(), strict=True), key=lambda s: s[0] - s[1])
        for start, stop in [*zip(starts[long].tolist(), stops[long].tolist(), strict=True), *short]:
            if stop - start <= longest and stop - start < self.shortest:
                break
            state = matched = 0
            for at, c in enumerate(ids[start:stop].tolist(), start):
                while state and c not in self.next[state]:
                    state = self.link[state]
                    matched = self.length[state]
                if c in self.next[state]:
                    state = self.next[state][c]
                    matched += 1
                longest = max(longest, matched)
                if matched < self.shortest:
                    continue
                best, s = 0, state
                while s > 0:
                    for size, own in self.owners[s]:
                        if size <= matched:
                            best = max(best, size)
                            items.update(own)
                    s = self.up[s]
                if best:
                    first = at + 1 - best
                    while spans and spans[-1][1] >= first:
                        first = min(first, spans.pop()[0])
                    spans.append((first, at + 1))
        return spans, items, longest


@dataclass(frozen=True)
class Limits:
    """A span of hit words is removed from ``span_words`` on; a document goes where more than ``coverage`` of its words are hit."""

    window: int = 10
    span_words: int = 1
    coverage: float = 0.8


def _blocks(items: DataFrame, item_id: str, text: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items' words in blocks; rows come one partition at a time, so the driver holds a block."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("i"), utf8(text).alias("t")).filter(F.octet_length("t") > 0).distinct()
    block, size = [], 0
    for row in rows.orderBy("i", "t").toLocalIterator(prefetchPartitions=False):
        sequence = words(bytes(row["t"]))
        if not sequence:
            continue
        if block and size + len(sequence) > block_words:
            yield block
            block, size = [], 0
        block.append((row["i"], sequence))
        size += len(sequence)
    if block:
        yield block


def find_hits(docs: DataFrame, items: DataFrame, window: int = 10, text: str = "text", item_id: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``_words``, ``_spans`` (of hit words, as first and past the last), ``_items`` and ``_longest``.

    A null text has no words. An item without words matches nothing; items with equal ids are
    one item; a null id is the empty string. Without items nothing is hit. Repeated documents get equal
    results. Columns of ``docs`` named like the four are replaced. A document isn't shuffled, and nothing
    of it but its own text decides its result; with several blocks it passes from one automaton to the next.
    """
    spark = docs.sparkSession
    small_batches(spark)
    made = ["_words", "_spans", "_items", "_longest"]
    kept = [c for c in docs.columns if c not in made]
    out = docs.select(*[F.col(f"`{c}`") for c in kept]).withColumns(
        {"_words": F.lit(0).cast("long"), "_spans": F.array().cast("array<struct<first:int,past:int>>"), "_items": F.array().cast("array<string>"), "_longest": F.lit(0)}
    )
    schema = out.schema
    found = False
    for block in _blocks(items, item_id, item_text, block_words):
        out, found = _through(out, kept, block, window, text, schema), True
    return out if found else _through(out, kept, [], window, text, schema)


def _through(docs: DataFrame, kept: list[str], block: list[tuple[str, list[bytes]]], window: int, text: str, schema) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(block)
    where, key = kept.index(text), uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton(key, sent.value, window)
        for batch in batches:
            counts, spans, items, longest = [], [], [], []
            earlier = zip(*(batch.column(len(kept) + k).to_pylist() for k in (1, 2, 3)), strict=True)
            for raw, (old, had, most) in zip(batch.column(where).cast(pa.binary()).to_pylist(), earlier, strict=True):
                sequence = words(raw or b"")
                hit, own, run_length = automaton.match(sequence)
                counts.append(len(sequence))
                spans.append(_joined([*((s["first"], s["past"]) for s in old), *hit]))
                items.append(sorted(own.union(had)))
                longest.append(max(most, run_length))
            columns = [
                *batch.columns[: len(kept)],
                pa.array(counts, pa.int64()),
                pa.array([[{"first": a, "past": b} for a, b in s] for s in spans], pa.list_(pa.struct([("first", pa.int32()), ("past", pa.int32())]))),
                pa.array(items, pa.list_(pa.string())),
                pa.array(longest, pa.int32()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, schema)


_automata: dict[str, SuffixAutomaton] = {}


def _automaton(key: str, block: list[tuple[str, list[bytes]]], window: int) -> SuffixAutomaton:
    """Built once in each Python worker; a worker keeps a few."""
    if key not in _automata:
        if len(_automata) >= 4:
            _automata.clear()
        _automata[key] = SuffixAutomaton(block, window)
    return _automata[key]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def hit_words():
    return F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["past"] - s["first"])


def decontaminate(docs: DataFrame, items: DataFrame, limits: Limits = Limits(), text: str = "text") -> DataFrame:
    """``docs`` less contaminated spans, and less documents whose share of hit words exceeds the limit.

    A span goes from its first word's first character to its last word's last; what stands between
    spans stays as it is. A document without hits is unchanged; see ``find_hits`` for nulls. Columns of
    ``docs`` go through whatever their names.
    """
    plain, name = by_position(docs)
    hits = find_hits(plain, items, limits.window, name[text])
    hits = hits.filter(hit_words() <= limits.coverage * F.col("_words"))
    kept = plain.columns
    where = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                t if not any(s["past"] - s["first"] >= limits.span_words for s in spans) else cut(t, [(s["first"], s["past"]) for s in spans if s["past"] - s["first"] >= limits.span_words])
                for t, spans in zip(batch.column(where).to_pylist(), batch.column(len(kept)).to_pylist(), strict=True)
            ]
            columns = list(batch.columns[: len(kept)])
            columns[where] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=list(kept))

    return hits.select(*kept, "_spans").mapInArrow(run, plain.schema).toDF(*docs.columns)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of each span and what lies between them."""
    raw = text.encode()
    folded = raw.translate(_FOLD)
    places, at = [], 0
    for w in folded.split():
        at = folded.index(w, at)
        places.append((at, at + len(w)))
        at += len(w)
    out, at = [], 0
    for first, past in spans:
        out.append(raw[at : places[first][0]])
        at = places[past - 1][1]
    return b"".join([*out, raw[at:]]).decode()


def op6_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    hits = find_hits(docs, table(spark, sf_dir, "benchmark"))
    return hits.select(
        "doc_id", F.col("_words").alias("n_words"), hit_words().alias("n_hit"), F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_items"), ","), 256).alias("items_sha256"), (F.size("_spans") > 0).alias("contaminated"),
        F.col("_longest").alias("longest_run"),
    )
