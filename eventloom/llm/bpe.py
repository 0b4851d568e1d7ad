"""Byte-level BPE: texts to ids and back, by the ranks of a vocabulary file.

A text is split by a pattern; each match is encoded by itself. A match that is a token is that token. In any
other, the pair of neighbouring parts with the lowest rank is merged, the leftmost of equal ones, until no pair
has a rank. The pairs are known by the byte at which their left part begins, and a segment tree over these byte
positions keeps the leftmost lowest rank of every stretch: its root is the next merge. A merge changes three
leaves, each of which costs a logarithm of the match's length, so a match of any length takes n log n steps.

Short matches that a batch of texts brings for the first time are worked on together: their trees are the rows of one
array, and each round makes the next merge of every one of them.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import small_batches, table, utf8

#: Matches whose ids a worker keeps at most, and the longest match, in characters, that it keeps.
CACHE_MATCHES, CACHE_CHARS = 600_000, 48
#: Bytes of a match that is worked on with others, and bytes of all those in one array.
FOREST_BYTES, FOREST_CELLS = 64, 1 << 18
#: A leaf holds its pair's rank above as many bits of its position.
PLACE_BITS = 40
NO_PAIR = (1 << 62) - 1


class MergeTree:
    """Parts of one byte sequence, and the segment tree of the ranks of neighbouring parts."""

    __slots__ = ("data", "ranks", "width", "low", "after", "before")

    def __init__(self, data: bytes, ranks: dict[bytes, int]):
        n = len(data)
        self.data, self.ranks = data, ranks
        self.width = 1 << max(0, n - 1).bit_length()
        # the part that begins at a byte ends where the next begins; a byte inside a part is never looked at
        self.after = array("q", range(1, n + 2))
        self.before = array("q", range(-1, n))
        low = self.low = array("q", [NO_PAIR]) * (2 * self.width)
        for i in range(n - 1):
            low[self.width + i] = self._pair(i)
        for k in range(self.width - 1, 0, -1):
            low[k] = min(low[2 * k], low[2 * k + 1])

    def _pair(self, i: int) -> int:
        """Rank and position of the pair whose left part begins at ``i``."""
        middle = self.after[i]
        if middle >= len(self.data):
            return NO_PAIR
        rank = self.ranks.get(self.data[i : self.after[middle]])
        return NO_PAIR if rank is None else rank << PLACE_BITS | i

    def _put(self, i: int, value: int) -> None:
        low, k = self.low, self.width + i
        low[k] = value
        while k > 1:
            k >>= 1
            value = min(low[2 * k], low[2 * k + 1])
            if low[k] == value:
                break
            low[k] = value

    def merge_all(self) -> None:
        low, after, before, n = self.low, self.after, self.before, len(self.data)
        while (least := low[1]) != NO_PAIR:
            i = least & ((1 << PLACE_BITS) - 1)
            gone = after[i]
            end = after[i] = after[gone]
            if end < n:
                before[end] = i
            self._put(gone, NO_PAIR)
            self._put(i, self._pair(i))
            if before[i] >= 0:
                self._put(before[i], self._pair(before[i]))

    def parts(self) -> list[bytes]:
        out, i, n = [], 0, len(self.data)
        while i < n:
            out.append(self.data[i : self.after[i]])
            i = self.after[i]
        return out


def read_ranks(path: str) -> dict[bytes, int]:
    """The lines of a rank file: a token in base 64 and its rank, which is its id."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}
    if missing := [b for b in range(256) if bytes([b]) not in ranks]:
        raise ValueError(f"bytes without a rank: {missing[:5]}")
    return ranks


class MergeForest:
    """Trees of many short matches of up to ``width`` bytes, a row each; see ``MergeTree`` for one."""

    def __init__(self, ranks: dict[bytes, int]):
        """Ranks by the ids of two parts: all ways to cut a token in two tokens, in order."""
        at = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                a, b = ranks.get(token[:k]), ranks.get(token[k:])
                if a is not None and b is not None:
                    at[a << 32 | b] = rank
        self.codes = np.array(sorted(at), np.int64)
        self.found = np.array([at[c] for c in self.codes.tolist()], np.int64)
        self.of_byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)

    def _pairs(self, left: np.ndarray, right: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Leaves of pairs of ids."""
        if not len(self.codes):
            return np.full(len(left), NO_PAIR)
        code = left << 32 | right
        k = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[k] == code, self.found[k] << PLACE_BITS | place, NO_PAIR)

    def merged(self, matches: list[bytes], width: int) -> list[bytes]:
        """The ids of each match, as 32-bit integers in bytes; ``width`` is a power of two."""
        count = len(matches)
        sizes = np.fromiter(map(len, matches), np.int64, count)
        given = np.frombuffer(b"".join(m.ljust(width, b"\0") for m in matches), np.uint8).reshape(count, width)
        live = np.arange(width) < sizes[:, None]
        part = np.zeros((count, width + 1), np.int64)  # the id of the part that begins at a byte
        part[:, :width] = self.of_byte[given]
        after = np.broadcast_to(np.arange(1, width + 2), (count, width + 1)).copy()
        before = np.broadcast_to(np.arange(-1, width), (count, width + 1)).copy()
        low = np.full((count, 2 * width), NO_PAIR, np.int64)
        row, at = np.nonzero(live[:, 1:])
        low[row, width + at] = self._pairs(part[row, at], part[row, at + 1], at)
        level = width
        while level > 1:
            half = level >> 1
            low[:, half:level] = np.minimum(low[:, level : 2 * level : 2], low[:, level + 1 : 2 * level : 2])
            level = half
        while len(row := np.flatnonzero(low[:, 1] != NO_PAIR)):
            least = low[row, 1]
            i = least & ((1 << PLACE_BITS) - 1)
            gone = after[row, i]
            end = after[row, gone]
            part[row, i], after[row, i], before[row, end], live[row, gone] = least >> PLACE_BITS, end, i, False
            prior = before[row, i]
            low[row, width + gone] = NO_PAIR
            low[row, width + i] = np.where(end < sizes[row], self._pairs(part[row, i], part[row, end], i), NO_PAIR)
            has = prior >= 0
            low[row[has], width + prior[has]] = self._pairs(part[row[has], prior[has]], part[row[has], i[has]], prior[has])
            rows, node = np.concatenate([row, row, row[has]]), width + np.concatenate([gone, i, prior[has]])
            for _ in range(width.bit_length() - 1):
                node = node >> 1
                low[rows, node] = np.minimum(low[rows, 2 * node], low[rows, 2 * node + 1])
        flat = part[:, :width][live].astype(np.int32).tobytes()
        ends = np.cumsum(live.sum(1) * 4).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]


class Codec:
    """Encoder and decoder of one vocabulary, with the ids of frequent matches, as 32-bit integers in bytes."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.split = regex.compile(pattern).findall
        self.tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            self.tokens[rank] = token
        self.forest = MergeForest(self.ranks)
        self.known: dict[str, bytes] = {}

    def encode_matches(self, matches: set[str]) -> dict[str, bytes]:
        """The ids of each match."""
        out, short = {}, {}
        for match in matches:
            data = match.encode()
            if (rank := self.ranks.get(data)) is not None:
                out[match] = np.int32(rank).tobytes()
            elif len(data) <= FOREST_BYTES:
                short.setdefault(1 << (len(data) - 1).bit_length(), []).append((match, data))
            else:
                tree = MergeTree(data, self.ranks)
                tree.merge_all()
                out[match] = np.fromiter(map(self.ranks.__getitem__, tree.parts()), np.int32).tobytes()
        for width, own in short.items():
            step = FOREST_CELLS // width
            for k in range(0, len(own), step):
                names, data = zip(*own[k : k + step], strict=True)
                out.update(zip(names, self.forest.merged(data, width), strict=True))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text."""
        split = list(map(self.split, texts))
        needed = set().union(*split)
        fresh = self.encode_matches(needed.difference(self.known))
        if len(self.known) + len(fresh) > CACHE_MATCHES:
            fresh |= {m: self.known[m] for m in needed.intersection(self.known)}
            self.known.clear()
        known = self.known
        known.update(fresh)
        made = [b"".join(map(known.__getitem__, matches)) for matches in split]
        if len(known) > CACHE_MATCHES:  # the texts alone bring more than are kept
            known.clear()
        else:
            for m in fresh:
                if len(m) > CACHE_CHARS:
                    del known[m]
        return made

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


_codecs: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The worker's codec, built once per vocabulary."""
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


def encode_texts(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` less its text, with ``ids array<int>``: the tokens of each whole text.

    Special tokens are ordinary text. A null text counts as empty and has no ids (an empty array); an empty table
    gives an empty result. Rows are independent, so repeated rows get equal ids and nothing is shuffled; a text of n
    bytes takes n log n steps and a few tens of bytes of memory per byte, wherever the pattern splits it. A column of ``docs`` named ``ids`` is
    replaced; all others go through unchanged, whatever their names.
    """
    small_batches(docs.sparkSession, 64)
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in (text, "ids")]
    source = docs.select(*kept, utf8(f"`{text}`").alias("ids"))
    schema = docs.select(*kept, F.array(F.lit(0)).alias("ids")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            made = c.encode([t.decode() for t in batch.column(batch.num_columns - 1).to_pylist()])
            ends = np.cumsum([0, *map(len, made)], dtype=np.int64) // 4
            if ends[-1] >= 2**31:
                raise OverflowError("a batch of texts with 2**31 tokens or more; lower the batch size")
            ids = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.frombuffer(b"".join(made), np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], ids], names=batch.schema.names)

    return source.mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str, pattern: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded binary``: the bytes that its ids stand for.

    Bytes, for a slice of a text's ids may end inside a character. Null ids give null, no ids give no bytes; an id
    that the vocabulary doesn't have raises IndexError. An empty table gives an empty result; a column named
    ``decoded`` is replaced.
    """
    small_batches(encoded.sparkSession, 64)
    kept = [c for c in encoded.columns if c != "decoded"]
    source = encoded.select(*[F.col(f"`{c}`") for c in kept])
    schema = source.withColumn("decoded", F.lit(None).cast("binary")).schema
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path, pattern)
        for batch in batches:
            lists = batch.column(at)
            flat, ends = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy().tolist()
            if len(flat) and flat.min() < 0:
                raise IndexError(f"no token has the id {flat.min()}")
            made = [None if gone else c.decode(flat[a:b].tolist()) for a, b, gone in zip(ends, ends[1:], lists.is_null().to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.binary())], names=[*batch.schema.names, "decoded"])

    return source.mapInArrow(run, schema)


def op11_byte_bpe(spark, sf_dir: str) -> DataFrame:
    """Every text of ``documents`` encoded and decoded again; see ``encode_texts`` and ``decode_ids``."""
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_texts(docs, *vocabulary)
    return decode_ids(encoded, *vocabulary).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
