"""SimHash near-duplicates by multi-index hashing.

A fingerprint has a bit where over half of the hashes of a text's shingles have it. Two fingerprints
that differ in at most ``radius`` bits differ in at most ``radius // segments`` bits in one of their
segments. So each distinct fingerprint is filed once per segment, looks up the Hamming ball around
its own segment, and what it finds is checked in full. With two segments of 32 bits and a radius of
3 that is 33 look-ups per segment, and buckets stay small up to billions of fingerprints.

Documents of equal fingerprints are one class from the start and never paired with each other. Links are
between classes; components of links name each document's group.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import by_position, id_key, settled, small_batches, staged, table, unstaged, utf8
from eventloom.llm.graph import components

SEED = 42


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """XXH64 of each run of ``width`` words, A-Z lowered; of fewer words, all of them; of none, nothing."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    runs = zip(*(words[k : len(words) - width + 1 + k] for k in range(width)), strict=True)
    return np.fromiter((digest(s, SEED) for s in map(b" ".join, runs)), np.uint64, len(words) - width + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """Of 64 bits; nothing gives zero. Long texts are counted in pieces, so memory stays small."""
    total = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        bits = np.unpackbits(hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = 3, text: str = "text", samples: int = 0) -> DataFrame:
    """``docs`` less its text, with ``fp`` (a signed long) and, with ``samples``, as many ``marks``.

    A mark is the fingerprint of the three smallest hashes under one of ``samples`` orders: texts of
    similarity s share one with probability about ``s ** 3``.
    """
    small_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in (text, "fp", "marks")]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], utf8(text).alias("_text"))
    schema = docs.select(*[F.col(f"`{c}`") for c in kept], F.lit(0).cast("long").alias("fp"), *([F.array(F.lit(0).cast("long")).alias("marks")] if samples else [])).schema
    odd = (np.arange(1, samples + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints, marks = [], []
            for text_ in batch.column(len(kept)).to_pylist():
                hashes = shingle_hashes(text_, width)
                prints.append(fingerprint(hashes))
                if samples:
                    own = np.unique(hashes)
                    marks.append([_signed(fingerprint(_smallest(own, m))) for m in odd] if len(own) else [])
            columns = [*batch.columns[: len(kept)], pa.array(np.array(prints, np.uint64).view(np.int64), pa.int64())]
            if samples:
                columns.append(pa.array(marks, pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "fp", *(["marks"] if samples else [])])

    return source.mapInArrow(run, schema)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _smallest(hashes: np.ndarray, odd: np.uint64) -> np.ndarray:
    mixed = hashes * odd
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    return np.sort(mixed)[:3] if len(mixed) <= 3 else np.sort(np.partition(mixed, 2)[:3])


def ball(bits: int, radius: int) -> list[int]:
    """Masks of at most ``radius`` of ``bits`` bits."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def near_pairs(prints: DataFrame, radius: int = 3, segments: int = 2) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``fp`` that differ in at most ``radius`` bits."""
    bits = 64 // segments
    masks = F.array(*[F.lit(m).cast("long") for m in ball(bits, radius // segments)])
    low = (1 << bits) - 1

    def segment(k: int) -> Column:
        return F.shiftrightunsigned("fp", k * bits).bitwiseAND(F.lit(low).cast("long")) if k else F.col("fp").bitwiseAND(F.lit(low).cast("long"))

    keys = F.array(*[F.struct(F.lit(k).alias("k"), segment(k).alias("v")) for k in range(segments)])
    filed = prints.select("fp", F.explode(keys).alias("s")).select("s.k", "s.v", F.col("fp").alias("a"))
    asked = prints.select("fp", F.explode(keys).alias("s")).select("s.k", "s.v", F.col("fp").alias("b"), F.explode(masks).alias("m"))
    asked = asked.select("k", F.col("v").bitwiseXOR(F.col("m")).alias("v"), "b")
    close = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)
    # Spark takes an exploded table for as small as the one before, so these must never be broadcast
    return filed.join(asked.hint("merge"), ["k", "v"]).filter(close).select("a", "b").dropDuplicates()


def group_by_simhash(docs: DataFrame, width: int = 3, radius: int = 3, text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id, n_links`` per document.

    ``component_id`` is the smallest document id that links reach from it, its own included; ``n_links``
    counts the other fingerprints within the radius. Null and empty texts have the fingerprint
    zero, and link like any other. A null id is the smallest of all and named as null. Repeated rows
    and repeated ids are rows of their own; an empty table gives an empty result. Other columns are not used.
    """
    rows = staged(fingerprints(docs.select("doc_id", text), width, text), "fingerprints")
    classes = staged(rows.groupBy("fp").agg(F.min(id_key("doc_id")).alias("least")), "classes")
    pairs = staged(near_pairs(classes.select("fp"), radius), "near-pairs")
    found = components(pairs)
    ends = pairs.select(F.col("a").alias("fp")).unionByName(pairs.select(F.col("b").alias("fp"))).groupBy("fp").agg(F.count(F.lit(1)).alias("n_links"))
    named = classes.join(found.withColumnRenamed("node", "fp"), "fp", "left").join(ends, "fp", "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    roots = named.groupBy("component").agg(F.min("least").alias("root"))
    classes = staged(named.join(roots, "component").select("fp", "root", F.coalesce("n_links", F.lit(0)).alias("n_links")), "classes")
    root = F.when(F.col("root") == F.lit(-(2**63)), None).otherwise(F.col("root"))
    return rows.join(classes, "fp").select("doc_id", "fp", root.alias("component_id"), "n_links")


def _body(text: str) -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def text_hash(text: str, seed: int = 0) -> Column:
    """A hash of 64 bits of a text; null counts as empty."""
    return F.xxhash64(_body(text), F.lit(seed))


@dataclass(frozen=True)
class TextKeys:
    """Keys of 8 bytes that name texts: their hash, but another number for the few texts whose hash another text has too."""

    #: Hash of 128 bits of such a text, in hexadecimal digits, and its key.
    moved: tuple[tuple[str, int], ...] = ()
    #: The hashes that they would have.
    shared: tuple[int, ...] = ()

    def of(self, text: str) -> Column:
        own = text_hash(text)
        if not self.moved:
            return own
        by_digest = F.create_map(*[F.lit(x) for pair in self.moved for x in pair])
        other = F.try_element_at(by_digest, F.md5(_body(text).cast("binary")))
        return F.when(own.isin(*self.shared), F.coalesce(other, own)).otherwise(own)


def text_keys(docs: DataFrame, text: str = "text") -> TextKeys:
    """Keys under which different texts of ``docs`` (by their hashes of 128 bits) never share one, so that none is dropped for another's hash.

    One pass finds the hashes that several texts have: of n texts some n * n / 2 ** 65, a dozen of 2e10. The driver
    gets these few, gives all but the first text of each another number, and looks in one more pass whether that is
    free; it hardly ever is not.
    """
    hashed = docs.select(text_hash(text).alias("h"), F.md5(_body(text).cast("binary")).alias("m"))
    several = hashed.groupBy("h").agg(F.min("m").alias("a"), F.max("m").alias("b")).filter("a <> b").select("h")
    if several.isEmpty():
        return TextKeys()
    rows = hashed.join(several, "h", "left_semi").distinct().orderBy("h", "m").collect()
    first = {r["h"]: r["m"] for r in reversed(rows)}
    late = [r["m"] for r in rows if first[r["h"]] != r["m"]]
    at = 0
    while True:
        numbers = [int.from_bytes(hashlib.sha256(f"{at}:{m}".encode()).digest()[:8], "big", signed=True) for m in late]
        if len(set(numbers)) == len(late) and hashed.filter(F.col("h").isin(*numbers)).isEmpty():
            return TextKeys(tuple(zip(late, numbers, strict=True)), tuple(first))
        at += 1


def similar_groups(docs: DataFrame, width: int = 5, similarity: float = 0.8, radius: int = 3, samples: int = 16, text: str = "text", block: int = 512, keys: TextKeys | None = None) -> DataFrame:
    """``_key, _root`` per text that has near-duplicates: its hash, and the hash that names its group.

    Two texts are near-duplicates if the Jaccard similarity of their sets of shingles is ``similarity`` or
    more; a group is a component of such pairs, all of them. A first pass links what shares a
    neighbourhood of SimHash fingerprints or ``MARKS`` of ``samples`` marks, each text with the smallest key
    of a mark and with its neighbour by fingerprint. The second checks every pair that the first left in
    different groups and that the shingles which two prefixes share can't rule out.
    """
    if keys is None:
        keys = text_keys(docs, text)
    texts = docs.select(keys.of(text).alias("_key"), text)
    rows = staged(fingerprints(texts, width, text, samples).dropDuplicates(["_key"]), "fingerprints")
    classes = rows.groupBy("fp").agg(F.min("_key").alias("one"))
    prints = staged(classes, "classes")
    near = near_pairs(prints.select("fp"), radius)
    near = near.join(prints.select(F.col("fp").alias("a"), F.col("one").alias("x")), "a").join(prints.select(F.col("fp").alias("b"), F.col("one").alias("y")), "b").select("x", "y")
    same = rows.join(prints, "fp").filter("_key <> one").select(F.col("one").alias("x"), F.col("_key").alias("y"))
    marked = rows.select("_key", "fp", F.posexplode("marks").alias("k", "mark"))
    shared = marked.groupBy("k", "mark").agg(F.count(F.lit(1)).alias("n"), F.min("_key").alias("one")).filter("n > 1").drop("n")
    inside = marked.join(shared.hint("merge"), ["k", "mark"])
    star = inside.filter("_key <> one").select(F.col("one").alias("x"), F.col("_key").alias("y"), F.lit(1).alias("star"), F.lit(0).alias("chain"))
    # neighbours in a mark's order of fingerprints; a part of the fingerprint splits large marks
    order = Window.partitionBy("k", "mark", F.shiftrightunsigned("fp", 58)).orderBy("fp", "_key")
    chain = inside.withColumn("x", F.lag("_key").over(order)).filter("x is not null").select("x", F.col("_key").alias("y"), F.lit(0).alias("star"), F.lit(1).alias("chain"))
    sure = near.unionByName(same).select("x", "y", F.lit(MARKS).alias("star"), F.lit(MARKS).alias("chain"))
    every = sure.unionByName(star).unionByName(chain).groupBy(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    often = every.agg(F.sum("star").alias("star"), F.sum("chain").alias("chain")).filter(F.greatest("star", "chain") >= MARKS)
    tried = staged(often.select("x", "y"), "candidates")
    links = _verified(tried, texts, width, similarity, text)
    n_texts = rows.count()
    unstaged(rows, prints)

    posts = _postings(texts, n_texts, width, similarity, text)
    if posts.filter(F.col("df") > STAR).limit(1).count():
        # the text whose shingles are the most common of a bucket is likely the one that the others were made of
        open_ = _open(posts, links)
        pairs = staged(_new_pairs(_stars(open_, similarity), tried), "candidates")
        unstaged(open_)
        tried = tried.unionByName(pairs)
        links = staged(links.unionByName(_verified(pairs, texts, width, similarity, text)), "links")
    open_ = _open(posts, links)
    unstaged(posts)
    pairs = staged(_new_pairs(_bucket_pairs(open_, similarity, block), tried), "candidates")
    unstaged(open_)
    links = staged(links.unionByName(_verified(pairs, texts, width, similarity, text)), "links")
    return _named(links)


#: Texts that are looked at to find the common shingles, and the most of those that go to every task.
SAMPLE, COMMON = 20_000, 200_000
#: Buckets of more texts are compared with their most central text before all with all.
STAR = 64
#: Marks that a pair of the first pass shares; what shares fewer is left to the second, which misses nothing.
MARKS = 2


def _named(links: DataFrame) -> DataFrame:
    found = components(links.select(F.col("x").alias("a"), F.col("y").alias("b")))
    return found.select(F.col("node").alias("_key"), F.col("component").alias("_root"))


def _postings(texts: DataFrame, n_texts: int, width: int, similarity: float, text: str) -> DataFrame:
    """``tok, _key, n, pos, df``: the shingles of each text's prefix that stand in other prefixes too, with their places in it.

    With ``n`` shingles in one order for all texts, two sets of the similarity share one of the first
    ``n - ceil(similarity * n) + 1`` of each. Any order will do; common shingles come last, by their
    number in a sample, to keep buckets small. Texts without shingles share the bucket 0.
    """
    spark = texts.sparkSession
    small_batches(spark)
    source = texts.select("_key", utf8(text).alias("_text"))
    every = max(1, n_texts // SAMPLE)

    def all_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))], names=["tok"])

    # copies count as often as they stand there: that only puts their shingles later
    sample = source.filter(F.pmod("_key", F.lit(every)) == 0)
    counts = sample.mapInArrow(all_hashes, "tok long").groupBy("tok").agg(F.count(F.lit(1)).alias("c"))
    counts = staged(counts.filter(F.col("c") > max(8, n_texts // every // 1000)), "common")
    often = counts.orderBy(F.desc("c"), "tok").limit(COMMON).toArrow()
    unstaged(counts)
    toks = often.column("tok").to_numpy().view(np.uint64)
    by_tok = np.argsort(toks)
    common = spark.sparkContext.broadcast((toks[by_tok], often.column("c").to_numpy()[by_tok]))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, count = common.value
        for batch in batches:
            sizes, heads = [], []
            for t in batch.column(1).to_pylist():
                own = np.unique(shingle_hashes(t, width))
                rank = np.zeros(len(own), np.int64)
                if len(known):
                    at = np.minimum(np.searchsorted(known, own), len(known) - 1)
                    rank = np.where(known[at] == own, count[at], 0)
                head = own[np.lexsort((own, rank))][: len(own) - math.ceil(similarity * len(own) - 1e-9) + 1]
                sizes.append(len(own))
                heads.append(head.view(np.int64) if len(own) else np.zeros(1, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(heads, pa.list_(pa.int64()))], names=["_key", "n", "toks"])

    heads = staged(source.mapInArrow(prefixes, "_key long, n long, toks array<long>").dropDuplicates(["_key"]), "prefixes")
    posts = heads.select("_key", "n", F.posexplode("toks").alias("pos", "tok"))
    shared = posts.groupBy("tok").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    out = staged(posts.join(shared, "tok").select("tok", "_key", "n", "pos", "df"), "postings")
    unstaged(heads)
    return out


def _open(posts: DataFrame, links: DataFrame) -> DataFrame:
    """The buckets of ``posts`` that hold texts of more than one group, with each text's ``_root``."""
    rooted = staged(posts.join(_named(links), "_key", "left").withColumn("_root", F.coalesce("_root", "_key")), "rooted")
    mixed = rooted.groupBy("tok").agg(F.min("_root").alias("low"), F.max("_root").alias("high")).filter("low <> high").select("tok")
    out = staged(rooted.join(mixed, "tok", "left_semi"), "open")
    unstaged(rooted)
    return out


def _alike(a: str, b: str, similarity: float) -> Column:
    """Sets of these sizes can be of the similarity."""
    return F.least(a, b) >= similarity * F.greatest(a, b) - 1e-9


def _needed(a: str, b: str, similarity: float) -> Column:
    """How many shingles two sets of ``a`` and ``b`` shingles of the similarity share at least."""
    return similarity / (1 + similarity) * (F.col(a) + F.col(b)) - 1e-6


def _in_step(a: str, i: str, b: str, j: str, similarity: float) -> Column:
    """A shingle at places ``i`` and ``j`` of sets of ``a`` and ``b`` shingles can be common to similar sets.

    At most ``least(i, j)`` common ones come before it. Of two similar sets that holds at every common shingle.
    """
    most = F.least(F.col(a) - F.col(i), F.col(b) - F.col(j)) + F.least(i, j)
    return most >= _needed(a, b, similarity)


def _stars(posts: DataFrame, similarity: float) -> DataFrame:
    central = posts.groupBy("_key").agg(F.sum("df").alias("c"))
    large = posts.filter(F.col("df") > STAR).join(central, "_key")
    best = large.groupBy("tok").agg(F.max(F.struct("c", "_key", "n", "_root")).alias("s")).select("tok", F.col("s._key").alias("x"), F.col("s.n").alias("m"), F.col("s._root").alias("r"))
    pairs = large.join(best, "tok").filter((F.col("_root") != F.col("r")) & _alike("n", "m", similarity))
    # a quarter of a prefix that is a fifth of the set; what shares less is left to the comparison of all with all
    return pairs.groupBy("x", F.col("_key").alias("y"), "n").agg(F.count(F.lit(1)).alias("c")).filter(F.col("c") * 20 >= F.col("n")).select("x", "y")


def _bucket_pairs(posts: DataFrame, similarity: float, block: int) -> DataFrame:
    """Pairs of texts of different groups that can be of the similarity, by all shingles that their prefixes share.

    A large bucket is dealt by pairs of blocks. If the prefixes share ``c`` shingles, the last of them at places
    ``i`` and ``j``, the sets share at most ``c`` and what follows those places in the shorter rest.
    """
    parts = F.ceil(F.col("df") / block)
    dealt = posts.withColumn("p", F.pmod(F.xxhash64("_key"), parts)).withColumn("last", parts - 1)
    left = dealt.select("tok", F.col("_key").alias("x"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("_root").alias("r"), F.col("p").alias("i"), F.explode(F.sequence("p", "last")).alias("j"))
    right = dealt.select("tok", F.col("_key").alias("y"), "n", "pos", "_root", F.explode(F.sequence(F.lit(0).cast("long"), "p")).alias("i"), F.col("p").alias("j"))
    once = (F.col("r") != F.col("_root")) & ((F.col("i") < F.col("j")) | (F.col("x") < F.col("y")))
    met = left.join(right.hint("merge"), ["tok", "i", "j"]).filter(once & _alike("n", "m", similarity) & _in_step("m", "at", "n", "pos", similarity))
    # a pair may meet in either order, by its blocks. Comparing structs makes the join's code so large that compiling it takes over 200 MB beside the heap
    turned = F.col("x") > F.col("y")
    ends = [F.when(turned, F.col(b)).otherwise(F.col(a)).alias(c) for a, b, c in (("x", "y", "x"), ("m", "n", "m"), ("at", "pos", "at"), ("y", "x", "y"), ("n", "m", "n"), ("pos", "at", "pos"))]
    met = met.select(*ends)
    shared = met.groupBy("x", "y", "m", "n").agg(F.count(F.lit(1)).alias("c"), F.max("at").alias("at"), F.max("pos").alias("pos"))
    most = F.col("c") + F.least(F.col("m") - F.col("at"), F.col("n") - F.col("pos")) - 1
    return shared.filter(most >= _needed("m", "n", similarity)).select("x", "y")


def _new_pairs(pairs: DataFrame, tried: DataFrame) -> DataFrame:
    ordered = pairs.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).dropDuplicates()
    return ordered.join(tried, ["x", "y"], "left_anti")


def _sketch(hashes: np.ndarray) -> bytes:
    """A bitmap of 4 to 8 bits per hash, a power of two of them, that has the bit of each hash."""
    bits = np.zeros(1 << max(6, (4 * len(hashes) - 1).bit_length()), bool)
    bits[hashes & np.uint64(len(bits) - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _most_shared(m: int, p: bytes, n: int, q: bytes) -> int:
    """The most that sets of ``m`` and ``n`` hashes with these sketches share: a bit that one lacks is a hash that it lacks."""
    a, b = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
    while len(a) > len(b):
        a = a[: len(a) // 2] | a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] | b[len(b) // 2 :]
    return min(m - int(np.bitwise_count(a & ~b).sum()), n - int(np.bitwise_count(b & ~a).sum()))


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float, text: str) -> DataFrame:
    """Pairs whose texts' sets of shingles are similar enough. Only texts that stand in a pair are read.

    Sketches, a tenth of the sets' bytes, rule out most others before whole sets travel.
    """
    used = staged(pairs.select(F.col("x").alias("_key")).unionByName(pairs.select(F.col("y").alias("_key"))).dropDuplicates(), "used")
    # the written table's size lets Spark send it to all tasks only if it is small, else both sides are shuffled once
    raw = texts.join(used, "_key", "left_semi").select("_key", utf8(text).alias("_text")).dropDuplicates(["_key"])

    def hash_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.unique(shingle_hashes(t, width)) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array(map(len, sets), pa.int64()), pa.array(map(_sketch, sets), pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_key", "n", "b", "s"])

    sets = staged(raw.mapInArrow(hash_sets, "_key long, n long, b binary, s binary"), "shingles")
    left, right = (sets.select(F.col("_key").alias(e), F.col("n").alias(f"n{e}"), F.col("b").alias(f"b{e}")) for e in "xy")

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(*[batch.column(k).to_pylist() for k in range(2, 6)], strict=True)
            keep = [_most_shared(m, p, n, q) >= similarity / (1 + similarity) * (m + n) - 1e-6 for m, p, n, q in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    sketched = pairs.join(left, "x").join(right, "y").select("x", "y", "nx", "bx", "ny", "by")
    likely = staged(sketched.mapInArrow(possible, "x long, y long"), "likely")
    joined = likely.join(sets.select(F.col("_key").alias("x"), F.col("s").alias("p")), "x").join(sets.select(F.col("_key").alias("y"), F.col("s").alias("q")), "y")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                low, high = sorted((len(a), len(b)))
                both = len(np.intersect1d(a, b, assume_unique=True)) if low >= similarity * high else 0
                keep.append((len(a) + len(b) == 0) or both >= similarity * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["x", "y"]).filter(pa.array(keep, pa.bool_()))

    out = staged(joined.select("x", "y", "p", "q").mapInArrow(compare, "x long, y long"), "links")
    unstaged(sets, used, likely)
    return out


def drop_near_duplicates(docs: DataFrame, width: int = 5, similarity: float = 0.8, text: str = "text") -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest id, nulls first, then of the smallest text hash.

    Rows of equal texts are near-duplicates, repeated rows included; so are all null and empty texts. An empty table gives an
    empty result. Columns go through whatever their names.
    """
    plain, name = by_position(docs)
    body, own = name[text], id_key(name["doc_id"])
    keys = text_keys(plain, body)
    groups = settled(lambda: similar_groups(plain, width, similarity, text=body, keys=keys), "groups")
    keyed = plain.withColumn("_key", keys.of(body)).withColumn("_id", own)
    thin = keyed.select("_key", "_id").join(groups, "_key", "left").withColumn("_root", F.coalesce("_root", "_key"))
    best = staged(thin.groupBy("_root").agg(F.min(F.struct("_id", "_key")).alias("s")).select("s.*"), "kept")
    kept = keyed.join(best, ["_id", "_key"], "left_semi")
    return kept.dropDuplicates(["_id", "_key"]).select(*plain.columns).toDF(*docs.columns)


def op7_simhash(spark, sf_dir: str) -> DataFrame:
    out = group_by_simhash(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "n_links")
