"""Filter interaction audit: what each of five filters removes, at each place of each order of them.

Four filters look at a text by itself; the fifth fails texts that an earlier id has too. Equal texts are found by
refining a partition: documents are split by their number of code points, then by the hashes of successive blocks,
each four times as long as the last, and whatever is alone in its class is dropped after every split. Only the whole
texts of what is left are compared. All of this but the comparison moves thin rows: ids, counts and hashes.

A document's failures are a mask of five bits. Documents are counted by part and mask, at most 32 rows a part, and
the figures of all 120 orders are sums over these counts.
"""

from __future__ import annotations

import itertools
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import NO_ID, staged, table, unstaged
from eventloom.llm.quality import _let as let
from eventloom.llm.quality import words

FILTERS = "ABCDE"
#: Bytes of the first block, and how much longer each next one is.
BLOCK, GROWTH = 256, 4
#: Ids of texts to be compared that go to every task at most (16 MB); more are found by a shuffle.
BROADCAST_IDS = 1_000_000


def failures(text: Column) -> Column:
    """A mask of the filters that look at a text, never null, alone: bit k is set where it fails filter k."""
    counts = let(words(text), lambda w: F.struct(F.size(w).alias("words"), F.size(F.array_distinct(w)).alias("kinds")))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))
    symbols = reduce(lambda a, b: a | b, [F.contains(text, F.lit(x)) for x in "#$%&*|"])

    def masked(n: Column) -> Column:
        fails = [n["words"] < 50, 100 * n["kinds"] < 65 * n["words"], 100 * capitals > 5 * F.char_length(text), symbols]
        return reduce(lambda a, b: a + b, [F.when(x, 1 << k).otherwise(0) for k, x in enumerate(fails)])

    return let(counts, masked)


def _sortable(docs: DataFrame, id: str) -> Column:
    """An id that is never null and sorts like the given one, a missing one before all others."""
    of = F.col(f"`{id}`")
    if docs.schema[id].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(of.cast("long"), F.lit(NO_ID))
    return F.struct(of.isNotNull().alias("known"), of.alias("id"))


def _block_hashes(text: Column) -> Column:
    """Hashes of the blocks, as many as the text's UTF-8 bytes ask for."""
    data, size = text.cast("binary"), F.octet_length(text)
    # blocks before block k hold BLOCK * (GROWTH ** k - 1) / (GROWTH - 1) bytes
    begins = [(BLOCK * (GROWTH**k - 1) // (GROWTH - 1), BLOCK * GROWTH**k) for k in range(16)]
    blocks = [F.when(size > at, F.xxhash64(F.substring(data, at + 1, min(n, 2**31 - 1)))) for at, n in begins if at < 2**31 - 1]
    return F.array_compact(F.array(*blocks))


def _class(length: Column, blocks: Column) -> Column:
    """A text's last class: its length and all its blocks, one after the other."""
    return F.aggregate(blocks, F.xxhash64(length), lambda c, h: F.xxhash64(c, h))


def _without_singletons(rows: DataFrame) -> DataFrame:
    """Rows whose class has another row. A singleton is found by its own id, so no class meets in one task."""
    alone = rows.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).filter("n = 1")
    return rows.join(alone.select("class", "id"), ["class", "id"], "left_anti")


def refine(rows: DataFrame) -> DataFrame:
    """The rows of ``rows(id, length, blocks, ...)`` that agree with another in length and all block hashes, with their ``class``."""
    left = staged(_without_singletons(rows.withColumn("class", F.xxhash64("length"))), "refined")
    k = 0
    while True:
        most = left.agg(F.max(F.size("blocks"))).first()[0] or 0
        if k >= most:
            return left
        split = left.withColumn("class", F.when(F.size("blocks") > k, F.xxhash64("class", F.get("blocks", F.lit(k)))).otherwise(F.col("class")))
        before, left = left, staged(_without_singletons(split), "refined")
        unstaged(before)
        k += 1


def later_copies(left: DataFrame, docs: DataFrame, id: str, text: str, broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """The rows of ``left`` whose whole text a smaller id has; ``docs`` gives the texts.

    Texts are compared as the keys of an aggregation, which combines the copies of a task before anything is
    shuffled: a group of any size sends one text per task. It gives the smallest id of each text; all other ids of
    what is left are later copies.
    """
    ids = left.select("id").distinct()
    if docs.schema[id].dataType.simpleString() == "bigint" and ids.count() <= broadcast_ids:
        ids = F.broadcast(ids)
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("body")
    whole = docs.select(_sortable(docs, id).alias("id"), body).join(ids, "id", "left_semi")
    first = whole.groupBy("body").agg(F.min("id").alias("id"))
    first = first.select(_class(F.char_length("body"), _block_hashes(F.col("body"))).alias("class"), "id")
    return left.join(first, ["class", "id"], "left_anti")


def mask_counts(docs: DataFrame, labels: DataFrame, text: str = "text", id: str = "doc_id", part: str = "source", broadcast_ids: int = BROADCAST_IDS) -> DataFrame:
    """``part, mask, n, good, toxic``: documents of a part by which filters they fail, bit k for filter k.

    ``labels`` has ``doc_id``, ``quality`` and ``toxic``; a document is good or toxic if any label of its id says so.
    A null text counts as empty, a null part as the empty string. A null id has no label and counts as smaller than all others; so
    does the smallest long, where ids are numbers. Rows with equal id and text are one to the last filter: neither is a
    copy of the other. Other columns are ignored. Empty tables give an empty result. The result is a written table.
    """
    own = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    marks = (
        labels.filter("doc_id is not null").groupBy("doc_id")
        .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("is_good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("is_toxic"))
        .withColumnRenamed("doc_id", "labelled")
    )
    rows = docs.select(
        F.col(f"`{id}`").alias("given"), _sortable(docs, id).alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        failures(own).alias("mask"),
        F.char_length(own).alias("length"), _block_hashes(own).alias("blocks"),
    )
    rows = rows.join(marks, F.col("given") == F.col("labelled"), "left").select(
        "id", "part", "mask", "length", "blocks", F.coalesce("is_good", F.lit(False)).cast("long").alias("good"), F.coalesce("is_toxic", F.lit(False)).cast("long").alias("toxic"))
    rows = staged(rows, "audit-rows")
    left = refine(rows)
    copies = later_copies(left, docs, id, text, broadcast_ids).select("part", "mask", "good", "toxic")
    # a copy is taken from the count of its mask without the last filter and added to the one with it
    both = F.array(*[F.struct(F.lit(sign).alias("sign"), F.lit(bit).alias("bit")) for sign, bit in ((-1, 0), (1, 1 << FILTERS.index("E")))])
    moved = copies.select("part", "mask", "good", "toxic", F.inline(both)).select("part", (F.col("mask") + F.col("bit")).alias("mask"), "good", "toxic", "sign")
    every = rows.select("part", "mask", "good", "toxic", F.lit(1).alias("sign")).unionByName(moved)
    counts = every.groupBy("part", "mask").agg(F.sum("sign").alias("n"), F.sum(F.col("sign") * F.col("good")).alias("good"), F.sum(F.col("sign") * F.col("toxic")).alias("toxic"))
    out = staged(counts.filter("n > 0"), "audit-counts")
    unstaged(rows, left)
    return out


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """The figures of all orders, from ``mask_counts``: a row per part, order and step.

    A part's counts are one map of at most 32 entries; the orders are a fixed list that each part is expanded by.
    """
    by_mask = F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic"))))
    parts = counts.groupBy("part").agg(F.map_entries(by_mask).alias("masks"))
    orders = ["".join(order) for order in itertools.permutations(filters)]

    def bits(names: Column) -> Column:
        return reduce(lambda a, b: a + b, [F.when(F.contains(names, F.lit(x)), 1 << k).otherwise(0) for k, x in enumerate(filters)])

    one = parts.select("part", "masks", F.explode(F.split(F.lit(" ".join(orders)), " ")).alias("filter_order"))
    one = one.select("part", "masks", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    own, earlier = F.substring("filter_order", F.col("step"), F.lit(1)), F.substring("filter_order", F.lit(1), F.col("step") - 1)
    one = one.select("*", bits(own).alias("bit"), bits(earlier).alias("before"))
    before, bit = F.col("before"), F.col("bit")

    def total(what: str, when) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"), lambda a, e: a + F.when(when(e["key"]), e["value"][what]).otherwise(0))

    def fails(mask: Column) -> Column:
        return mask.bitwiseAND(bit) != 0

    def reached(mask: Column) -> Column:
        return mask.bitwiseAND(before) == 0

    return one.select(
        "part", "filter_order", "step",
        total("n", lambda m: reached(m) & ~fails(m)).alias("kept"),
        total("n", lambda m: reached(m) & fails(m)).alias("removed"),
        total("n", lambda m: ~reached(m) & fails(m)).alias("redundant"),
        total("n", lambda m: m == bit).alias("unique_fails"),
        total("good", lambda m: reached(m) & fails(m)).alias("good_lost"),
        total("toxic", lambda m: reached(m) & fails(m)).alias("toxic_lost"),
        # of the filters that a document fails, each is the first in an equal share of the orders
        F.aggregate("masks", F.lit(0).cast("long"), lambda a, e: a + F.when(fails(e["key"]), F.floor(e["value"]["n"] * len(orders) / F.bit_count(e["key"]))).otherwise(0)).alias("shapley"),
    )


def op12_filter_audit(spark, sf_dir: str) -> DataFrame:
    """All of ``documents`` by source; see ``mask_counts`` and ``audit``."""
    return audit(mask_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


ORACLE = """
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
f as (
  select d.part, len(w) < 50 as a, 100 * len(list_distinct(w)) < 65 * len(w) as b,
    100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 5 * length(text) as c,
    regexp_matches(text, '[#$%&*|]') as d,
    coalesce(min(doc_id) over (partition by text) < doc_id, false) as e,
    coalesce(l.good, false) as good, coalesce(l.toxic, false) as toxic
  from d left join (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id) l using (doc_id)),
m as (
  select part, list_filter([case when a then 'A' end, case when b then 'B' end, case when c then 'C' end, case when d then 'D' end, case when e then 'E' end], lambda x: x is not null) as fails,
    count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from f group by all),
l as (select unnest(['A', 'B', 'C', 'D', 'E']) as x),
o as (
  select v.x || w.x || x.x || y.x || z.x as filter_order from l v, l w, l x, l y, l z
  where len(list_distinct([v.x, w.x, x.x, y.x, z.x])) = 5),
s as (select filter_order, step::int as step, filter_order[step] as own, string_split(filter_order[1:step - 1], '') as before from o, range(1, 6) r(step)),
g as (
  select part, filter_order, step, own, n, good, toxic, fails, list_contains(fails, own) as hit, step > 1 and list_has_any(fails, before) as gone
  from m, s)
select part, filter_order, step,
  (coalesce(sum(n) filter (not gone and not hit), 0))::bigint as kept,
  (coalesce(sum(n) filter (not gone and hit), 0))::bigint as removed,
  (coalesce(sum(n) filter (gone and hit), 0))::bigint as redundant,
  (coalesce(sum(n) filter (hit and len(fails) = 1), 0))::bigint as unique_fails,
  (coalesce(sum(good) filter (not gone and hit), 0))::bigint as good_lost,
  (coalesce(sum(toxic) filter (not gone and hit), 0))::bigint as toxic_lost,
  (coalesce(sum(sum(n) filter (not gone and hit)) over (partition by part, own), 0))::bigint as shapley
from g group by part, filter_order, step, own
"""
