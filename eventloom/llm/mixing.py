"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents, in an order fixed by hashes, form one stream of words that is cut into blocks
of equal size. Slots stand for blocks of the mix: slot i has the point frac(i * golden ratio), and the
source whose stretch of the cumulative weights holds the point fills it. The k-th slot of a source takes
its block k modulo its number of blocks, so that a source goes round again and no block is
taken twice before all others were taken once. A source gets slots until the words drawn reach its
target, and each slot is filled with the pieces of text of its block.

Places in a stream and ranks of slots are sums over what comes before. They are taken in three steps, within
small buckets, over the totals of ``GROUP`` neighbouring buckets and over those groups' totals, so that a source
with a third of all words, or of all slots, is not one task.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import NO_ID, small_batches, staged, table

NONSPACE = r"[^\x20\x09-\x0D]+"
#: Buckets whose totals are added up in one task.
GROUP = 4096
#: Bits of a slot's number that are taken at a time, and the golden ratio's multiples by what each such part stands for, less
#: their whole parts: products stay small enough for doubles to keep their fractions to a thousand-millionth, at every slot below 2 ** 60.
PART_BITS = 20
_ONE = 1 << 192
_GOLDEN = (math.isqrt(5 * _ONE * _ONE) - _ONE) // 2
GOLDEN = tuple((_GOLDEN << PART_BITS * k) % _ONE / _ONE for k in range(3))


@dataclass(frozen=True)
class Plan:
    """``weights`` go to sources in code point order, repeating; no source is taken more than ``most`` times."""

    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    most: int = 3
    block_words: int = 64
    bucket_rows: int = 4096


def running(rows: DataFrame, keys: list[str], bucket: str, order: list[Column], value: Column, name: str) -> DataFrame:
    """Adds the sum of ``value`` over the rows of the same keys that come before, by bucket and then ``order``."""
    inner = Window.partitionBy(*keys, bucket).orderBy(*order)
    rows = rows.withColumn("_v", value)
    totals = rows.groupBy(*keys, bucket).agg(F.sum("_v").alias("_s"))
    totals = totals.withColumn("_group", F.floor(F.col(bucket) / GROUP))
    before = lambda w, c: F.coalesce(F.sum(c).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = totals.groupBy(*keys, "_group").agg(F.sum("_s").alias("_t"))
    groups = groups.withColumn("_far", before(Window.partitionBy(*keys).orderBy("_group"), "_t")).drop("_t")
    totals = totals.withColumn("_near", before(Window.partitionBy(*keys, "_group").orderBy(bucket), "_s")).join(groups, [*keys, "_group"])
    totals = totals.select(*keys, bucket, (F.col("_far") + F.col("_near")).alias("_base"))
    return rows.withColumn("_in", before(inner, "_v")).join(totals, [*keys, bucket]).withColumn(name, F.col("_base") + F.col("_in")).drop("_v", "_in", "_base")


def targets(sized: DataFrame, plan: Plan) -> DataFrame:
    """``_source, source_size, target`` for each source of ``sized(_source, size)``.

    The whole is shared by weight; a source whose share exceeds ``most`` times its size gets that,
    and the rest is shared anew among the others until none exceeds. A row per source is all that is
    ordered here.
    """
    sizes = sized.groupBy("_source").agg(F.sum("size").cast("long").alias("source_size"))
    place = Window.orderBy(F.col("_source").asc_nulls_last())
    weights = F.array(*[F.lit(float(w)) for w in plan.weights])
    out = sizes.withColumn("_w", F.get(weights, (F.row_number().over(place) - 1) % len(plan.weights)))
    out = staged(out.withColumn("_cap", plan.most * F.col("source_size").cast("double")), "sources")
    whole = float(out.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0  # words per unit of weight among the sources below their caps
    while True:
        full = F.col("_w") * level >= F.col("_cap") if level else F.lit(False)
        row = out.agg(F.sum(F.when(full, F.col("_cap"))).alias("capped"), F.sum(F.when(~full, F.col("_w"))).alias("w")).first()
        rest, w = whole - (row["capped"] or 0.0), row["w"] or 0.0
        if w <= 0 or rest <= 0:
            break
        raised = rest / w
        if raised <= level * (1 + 1e-12):
            break
        level = raised
    return out.select("_source", "source_size", "_w", F.least(F.col("_w") * level, "_cap").alias("target"))


def golden_point(slot: Column) -> Column:
    """The slot's multiple of the golden ratio, less its whole part."""
    part = lambda k: F.shiftright(slot, PART_BITS * k).bitwiseAND((1 << PART_BITS) - 1) * F.lit(GOLDEN[k])
    fraction = lambda c: c - F.floor(c)
    return fraction(sum((fraction(part(k)) for k in range(1, len(GOLDEN))), fraction(part(0))))


def schedule(sources: DataFrame, slots: int, plan: Plan) -> DataFrame:
    """``slot, _source, rank``: the source that fills each slot and how many slots it filled before."""
    spark = sources.sparkSession
    order = Window.orderBy(F.col("_source").asc_nulls_last())
    whole = F.sum("target").over(Window.partitionBy())
    stretches = sources.withColumn("_to", F.sum("target").over(order.rowsBetween(Window.unboundedPreceding, 0)) / whole)
    stretches = stretches.withColumn("_from", F.coalesce(F.lag("_to").over(order), F.lit(0.0))).withColumn("_last", F.lead("_to").over(order).isNull())
    # a stretch is met by its cells of the unit interval: an equal join instead of a comparison with every source
    cells = 4096
    cell = F.explode(F.sequence(F.floor(F.col("_from") * cells).cast("int"), F.least(F.floor(F.col("_to") * cells), F.lit(cells - 1)).cast("int")))
    stretches = stretches.filter("target > 0").select("_source", "_from", F.when(F.col("_last"), 2.0).otherwise(F.col("_to")).alias("_to"), cell.alias("_cell"))
    points = spark.range(slots).withColumnRenamed("id", "slot")
    points = points.withColumn("_u", golden_point(F.col("slot"))).withColumn("_cell", F.floor(F.col("_u") * cells).cast("int"))
    placed = points.join(stretches, "_cell").filter("_u >= _from and _u < _to").select("slot", "_source")
    placed = placed.withColumn("_bucket", F.floor(F.col("slot") / plan.bucket_rows)).withColumn("_known", F.col("_source").isNotNull()).withColumn("_source", F.coalesce("_source", F.lit("")))
    ranked = running(placed, ["_known", "_source"], "_bucket", [F.col("slot")], F.lit(1), "rank")
    return ranked.select("slot", F.when(F.col("_known"), F.col("_source")).alias("_source"), "rank")


def _needs(sources: DataFrame, plan: Plan) -> DataFrame:
    """Adds ``_n``, the source's blocks, and ``_need``, the slots after which its words drawn reach the target.

    The last block of a round holds what is left over, so rounds are counted by words and not by blocks.
    """
    w, size = plan.block_words, F.col("source_size")
    rounds = F.when(size > 0, F.floor(F.col("target") / size)).otherwise(F.lit(0))
    sources = sources.withColumn("_n", F.ceil(size / w)).withColumn("_rounds", rounds)
    rest = F.col("target") - F.col("_rounds") * size
    return sources.withColumn("_need", (F.col("_rounds") * F.col("_n") + F.least("_n", F.ceil(rest / w - 1e-6))).cast("long")).drop("_rounds")


def filled(sources: DataFrame, plan: Plan) -> DataFrame:
    """``slot, _known, _source, _block``: every source gets just the slots that it needs.

    The points deal a source a few slots more or less; what is over goes to the sources that are short.
    Those are a logarithm of the slots per source, and all that is numbered in one task here.
    """
    needs = staged(_needs(sources, plan), "needs")
    slots = needs.agg(F.sum("_need")).first()[0] or 0
    ranks = schedule(needs.select("_source", F.col("_need").alias("target")), slots, plan)
    ranks = staged(ranks.alias("s").join(needs.alias("b"), F.col("s._source").eqNullSafe(F.col("b._source"))).select("slot", F.col("s._source").alias("_source"), "rank", "_n", "_need"), "ranks")
    over = ranks.filter("rank >= _need").select("slot", F.row_number().over(Window.orderBy("slot")).alias("_k"))
    dealt = ranks.groupBy("_source").agg(F.count(F.lit(1)).alias("_got"))
    short = needs.alias("b").join(dealt.alias("d"), F.col("b._source").eqNullSafe(F.col("d._source")), "left")
    short = short.select(F.col("b._source").alias("_source"), "_n", "_need", F.coalesce("_got", F.lit(0)).alias("_got")).filter("_got < _need")
    short = short.select("_source", "_n", F.explode(F.sequence(F.col("_got"), F.col("_need") - 1)).alias("rank"))
    short = short.withColumn("_k", F.row_number().over(Window.orderBy(F.col("_source").asc_nulls_last(), "rank")))
    all_ = ranks.filter("rank < _need").select("slot", "_source", "_n", "rank").unionByName(over.join(short, "_k").select("slot", "_source", "_n", "rank"))
    return all_.select("slot", F.col("_source").isNotNull().alias("_known"), F.coalesce("_source", F.lit("")).alias("_source"), (F.col("rank") % F.col("_n")).alias("_block"))


def cut(streams: DataFrame, plan: Plan) -> DataFrame:
    """``_known, _source, _start, doc_id, _block, first_word, past_word, piece``: each text by the blocks it reaches into.

    A piece ends where its successor's first word begins, so a text's pieces together are the text.
    """
    small_batches(streams.sparkSession)
    w, kind = plan.block_words, dict(streams.dtypes)["doc_id"]
    source = streams.filter("size > 0").select("_known", "_source", "_start", "doc_id", "_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(NONSPACE).finditer
        for batch in batches:
            rows, block, first, past, piece = [], [], [], [], []
            for k, (start, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                begins = [m.start() for m in find(text)]
                n, begins[0] = len(begins), 0
                begins.append(len(text))
                for b in range(start // w, (start + n - 1) // w + 1):
                    i, j = max(start, b * w) - start, min(start + n, (b + 1) * w) - start
                    rows.append(k)
                    block.append(b)
                    first.append(i)
                    past.append(j)
                    piece.append(text[begins[i] : begins[j]])
            kept = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(4)]
            made = [pa.array(x, pa.int64()) for x in (block, first, past)]
            yield pa.RecordBatch.from_arrays([*kept, *made, pa.array(piece, pa.string())], names=["_known", "_source", "_start", "doc_id", "_block", "first_word", "past_word", "piece"])

    return source.mapInArrow(run, f"_known boolean, _source string, _start long, doc_id {kind}, _block long, first_word long, past_word long, piece string")


def _made(docs: DataFrame, plan: Plan, text: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The written mix, the documents in their streams, and the sources with their targets."""
    body = F.coalesce(F.col(text), F.lit(""))
    sized = docs.select("doc_id", F.col("source").alias("_source"), F.regexp_count(body, F.lit(NONSPACE)).cast("long").alias("size"), F.xxhash64(F.coalesce("doc_id", F.lit(NO_ID)), F.lit(17)).alias("_o"), body.alias("_text"))
    thin = staged(sized.select("_source", "size"), "sizes")
    sources = staged(targets(thin, plan), "targets")
    width = max(1, math.ceil(2**32 / max(1, thin.count() // plan.bucket_rows)))
    keyed = sized.withColumns({"_known": F.col("_source").isNotNull(), "_source": F.coalesce("_source", F.lit(""))})
    keyed = keyed.withColumn("_bucket", F.floor(F.shiftrightunsigned("_o", 32) / width))
    streams = running(keyed, ["_known", "_source"], "_bucket", [F.col("_o"), F.col("doc_id"), F.col("size"), F.xxhash64("_text")], F.col("size"), "_start")
    streams = staged(streams.drop("_bucket", "_o"), "streams")
    made = cut(streams, plan).join(filled(sources, plan), ["_known", "_source", "_block"])
    return staged(made, "mix"), streams, sources


def make_mix(docs: DataFrame, plan: Plan = Plan(), text: str = "text") -> DataFrame:
    """The mix: ``slot, source, block, place, doc_id, first_word, past_word, piece``, a row per slot and document in it.

    ``piece`` is the document's text from its word ``first_word`` up to ``past_word``; ``place`` is the first
    one's place in the block. Pieces by slot and place are the mix from its first word to its last.
    """
    made, _, _ = _made(docs, plan, text)
    place = F.col("_start") + F.col("first_word") - F.col("_block") * plan.block_words
    return made.select("slot", F.when(F.col("_known"), F.col("_source")).alias("source"), F.col("_block").alias("block"), place.alias("place"), "doc_id", "first_word", "past_word", "piece")


def mix(docs: DataFrame, plan: Plan = Plan(), text: str = "text") -> DataFrame:
    """``doc_id, source, size, source_size, target, taken`` for every document, counted from the written mix.

    ``size`` is the number of words, 0 for a null or empty text; ``taken`` is the number of words that the
    mix takes of the document, repeats counted. A null source is a source, the last of all; a
    null id is an id like others. Repeated rows are documents of their own. A source without words has the target
    0 and an empty table gives an empty result. Other columns are not used. The order of a
    stream follows hashes of the documents alone, so reruns agree.
    """
    made, streams, sources = _made(docs, plan, text)
    got = made.groupBy("_known", "_source", "_start").agg(F.sum(F.col("past_word") - F.col("first_word")).alias("taken"))
    named = sources.select(F.col("_source").isNotNull().alias("_known"), F.coalesce("_source", F.lit("")).alias("_source"), "source_size", "target")
    out = streams.drop("_text").join(named, ["_known", "_source"]).join(got, ["_known", "_source", "_start"], "left")
    taken = F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(F.lit(0)).cast("long")
    return out.select("doc_id", F.when(F.col("_known"), F.col("_source")).alias("source"), "size", "source_size", "target", taken.alias("taken"))


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source")
