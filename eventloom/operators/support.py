"""Which texts support which items, for tables of both: no text meets an item that can't be in it.

A rule asks that a text contains all of some needles, in one of a few ways. Texts are normalised, so a space ends a word: what a
needle says between two spaces lies inside one word of any text that contains it. Needles therefore find their texts by words: the
corpus's distinct words by groups of three characters, and texts by the words of each way's rarest piece. What is found so is all
that can hold, and whole texts decide.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventloom.functions.text import normalize_for_match
from eventloom.functions.urls import let

#: Characters of a group; pieces that are shorter are a group of their own.
GRAM = 3
#: Ways that a text is tested against at a time, about.
AT_ONCE = 500

Rule = Callable[[Column], Column]


def scalar_ways(value: Column) -> Column:
    """``array<array<string>>`` for ``functions.text.scalar_in_text``: the value, of one of over 6 characters the first 30."""
    head = F.when(F.length(value) > 6, F.substring(value, 1, 30)).otherwise(value)
    return F.when(value != "", F.array(F.array(head))).otherwise(F.array().cast("array<array<string>>"))


def snippet_ways(snippet: Column, min_len: int = 8) -> Column:
    """The same for ``functions.text.snippet_in_text``: the first 40 characters, or each of the first 4 words where there are 2."""
    words = F.filter(F.split(snippet, r"(?U)\W+"), lambda w: F.length(w) > 2)
    both = let(words, lambda ws: F.when(F.size(ws) >= 2, F.array(F.array(F.substring(snippet, 1, 40)), F.slice(ws, 1, 4))).otherwise(F.array(F.array(F.substring(snippet, 1, 40)))))
    return F.when(F.length(snippet) >= min_len, both).otherwise(F.array().cast("array<array<string>>"))


def _grams(word: Column, every: bool) -> Column:
    """Groups of ``GRAM`` characters of a word, or the word where it is shorter; with ``every`` shorter groups as well."""
    of = lambda n: F.transform(F.sequence(F.lit(1), F.length(word) - n + 1), lambda i: F.substring(word, i, F.lit(n)))
    none = F.array().cast("array<string>")
    if every:
        return F.array_distinct(F.concat(*[F.when(F.length(word) >= n, of(n)).otherwise(none) for n in range(1, GRAM + 1)]))
    return F.array_distinct(F.when(F.length(word) >= GRAM, of(GRAM)).otherwise(F.array(word)))


def _holders(pieces: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``_piece, _token, _df``: all words that contain each piece. Of a piece's groups the one that fewest words have is looked up."""
    wanted = pieces.select("_piece", F.explode(_grams(F.col("_piece"), every=False)).alias("_gram"))
    held = vocabulary.select("_token", "_df", F.explode(_grams(F.col("_token"), every=True)).alias("_gram")).join(wanted.select("_gram").distinct(), "_gram", "left_semi")
    rarity = held.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    # a group that no word has means that nothing contains the piece
    rarest = wanted.join(rarity, "_gram", "left").groupBy("_piece").agg(F.min_by("_gram", F.struct(F.coalesce("_n", F.lit(0)), "_gram")).alias("_gram"))
    return held.join(rarest, "_gram").filter(F.contains(F.col("_token"), F.col("_piece"))).select("_piece", "_token", "_df")


def supported_pairs(docs: DataFrame, items: DataFrame, rule: Rule, key: str = "doc_id", item: str = "item_id", text: str = "text", item_text: str = "text", prepare: Rule = normalize_for_match) -> DataFrame:
    """``key, item`` of all pairs that ``rule`` accepts, each once; ``rule`` gives the ways of an item. Both sides go through ``prepare`` first.

    Keys of texts are unique. A null text or item is empty and supports or asks for nothing; a null key is in no pair. An item's
    id that comes with several texts is supported where one of them is. Texts travel once per ``AT_ONCE`` ways, and only those that
    hold some way's rarest piece. Needles of spaces alone are never found.
    """
    bodies = docs.select(F.col(key).alias("_key"), prepare(F.col(text)).alias("_body"))
    tokens = bodies.select("_key", F.explode(F.array_distinct(F.split("_body", " "))).alias("_token")).filter("_token <> ''")
    vocabulary = tokens.groupBy("_token").agg(F.count(F.lit(1)).alias("_df"))

    ways = items.select(F.col(item).alias("_item"), F.explode(rule(prepare(F.col(item_text)))).alias("_needles"))
    ways = ways.select("_item", "_needles", F.xxhash64("_item", "_needles").alias("_way"))
    pieces_of = F.array_distinct(F.filter(F.flatten(F.transform("_needles", lambda n: F.split(n, " "))), lambda p: p != ""))
    parts = ways.select("_needles", F.explode(pieces_of).alias("_piece")).distinct()

    holders = _holders(parts.select("_piece").distinct(), vocabulary)
    spread = holders.groupBy("_piece").agg(F.sum("_df").alias("_n"))
    anchors = parts.join(spread, "_piece", "left").groupBy("_needles").agg(F.min_by("_piece", F.struct(F.coalesce("_n", F.lit(0)), "_piece")).alias("_piece"))

    groups = max(1, -(-ways.count() // AT_ONCE))
    asked = ways.join(anchors, "_needles").join(holders.select("_piece", "_token"), "_piece").select("_token", "_way", "_item", "_needles")
    tried = tokens.join(asked, "_token").select("_key", "_way", "_item", "_needles")
    # several words of a text may hold one piece: a set keeps the way once
    tried = tried.groupBy("_key", F.pmod("_way", F.lit(groups)).alias("_group")).agg(F.collect_set(F.struct("_item", "_needles")).alias("_ways"))
    met = bodies.join(tried, "_key").select("_key", F.filter("_ways", lambda w: F.forall(w["_needles"], lambda n: F.contains(F.col("_body"), n))).alias("_ways"))
    return met.select(F.col("_key").alias(key), F.explode("_ways").alias("_w")).select(key, F.col("_w._item").alias(item)).distinct()
