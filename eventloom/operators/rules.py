"""Industry rules from a table: the first rule one of whose substrings a text holds, for lists far longer than an expression can be."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.taxonomy import INDUSTRIES
from eventloom.functions.urls import text_of
from eventloom.operators.support import supported_pairs

#: Rules whose distinct substrings have at most this many characters in all go to every task; longer lists are joined.
SENT_CHARS = 4_000_000

_automata: dict[str, tuple] = {}


def rule_table(spark: SparkSession, rules=INDUSTRIES) -> DataFrame:
    """``rank, code, label, substring`` of rules as ``functions.taxonomy`` and ``read_taxonomy`` hold them."""
    rows = [(k, code, label, word) for k, (code, label, words) in enumerate(rules) for word in words]
    return spark.createDataFrame(rows, "rank long, code string, label string, substring string")


def _automaton(key: str, rows: list[tuple[int, str]]) -> tuple:
    """The automaton of a list, and the least rank of an empty substring, which every text holds. Built once in each Python worker."""
    if key not in _automata:
        first: dict[str, int] = {}
        for rank, word in rows:
            first[word] = min(rank, first.get(word, rank))
        everywhere = first.pop("", None)
        made = ahocorasick.Automaton()
        for word, rank in first.items():
            made.add_word(word, rank)
        if first:
            made.make_automaton()
        _automata.clear()
        _automata[key] = made, everywhere, bool(first)
    return _automata[key]


def _least_rank(texts: Column, rows: list[tuple[int, str]], spark: SparkSession) -> Column:
    sent, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex

    @F.pandas_udf("long")
    def least(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        made, everywhere, any_word = _automaton(key, sent.value)

        def one(text: str) -> int | None:
            ranks = (rank for _, rank in made.iter(text)) if any_word else ()
            return min(ranks, default=everywhere) if everywhere is None else min(everywhere, min(ranks, default=everywhere))

        for texts in batches:
            yield pd.Series([one(t) for t in texts], dtype="Int64")

    return least(texts)


def match_rules(rows: DataFrame, rules: DataFrame, key: str, text: str = "text", sent_chars: int = SENT_CHARS) -> DataFrame:
    """``key, code, label`` for every row: the rule of least ``rank`` that the lower-cased text holds, else nulls.

    ``rules`` has ``rank, code, label, substring``, a row per substring; a null substring asks for nothing, an empty one is in every
    text. Of equal ranks the least code, then label, is taken. Keys are unique and not null. A null text is empty. Where the substrings' characters are at
    most ``sent_chars``, equal substrings counted once, each text is read once against all of them; otherwise texts and substrings are
    joined by what they share.
    """
    spark = rows.sparkSession
    # of rules with one substring only the first is ever taken
    words = rules.filter("substring is not null").groupBy(F.lower("substring").alias("_word")).agg(F.min("rank").alias("_rank"))
    used = rules.select(F.col("rank").alias("_rank"), "code", "label").join(words.select("_rank"), "_rank", "left_semi")
    named = used.groupBy("_rank").agg(F.min(F.struct("code", "label")).alias("_rule"))
    low = lambda c: F.lower(text_of(c))
    size = words.agg(F.sum(F.length("_word") + 1).alias("n"), F.min(F.when(F.col("_word") == "", F.col("_rank"))).alias("everywhere")).first()
    if (size["n"] or 0) <= sent_chars:
        sent = [(r["_rank"], r["_word"]) for r in words.collect()]
        held = rows.select(key, _least_rank(low(F.col(text)), sent, spark).alias("_rank"))
    else:
        needles = words.filter("_word <> ''")
        pairs = supported_pairs(rows, needles, lambda s: F.array(F.array(s)), key, "_rank", text, "_word", low)
        best = pairs.groupBy(key).agg(F.min("_rank").alias("_rank"))
        # least() passes over nulls
        held = rows.select(key).join(best, key, "left").withColumn("_rank", F.least("_rank", F.lit(size["everywhere"]).cast("long")))
    return held.join(named, "_rank", "left").select(key, "_rule.code", "_rule.label")
