"""From raw documents to a training mix: five stages, each written as Parquet and read again by the next.

Quality rules drop documents; line deduplication deletes later copies of repeated passages; SimHash keeps one
document of each group of near-duplicates; decontamination cuts out passages of benchmark items; mixing
writes the mix, block by block with its texts, and says how many words it takes of each document that is left.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm import decontaminate, lines, mixing, quality, simhash
from eventloom.llm.common import settled, table, unstaged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _with_length(docs: DataFrame) -> DataFrame:
    """A changed text has its own number of characters."""
    return docs.withColumn("n_chars", F.char_length("text").cast("long"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(lines.drop_repeated_runs(docs).select(*docs.columns))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _with_length(decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash", simhash_near_dedup),
    ("decontaminate", benchmark_decontamination),
    ("mixing", mixing_to_weights),
]

#: SQL has no XXH64, so fingerprints and all that follows them can't be expressed; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. Every stage but the last returns the columns of documents.

    When a stage's table stands, all that it was made of is removed, and so is the table of the stage before. Null and
    empty texts have no words, so the first stage drops them; a null source is a source of its own in the mix; of
    equal texts the second stage cuts the later ones or the third drops them, repeated rows included. Of rows of equal
    similarity the smallest id stays, a null id being smaller than any. Other columns go through, whatever their names, up to the
    mix. An empty table gives an empty result.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, settled(partial(stage, spark, docs, sf_dir), f"stage-{name}")
        unstaged(before)
    return docs
