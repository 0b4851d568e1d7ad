"""Readers and writers of event lists, captured pages and exports, by Spark's own formats."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.functions.taxonomy import Taxonomy
from eventloom.functions.urls import let, strip, text_of
from eventloom.operators import coverage
from eventloom.operators.coverage import SCALARS
from eventloom.operators.staging import shared_path, staged, unstaged

JSON_COLUMNS = (*coverage.LISTS, "resolution_notes", "enrich_notes", "field_provenance", "validation")
#: What a stored model answer may fill.
ANSWER_LISTS = ("attending_companies", "exhibitor_companies", "sponsor_companies", "speakers")
ANSWER_PARTS = ("name", "website", "title", "company", "details", "evidence_snippet")
_CSV = {"header": True, "quote": '"', "escape": '"'}


def export_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one."""
    return shared_path(spark, f"exports/{name}")


def read_event_list(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Event items: one object each, or objects with an array ``events``; anything else is an error."""
    found = spark.read.json(path, multiLine=multi_line)
    if "events" in found.columns:
        return found.select(F.explode("events").alias("e")).select("e.*")
    if not found.columns or "_corrupt_record" in found.columns:
        raise ValueError(f"no event list in {path}")
    return found


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    """``url, html`` of saved pages; bytes that aren't UTF-8 are replaced."""
    return spark.read.format("binaryFile").load(path).select(F.col("path").alias("url"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def read_page_bundle(spark: SparkSession, path: str) -> DataFrame:
    """``event_id, role, html`` of files ``<event>/<role>.html`` below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.html").load(path)
    part = lambda k: F.regexp_extract("path", r"([^/]+)/([^/]+)\.html$", k)
    return files.select(part(1).alias("event_id"), part(2).alias("role"), F.make_valid_utf8(F.col("content").cast("string")).alias("html"))


def save_page_files(pages: DataFrame, folder: str) -> int:
    """Writes ``pages(event_id, role, html)`` as ``<event>/<role>.html`` below a shared folder and counts them.

    A file is written by the task that holds its page; one that is run again writes the same file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fs, at = pafs.FileSystem.from_uri(folder)
            for event, role, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs.create_dir(f"{at}/{event}", recursive=True)
                with fs.open_output_stream(f"{at}/{event}/{role}.html") as out:
                    out.write((html or "").encode())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    return pages.select(F.col("event_id").cast("string"), "role", "html").mapInArrow(run, "n long").agg(F.sum("n")).first()[0] or 0


def write_page_table(pages: DataFrame, name: str, buckets: int = 256) -> None:
    """``pages`` as a table bucketed and sorted by event, so that joining events by id moves no page (``enrich.join_pages_to_events``)."""
    pages.write.bucketBy(buckets, "event_id").sortBy("event_id").saveAsTable(name)


def read_taxonomy(spark: SparkSession, path: str) -> Taxonomy:
    """Rules of a JSON file; what it leaves out is empty, but b2b is asked for unless it says otherwise."""
    found = spark.read.json(path, multiLine=True).first().asDict(recursive=True)
    logic = found.get("in_scope_logic") or {}
    words = lambda key: tuple(found.get(key) or ())
    rules = tuple((r["code"], r["label"], tuple(s.lower() for s in r["substrings"])) for r in found.get("industry_rules") or ())
    by_default = logic.get("require_b2b")
    return Taxonomy(found.get("scope_rule_version"), words("b2b_positive_substrings"), words("consumer_festival_penalty"), words("networking_substrings"), rules, True if by_default is None else by_default, bool(logic.get("require_engagement")))


def write_taxonomy(spark: SparkSession, taxonomy: Taxonomy, path: str) -> None:
    """The rules as one JSON object, as ``read_taxonomy`` takes it."""
    rules = [{"code": c, "label": n, "substrings": list(w)} for c, n, w in taxonomy.industries]
    made = {
        "scope_rule_version": taxonomy.version, "in_scope_logic": {"require_b2b": taxonomy.require_b2b, "require_engagement": taxonomy.require_engagement},
        "b2b_positive_substrings": list(taxonomy.b2b), "consumer_festival_penalty": list(taxonomy.penalties), "networking_substrings": list(taxonomy.networking), "industry_rules": rules,
    }
    spark.createDataFrame([(json.dumps(made),)], "value string").write.text(path)


def write_event_list(events: DataFrame, path: str) -> None:
    """A JSON object per line; null fields are left out."""
    events.write.json(path)


def write_page_bundle(pages: DataFrame, path: str) -> None:
    """``pages(event_id, role, page_url, html)`` by role, and a manifest with the roles, URLs and notes of each event.

    A note says how the fetch of a page went: its ``fetch_note``, where ``pages`` has that column and it isn't empty.
    """
    pages.write.partitionBy("role").parquet(f"{path}/pages")
    urls = F.array_sort(F.collect_list(F.struct("role", "page_url")))
    told = F.col("fetch_note") if "fetch_note" in pages.columns else F.lit(None).cast("string")
    note = F.when(told != "", F.struct("role", F.concat("role", F.lit("_fetch: "), told).alias("note")))
    notes = F.transform(F.array_sort(F.collect_list(note)), lambda x: x["note"])
    pages.groupBy("event_id").agg(urls.alias("pages"), notes.alias("notes")).write.parquet(f"{path}/manifest")


def write_dom_elements(elements: DataFrame, path: str) -> None:
    """Elements of pages, a JSON object each with its attributes as JSON text, and each page's number of elements."""
    elements.withColumn("attrs_json", F.to_json("attrs")).drop("attrs").write.json(f"{path}/elements")
    elements.groupBy("page_id").agg(F.count(F.lit(1)).alias("element_count")).write.json(f"{path}/counts")


def enriched_rows(records: DataFrame, *keys: str) -> DataFrame:
    """Flat rows: 22 texts, the confidence, 11 JSON columns (an empty list where null), and the scope's 7 parts."""
    as_json = lambda c, name: F.coalesce(F.to_json(c, {"ignoreNullFields": "false"}), F.lit("[]")).alias(name)
    flags = [F.col(f"scope.{n}").alias(f"scope_{n}") for n in ("in_scope", "b2b", "networking", "has_exhibitors", "has_sponsors", "has_speakers")]
    texts = (*SCALARS[:8], "listing_url", *SCALARS[8:])
    return records.select(*keys, *texts, "resolution_confidence", *[as_json(F.col(n), n) for n in JSON_COLUMNS], as_json(F.col("scope.scope_evidence"), "scope_evidence"), *flags, "scope.scope_rule_version")


def write_coverage(records: DataFrame, path: str, *keys: str) -> None:
    """Coverage as CSV rows, and one JSON object per event with its fields, scope and labels, both with gzip.

    The records' plan runs once, into a staged table of flags. Objects repeat all names and labels, some 2.5 KB an event before gzip.
    """
    flags = staged(coverage.coverage_flags(records, *keys), "coverage")
    write_rows(coverage.summary_of_flags(flags, *keys), f"{path}/rows", "gzip")
    coverage.details_of_flags(flags, *keys).write.json(f"{path}/events", compression="gzip")
    unstaged(flags)


def write_review(records: DataFrame, path: str, *keys: str) -> None:
    """All rows of the review table, flagged or not; nothing is written where there are none.

    The records' plan runs once: its rows are staged, and the table tells whether there are any.
    """
    rows = staged(coverage.review_rows(records, *keys), "review")
    if not rows.isEmpty():
        write_rows(rows, path)
    unstaged(rows)


def write_rows(rows: DataFrame, path: str, compression: str = "none") -> None:
    rows.write.options(**_CSV, compression=compression).csv(path)


def read_rows(spark: SparkSession, path: str, schema) -> DataFrame:
    """Rows of an export; empty texts come back as null."""
    return spark.read.options(**_CSV).schema(schema).csv(path)


def _answer_items(value: Column) -> Column:
    """A model's list: objects with known parts, or plain names; anything else in it is left out. Null where it is no list."""

    def item(x: Column) -> Column:
        kind = F.schema_of_variant(x)
        named = F.struct(*[F.try_variant_get(x, f"$.{p}", "string").alias(p) for p in ANSWER_PARTS])
        plain = F.struct(*[(F.try_variant_get(x, "$", "string") if p == "name" else F.lit(None).cast("string")).alias(p) for p in ANSWER_PARTS])
        return F.when(kind.startswith("OBJECT"), named).when(kind == "STRING", plain)

    return F.filter(F.transform(F.try_variant_get(value, "$", "array<variant>"), item), lambda x: x.isNotNull())


def parse_answer(raw: Column) -> Column:
    """``struct`` of a stored model answer: known keys of its object, without code fences, and why it was ``rejected``.

    Lists hold ``struct<name, website, title, company, details, evidence_snippet>``. ``rejected`` is null for an object, ``no
    answer`` for a null or empty text, ``not JSON`` for what can't be read and ``no object`` for any other JSON; none of these fills anything.
    """
    text = strip(text_of(raw))
    bare = F.regexp_replace(F.regexp_replace(text, r"^```(?:json)?\s*", ""), r"\s*```$", "")

    def read(value: Column) -> Column:
        texts = [F.try_variant_get(value, f"$.{n}", "string").alias(n) for n in SCALARS]
        lists = [_answer_items(F.try_variant_get(value, f"$.{n}", "variant")).alias(n) for n in ANSWER_LISTS]
        reason = F.when(text == "", "no answer").when(value.isNull(), "not JSON").when(~F.schema_of_variant(value).startswith("OBJECT"), "no object")
        return F.struct(*texts, *lists, reason.alias("rejected"))

    return let(F.try_parse_json(F.when(text.startswith("```"), bare).otherwise(text)), read)


def read_answers(answers: DataFrame, key: str = "event_id", raw: str = "raw") -> tuple[DataFrame, DataFrame]:
    """Stored answers ``(key, raw)`` as the table that ``parse_event_pages`` takes, and those rejected with ``raw`` and the ``reason``.

    Of several answers of a key the first that can be read, in order of the raw texts, is taken; empty tables give empty ones.
    """
    read = answers.select(key, raw, parse_answer(F.col(raw)).alias("x"))
    good = read.filter("x.rejected is null").groupBy(key).agg(F.min_by("x", raw).alias("x")).select(key, "x.*").drop("rejected")
    return good, read.filter("x.rejected is not null").select(key, raw, F.col("x.rejected").alias("reason"))


def split_by_confidence(reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that need no review and rows that do; an empty side is replaced by all rows.

    ``reviewed`` is written once to the shared folder; both sides are read from there.
    """
    reviewed = staged(reviewed, "reviewed")
    sure, unsure = reviewed.filter(~F.col("needs_review")), reviewed.filter("needs_review")
    return reviewed if sure.isEmpty() else sure, reviewed if unsure.isEmpty() else unsure
