"""Steps whose figures grew faster than their input, or past their limit."""

from pathlib import Path

from pyspark.sql import functions as F

from eventloom.operators import coverage, rules
from eventloom.sources import files


def test_equal_substrings_of_rules_count_once(spark, monkeypatch):
    """A table that repeats its substrings went through a join of all texts and substrings."""

    def refused(*_, **__):
        raise AssertionError("joined")

    monkeypatch.setattr(rules, "supported_pairs", refused)
    table = spark.range(2000).select(F.col("id").alias("rank"), F.concat(F.lit("c"), F.col("id")).alias("code"), F.lit("l").alias("label"), F.when(F.col("id") % 2 == 0, "Expo").otherwise("summit").alias("substring"))
    rows = spark.createDataFrame([(1, "A Summit"), (2, "an expo summit"), (3, "none"), (4, None)], "k long, text string")
    got = {r["k"]: r["code"] for r in rules.match_rules(rows, table, "k", sent_chars=100).collect()}
    assert got == {1: "c1", 2: "c0", 3: None, 4: None}


def test_coverage_is_written_compressed_and_from_one_run(spark, tmp_path):
    """Its objects repeat every name: plain, they took the disk."""
    runs = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def named(k):
        runs.add(1)
        return f"event {k}"

    texts = {f: F.lit(None).cast("string") for f in coverage.SCALARS}
    lists = {f: F.array().cast("array<string>") for f in coverage.LISTS}
    records = spark.range(50).withColumns({**texts, **lists, "scope": F.struct(*[F.lit(True).alias(n) for n in coverage.SCOPE_FLAGS])}).withColumn("event_name", named("id"))
    files.write_coverage(records, str(tmp_path / "out"), "id")
    assert runs.value == 50
    for kind in ("rows", "events"):
        parts = [p.name for p in Path(tmp_path / "out" / kind).glob("part-*")]
        assert parts and all(p.endswith(".gz") for p in parts)
    rows = files.read_rows(spark, str(tmp_path / "out" / "rows"), coverage.summary_rows(records, "id").schema)
    assert rows.filter("filled_count = 1 and scope_in_scope and event_name = concat('event ', id)").count() == 50
    assert spark.read.json(str(tmp_path / "out" / "events")).filter("filled[0] = 'event_name' and fields.event_name").count() == 50
