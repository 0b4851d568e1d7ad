"""Work is dealt by rows, and what a page or an event gives is worked out once."""

from pyspark.sql import functions as F

from eventloom.functions.text import extract_dates
from eventloom.jobs import event_pages as ep
from eventloom.operators import crawl, evidence, merge


def _named(column, name):
    return str(column).count(name)


def test_derived_pages_are_dealt_evenly(spark, sf):
    orders = spark.read.parquet(f"{sf}/orders.parquet").count()
    sizes = [r["count"] for r in ep.pages(spark, sf, "rows").groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(sizes) == ep.n_tasks(orders, 4) > 1
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


def test_tasks_go_by_the_rows():
    assert [ep.n_tasks(n, 12) for n in (0, 1, 250, 251, 150_000, 900_000, 9_000_000)] == [1, 1, 1, 2, 48, 90, 900]


def test_maps_of_provenance_are_worked_out_once(spark):
    held, more = F.upper(F.col("the_held")), F.upper(F.col("the_more"))
    assert _named(merge.merge_of_entries(held, more), "the_held") == _named(merge.merge_of_entries(held, more), "the_more") == 1


def test_links_are_read_once_for_all_roles(spark):
    assert _named(crawl.subpages(F.col("the_links"), F.col("base")), "the_links") == 1


def test_unpublished_lists(spark):
    rows = [(["a"], ["b"], "Coming soon", "main"), (["a"], ["b"], "Coming soon", "program"), (["a"], ["b"], "Published", "main"), ([], [], "tba", None)]
    made = spark.createDataFrame(rows, "s array<string>, a array<string>, t string, r string")
    got = made.select(evidence.clear_unpublished(*map(F.col, ("s", "a", "t", "r"))).alias("x")).select("x.*").collect()
    assert [tuple(r) for r in got] == [([], [], 2), (["a"], [], 1), (["a"], ["b"], 0), ([], [], 0)]


def test_dates_by_the_first_pattern_that_finds_one(spark):
    texts = ["2026-05-01 and May 3, 2027", "on May 3, 2027", "June 5 - 7, 2026", "nothing", None]
    got = [tuple(r["x"]) for r in spark.createDataFrame([(t,) for t in texts], "t string").select(extract_dates(F.col("t")).alias("x")).collect()]
    assert got == [("2026-05-01", "2026-05-01"), ("2027-05-03", "2027-05-03"), ("2026-06-05", "2026-06-07"), (None, None), (None, None)]
