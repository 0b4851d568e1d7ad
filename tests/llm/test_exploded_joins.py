"""Exploded tables are far larger than Spark takes them for, so none of them may be sent to every task."""

from pyspark.sql import functions as F

from eventloom.llm import simhash
from eventloom.llm.common import staged


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fingerprints_of_a_small_file_are_not_broadcast(spark):
    """Its explode into 66 look-ups each was, and took the driver's memory."""
    prints = staged(spark.range(20000).select(F.xxhash64("id").alias("fp")).unionByName(spark.createDataFrame([(0,), (7,)], "fp long")), "prints")
    pairs = simhash.near_pairs(prints)
    assert [tuple(r) for r in pairs.filter("a = 0").collect()] == [(0, 7)]
    assert "BroadcastHashJoin" not in plan_of(pairs)


def test_blocks_of_buckets_are_not_broadcast(spark):
    rows = [(1, 10, 9, 1, 2, 10), (1, 11, 9, 1, 2, 11)]
    posts = staged(spark.createDataFrame(rows, "tok long, _key long, n long, pos long, df long, _root long"), "posts")
    pairs = simhash._bucket_pairs(posts, 0.8, 1)
    assert [tuple(sorted(r)) for r in pairs.collect()] == [(10, 11)]
    assert "BroadcastHashJoin" not in plan_of(pairs)


def test_code_of_the_join_of_blocks_stays_small(spark):
    """Spark's code for it compared structs, and its compilation took over 200 MB of an executor's memory beside the heap."""
    rows = [(t, k, 9 + k % 2, (t + k) % 3, 4, k) for t in range(3) for k in (10, 11, 12, 13)]
    posts = staged(spark.createDataFrame(rows, "tok long, _key long, n long, pos long, df long, _root long"), "posts")
    pairs = simhash._bucket_pairs(posts, 0.1, 2)
    assert sorted(tuple(r) for r in pairs.collect()) == [(a, b) for a in range(10, 14) for b in range(a + 1, 14)]
    assert "struct(" not in plan_of(pairs)
