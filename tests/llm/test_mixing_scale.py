"""The mix's points at slots far beyond a double's whole numbers, and running sums over many groups of buckets."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from eventloom.llm import mixing


def test_points_keep_their_fractions(spark):
    one = 1 << 256
    golden = Fraction((math.isqrt(5 * one * one) - one) // 2, one)
    rng = random.Random(2)
    slots = [0, 1, 2, 2**20 - 1, 2**20, 10**11, 2**59 + 12345, *(rng.randrange(2**59) for _ in range(200))]
    for r in spark.createDataFrame([(k,) for k in slots], "slot long").withColumn("u", mixing.golden_point(F.col("slot"))).collect():
        exact = r["slot"] * golden % 1
        assert 0 <= r["u"] < 1 and min(abs(r["u"] - exact), 1 - abs(r["u"] - exact)) < 1e-9


@pytest.mark.parametrize("group", [1, 3, 4096])
def test_running_sums_at_three_levels(spark, monkeypatch, group):
    monkeypatch.setattr(mixing, "GROUP", group)
    rng = random.Random(group)
    rows = [(rng.choice("aab"), k // 4, k, rng.randrange(-3, 50)) for k in rng.sample(range(600), 300)]
    frame = spark.createDataFrame(rows, "s string, b long, k long, v long")
    got = {r["k"]: r["sum"] for r in mixing.running(frame, ["s"], "b", [F.col("k")], F.col("v"), "sum").collect()}
    assert got == {k: sum(w for t, _, j, w in rows if t == s and j < k) for s, _, k, _ in rows}
    assert mixing.running(frame.limit(0), ["s"], "b", [F.col("k")], F.col("v"), "sum").count() == 0
