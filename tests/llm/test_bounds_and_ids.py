"""Shard bounds over many heavy cells and the whole span of ids; conversations named by texts."""

import bisect
import random

from pyspark.sql import functions as F

from eventloom.llm import chat, warc
from eventloom.llm.common import NO_ID


def test_bounds_of_ten_thousand_heavy_cells(spark):
    """Every cell of the first pass is heavy, some ids are heavy by themselves: shards still hold at most three sizes' worth."""
    rng = random.Random(5)
    rows = [(c * 1_000_003 + rng.randrange(40) ** 3, rng.randrange(600, 1400)) for c in range(10_000) for _ in range(3)]
    rows += [(77 * 1_000_003, 40_000), (-(2**63) + 1, 9000), (2**63 - 1, 9000), (NO_ID, 7000)]
    layout = warc.Layout(shard_bytes=1, most_shards=9_000)
    total = sum(n for _, n in rows)
    shard = warc.shard_size(total, layout)
    assert shard == -(-total // 9_000)
    frame = spark.createDataFrame(rows, "_id long, _bytes long")
    bounds = warc.shard_bounds(frame, layout)
    assert bounds == sorted(bounds) and len(bounds) == len(set(bounds)) < 2 * 9_000
    held, by_id = {}, {}
    for i, n in rows:
        by_id[i] = by_id.get(i, 0) + n
        at = bisect.bisect_right(bounds, (i, 0.0))
        held[at] = held.get(at, 0) + n
    cut = {a for a, p in bounds if p}
    assert cut == {i for i, n in by_id.items() if n > shard and i in cut} and 77 * 1_000_003 in cut
    whole = [n for at, n in held.items() if bounds[at - 1][0] not in cut and (at == len(bounds) or bounds[at][0] not in cut)]
    assert max(whole) <= 3 * shard and len(whole) > 4_000
    cells = warc.cell_sizes(frame, shard)
    assert sum(n for *_, n in cells) == total - 7000 and all(a < b <= c for (a, b, _), (c, _, _) in zip(cells, cells[1:], strict=False))
    assert all(n <= 2 * shard or b - a == 1 for a, b, n in cells)


def test_bounds_of_empty_tables(spark):
    none = spark.createDataFrame([], "_id long, _bytes long")
    assert warc.shard_bounds(none, warc.Layout()) == [] and warc.cell_sizes(none, 10) == []
    assert warc.shard_bounds(spark.createDataFrame([(NO_ID, 0)], "_id long, _bytes long"), warc.Layout()) == []


def test_chat_of_texts_as_ids(spark):
    rows = [("a", 0, "user", "x" * 100_000, 1), ("a", 1, "assistant", "", 2), ("a", 1, "assistant", "", 2), ("b", 0, "assistant", "y", 3), (None, 0, "user", "z", 4), ("", 0, None, None, 5)]
    frame = spark.createDataFrame(rows, "conv_id string, turn long, role string, text string, piece int")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(frame)).collect()}
    assert {k: (r["n_turns"], r["valid"]) for k, r in got.items()} == {"a": (3, False), "b": (1, False), None: (1, True), "": (1, False)}
    assert chat.read_back(chat.format_conversations(frame.limit(0))).count() == 0
    one = frame.filter("conv_id is null").withColumn("conv_id", F.lit(None).cast("string"))
    assert [tuple(r)[:2] for r in chat.read_back(chat.format_conversations(one.coalesce(1))).collect()] == [(None, 1)]
