"""The lookup table and the placement of rows."""

import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from freightlake.llm import sharding


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def test_table_follows_preferences_in_turns():
    shards, slots = ["a", "b", "c"], 13
    orders = {
        s: [
            (number(f"offset:{s}") + j * (number(f"skip:{s}") % (slots - 1) + 1)) % slots
            for j in range(slots)
        ]
        for s in shards
    }
    owner = {}
    for turn in range(slots):
        shard = shards[turn % 3]
        owner[next(x for x in orders[shard] if x not in owner)] = shard
    table = sharding.fill_table(shards, slots)
    assert [shards[i] for i in table] == [owner[x] for x in range(slots)]


def test_shares_are_even_and_few_slots_move():
    names = [f"s{i}" for i in range(16)]
    before = sharding.fill_table(names, 2039)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    after = sharding.fill_table(names[:-1], 2039)
    moved = sum(a != b for a, b in zip(before, after) if a != 15)
    assert moved < 0.15 * 2039


def test_table_is_refused_without_prime_or_names():
    for shards, slots in ((["a"], 12), ([], 13), (["a", "a"], 13), (["a"] * 20, 13)):
        with pytest.raises(ValueError):
            sharding.fill_table(shards, slots)


def test_rows_are_placed_whole(make):
    rows = make(
        [(1, "x", "t"), (1, "x", "t"), (None, "y", None), (7, None, "")],
        "doc_id long, slot string, text string",
    )
    placed = sharding.place(rows)
    assert placed.columns == ["doc_id", "text", "slot", "shard"]
    table = sharding.fill_table(list(sharding.SHARDS), sharding.SLOTS)
    got = placed.collect()
    assert len(got) == 4
    for row in got:
        key = "" if row.doc_id is None else str(row.doc_id)
        assert row.slot == number(key) % sharding.SLOTS
        assert row.shard == sharding.SHARDS[table[row.slot]]
    assert sharding.place(rows.limit(0)).count() == 0


def test_plan_has_no_shuffle_and_no_python(spark):
    placed = sharding.place(spark.range(10).select(F.col("id").alias("doc_id")))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert "hashpartitioning" not in plan and "Python" not in plan
