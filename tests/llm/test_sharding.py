"""Placement by the lookup table."""

from collections import Counter

import pytest

from tributary.llm import queries, sharding
from tributary.llm.common import Stage


def plain_fill(shards, size, weights):
    """Turns written out, each preference list in full."""
    orders = []
    for s in shards:
        start, step = sharding._hash(s, "start") % size, sharding._hash(s, "step") % (size - 1) + 1
        orders.append([(start + j * step) % size for j in range(size)])
    owner = {}
    while len(owner) < size:
        for i, order in enumerate(orders):
            for _ in range(weights[i]):
                slot = next((x for x in order if x not in owner), None)
                if slot is not None:
                    owner[slot] = i
    return [owner[i] for i in range(size)]


@pytest.mark.parametrize("weights", [[1, 1, 1, 1, 1], [3, 1, 2, 1, 1]])
def test_fill(weights):
    shards = [f"s{i}" for i in range(5)]
    assert sharding.fill(shards, 251, weights).tolist() == plain_fill(shards, 251, weights)


def test_fill_is_even_and_stable():
    shards = [f"s{i}" for i in range(50)]
    table = sharding.fill(shards)
    counts = Counter(table.tolist())
    assert max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill(shards[:-1])
    moved = sum(a != b for a, b in zip(table.tolist(), fewer.tolist()) if a != 49)
    assert moved < 0.1 * sharding.SIZE
    heavy = Counter(sharding.fill(["a", "b"], 1009, [3, 1]).tolist())
    assert abs(heavy[0] - 3 * heavy[1]) <= 4
    for bad in ([], ["a", "a"]):
        with pytest.raises(ValueError):
            sharding.fill(bad)
    with pytest.raises(ValueError):
        sharding.fill(["a"], 100)
    with pytest.raises(ValueError):
        sharding.fill(["a", "b"], 101, [1])


def test_place(spark):
    df = spark.createDataFrame([(i % 100, "x", i) for i in range(400)] + [(None, None, 0), (None, None, 0)], "id long, shard string, slot int")
    placed = sharding.place(df, ["id"], ["a", "b", "c"], 251)
    assert placed.columns == ["id", "slot", "shard"]
    rows = placed.collect()
    assert len(rows) == 402 and len({(r["id"], r["shard"]) for r in rows}) == 101
    table = sharding.fill(["a", "b", "c"], 251)
    slots = {r["id"]: r["s"] for r in df.select("id", sharding.slot_of(df["id"], size=251).alias("s")).collect()}
    assert all(r["shard"] == "abc"[table[slots[r["id"]]]] for r in rows)
    assert sharding.place(df.limit(0), ["id"], ["a"]).count() == 0
    path = Stage(spark, "shards").root
    sharding.write_shards(df, path, ["id"], ["a", "b", "c"], size=251)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.select("id", "slot", "shard").collect())) == sorted(map(str, rows))


def test_query(spark, sf_dir):
    rows = queries.op2_permutation_table(spark, sf_dir).collect()
    assert len({r["doc_id"] for r in rows}) == len(rows) > 0
    full, fewer = sharding.fill(queries.SHARDS), sharding.fill(queries.SHARDS[:-1])
    for r in rows:
        assert r["shard"] == queries.SHARDS[full[r["slot"]]] and r["shard_without_last"] == queries.SHARDS[fewer[r["slot"]]]
