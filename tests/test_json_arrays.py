"""Raw parts split at their records, whatever their size and layout."""

import json
import os
import random
from collections import defaultdict

import pytest
from pyspark.sql import DataFrameWriter

from tributary.queries.registry import QUERIES
from tributary.sources.raw_zone import POSITION, read_raw

TEXTS = ["x", "a}b", "{[", 'q"}\\', "\\\\", "é}", "\n}", ""]


def value(rng, depth=0):
    kind = rng.random()
    if depth > 3 or kind < 0.5:
        return rng.choice([1, -2.5, None, True, *TEXTS])
    if kind < 0.75:
        return {rng.choice("abc}"): value(rng, depth + 1) for _ in range(rng.randrange(4))}
    return [value(rng, depth + 1) for _ in range(rng.randrange(4))]


def parts(rng):
    """File names, their text, and the records they hold."""
    for i in range(8):
        items = [value(rng) if rng.random() < 0.3 else {"id": value(rng, 1), "o": value(rng, 1)} for _ in range(rng.randrange(30))]
        yield f"array{i}.json", json.dumps(items, indent=rng.choice([None, 1, 3]), ensure_ascii=rng.random() < 0.5), items
    objects = [{"id": i, "v": value(rng)} for i in range(20)]
    yield "lines.json", "\n".join(map(json.dumps, objects)), objects
    yield "spread.json", "\n".join(json.dumps(o, indent=2) for o in objects) + "\n", objects
    yield "one.json", '{"a":{"b":[1,2,{}]}}', [{"a": {"b": [1, 2, {}]}}]
    yield "cut.json", '[{"id":1},{"id":2},{"id": {"x": 3}, "na', [{"id": 1}, {"id": 2}, None]
    yield "empty.json", "", []
    yield "none.json", " [ \n ]\n", []
    yield "plain.json", '[1, "}", 2]', [1, "}", 2]


@pytest.mark.parametrize("size", ["17", "64", "1000", "128MB"])
def test_records_of_any_layout_and_range(spark, tmp_path, size):
    rng = random.Random(size)
    folder = f"{tmp_path}/stripe/charges"
    os.makedirs(folder)
    expected = {}
    for name, text, records in parts(rng):
        expected[name] = records
        with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
            out.write(text)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}
    spark.conf.set(names[0], size)
    spark.conf.set(names[1], "0")
    try:
        rows = read_raw(spark, str(tmp_path), "stripe", "charges", split_files=True).selectExpr(*POSITION, "to_json(raw) AS j")
        found = defaultdict(list)
        for r in rows.orderBy(*POSITION).collect():
            found[os.path.basename(r["part"])].append(None if r["j"] is None else json.loads(r["j"]))
    finally:
        for n in names:
            spark.conf.set(n, before[n])
    assert {name: found[name] for name in expected} == expected


def test_no_part(spark, tmp_path):
    assert read_raw(spark, str(tmp_path), "stripe", "charges", split_files=True) is None


def test_one_array_is_streamed_to_its_file(spark, sf_dir, monkeypatch):
    texts = []

    def text(writer, path, *args, **kwargs):
        texts.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, path, *args, **kwargs)

    write = DataFrameWriter.text
    monkeypatch.setattr(DataFrameWriter, "text", text)
    assert QUERIES["raw_huge_array"](spark, sf_dir).count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert len(texts) == 1 and "Sort" not in texts[0]
