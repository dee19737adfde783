"""Landed pages as a data source: order, push-down, stream by run."""

import json
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tributary.functions.cells import Records
from tributary.plans.extract import newer_than
from tributary.sources.pages import FORMAT, LandedPages, Parts, page_records, read_pages, stream_pages

TIMES = [
    1709251200, 1709251200000, "1709251200", "1709251200000", 1709251200.5, "2024-03-01", "2024-03-01T00:00:00Z", "2024-03-01 00:00:01",
    "2024-03-01T05:30:00+05:30", "2024-02-29T23:59:59.9999Z", "20240301", "2024", "nope", None, True, -5, "2024-03-01T00:00:00.0000001", {"a": 1},
]


def put(root, run, pages, done=True):
    folder = f"{root}/stripe/charges/run_date={run[:10].replace('-', '')}/{run}"
    os.makedirs(folder, exist_ok=True)
    for i, lines in enumerate(pages):
        with open(f"{folder}/part-{i:05}.json", "w", encoding="utf-8") as out:
            out.write("\n".join(lines))
    if done:
        open(f"{folder}/_SUCCESS", "w").close()


def page(*records):
    return json.dumps({"object": "list", "data": list(records), "has_more": False})


def test_records_keep_their_text():
    text = '{ "url" : {"data": [0]}, "data" : [ {"id": 1.50, "x": "]}"} , 7,"a" ], "more": 1}'
    assert [t for t, _ in page_records(text)] == ['{"id": 1.50, "x": "]}"}', "7", '"a"']
    assert [list(page_records(t)) for t in ("{}", '{"data": 3}', '{"data": []}')] == [[]] * 3
    for text in ("[1]", "5", "", '{"data": [1'):
        with pytest.raises(ValueError):
            list(page_records(text))


def test_cutoff_in_the_scan_agrees_with_the_rule(spark, tmp_path):
    put(tmp_path, "2024-07-01T00-00-00Z", [[page(*[{"id": i, "created": t} for i, t in enumerate(TIMES)]), "no page {"], [page()]])
    everything = read_pages(spark, str(tmp_path), "stripe", "charges")
    assert everything.count() == len(TIMES) + 1
    assert [r["item"] for r in everything.where("record IS NULL").collect()] == [-1]
    for second in (1709251199, 1709251200, 1709251201, 0):
        cutoff = datetime.fromtimestamp(second, timezone.utc)
        pushed = read_pages(spark, str(tmp_path), "stripe", "charges", since=cutoff)
        plain = newer_than(Records(everything, "record"), "stripe", cutoff).df
        ids = [sorted(r["i"] for r in df.selectExpr("variant_get(record, '$.id', 'int') AS i").collect()) for df in (pushed, plain)]
        assert ids[0] == ids[1]


def test_filters_are_applied_by_the_source(spark, tmp_path):
    runs = ["2024-07-01T00-00-00Z", "2024-07-02T00-00-00Z", "2024-07-03T00-00-00Z"]
    for i, run in enumerate(runs):
        put(tmp_path, run, [[page(*[{"id": j, "created": 1700000000 + j} for j in range(i * 10, i * 10 + 10)])] for _ in range(3)], done=i < 2)
    def load():
        return spark.read.format(FORMAT).options(path=f"{tmp_path}/stripe/charges").load()

    everything = read_pages(spark, str(tmp_path), "stripe", "charges")
    chosen = load().where((F.col("event_second") > 1700000004) & (F.col("run_id") >= runs[0]) & (F.col("run_id") < runs[1]))
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "1700000004" not in plan and runs[1] not in plan
    assert chosen.count() == 15
    # A run whose landing is not complete is not read.
    assert load().count() == 60 and load().where(F.col("run_id").isin(runs[1:])).count() == 30
    assert everything.where(F.col("run_id") == runs[0]).count() == 30 and everything.count() == 60
    assert read_pages(spark, str(tmp_path), "stripe", "charges", first_run=runs[1], last_run=runs[2]).count() == 30
    reader = LandedPages({"path": f"{tmp_path}/stripe/charges"}).reader(None)
    assert [len(t.files) for t in reader.partitions()] == [6]
    small = LandedPages({"path": f"{tmp_path}/stripe/charges", "taskBytes": "1"}).reader(None)
    assert [len(t.files) for t in small.partitions()] == [1] * 6
    assert all(isinstance(t, Parts) for t in small.partitions())
    nothing = spark.read.format(FORMAT).options(path=f"{tmp_path}/nowhere").load()
    assert nothing.count() == 0


def test_stream_takes_each_complete_run_once(spark, tmp_path):
    root = f"{tmp_path}/raw"
    os.makedirs(f"{root}/stripe/charges")

    def catch_up():
        stream = stream_pages(spark, root, "stripe", "charges").selectExpr("run_id", "variant_get(record, '$.id', 'int') AS id")
        stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start(
            f"{tmp_path}/out"
        ).awaitTermination()
        return sorted(r["id"] for r in spark.read.schema("run_id string, id int").parquet(f"{tmp_path}/out").collect())

    put(root, "2024-07-01T00-00-00Z", [[page({"id": 1}, {"id": 2})]])
    put(root, "2024-07-02T00-00-00Z", [[page({"id": 3})]], done=False)
    assert catch_up() == [1, 2]
    assert catch_up() == [1, 2]
    put(root, "2024-07-02T00-00-00Z", [[page({"id": 3})]])
    put(root, "2024-07-03T00-00-00Z", [[page({"id": 4})]])
    assert catch_up() == [1, 2, 3, 4]
    batch = read_pages(spark, root, "stripe", "charges").selectExpr("variant_get(record, '$.id', 'int') AS id")
    assert sorted(r["id"] for r in batch.collect()) == [1, 2, 3, 4]
