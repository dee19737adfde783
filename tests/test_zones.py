"""Raw zone shapes, envelopes, contracts, dedupe, merge, stages and the stream."""

import glob
import json
import os
import re
import subprocess
import sys
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tributary import session
from tributary.functions.cells import Records
from tributary.functions.keys import new_run_id
from tributary.operators.contracts import CONTRACTS, validate
from tributary.operators.dedupe import deduplicate
from tributary.operators.envelope import unwrap
from tributary.operators.gate import coerce_records
from tributary.operators.mapping import MAPPINGS, Moments, ResourceMapping, get_mapping, map_records
from tributary.operators.sketches import ERROR, estimated, layout, merged, overlap, sketches
from tributary.plans import transform
from tributary.plans.extract import run_extract
from tributary.plans.load import run_load
from tributary.plans.run import Zones, run_all
from tributary.plans.transform import run_transform, transform_records
from tributary.queries.inputs import raw_view
from tributary.queries.registry import incoming_batch, shown, target_batch
from tributary.session import SMALL_TASKS, settings
from tributary.sources import warehouse as warehouse_module
from tributary.sources.packing import pack_run
from tributary.sources.processed_zone import read_unified, read_unified_json, write_json, write_unified
from tributary.sources import packing, raw_zone
from tributary.sources.raw_zone import POSITION, find_raw_parts, land_raw, read_raw
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks
from tributary.streaming.incremental import stream_upsert

NOW = datetime(2024, 7, 1, tzinfo=timezone.utc)


def put(path, content):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def json_rows(spark, payloads):
    return spark.createDataFrame(list(enumerate(payloads)), "i int, j string").selectExpr("i", "parse_json(j) AS raw")


def test_part_shapes(spark, tmp_path):
    run = f"{tmp_path}/stripe/customers/run_date=20240701/r1"
    put(f"{run}/part-00000.json", json.dumps([{"id": "a"}, 2, "x", None]))
    put(f"{run}/part-00001.json", '{"id":"b"}\n{"id":"c"}\n\n{"id":"d"\n{"id":"e"}{"id":"f"}\n')
    put(f"{tmp_path}/other/x/part-00000.json", '{"id":"z"}')
    put(f"{tmp_path}/salesforce/contacts/part-00000.json", '{"id":"z"}')
    found = {(r["source"], r["resource"], r["is_mapped"]) for r in find_raw_parts(spark, str(tmp_path)).collect()}
    assert found == {("stripe", "customers", True), ("salesforce", "contacts", False)}
    rows = read_raw(spark, str(tmp_path), "stripe", "customers").selectExpr(
        "*", "CAST(record AS STRING) AS text"
    ).orderBy(*POSITION).collect()
    assert [r["text"] for r in rows] == ['{"id":"a"}', "2", "x", None, '{"id":"b"}', '{"id":"c"}', None, None]
    assert read_raw(spark, str(tmp_path), "stripe", "charges") is None
    assert find_raw_parts(spark, f"{tmp_path}/nowhere").count() == 0


def test_whole_file_parts(spark, tmp_path):
    put(f"{tmp_path}/stripe/customers/p.json", json.dumps([{"id": "a"}, {"id": "b"}], indent=2))
    assert read_raw(spark, str(tmp_path), "stripe", "customers", whole_files=True).count() == 2


def test_unwrap(spark):
    cases = [
        ('{"source":"stripe","data":{"id":"a"}}', '{"id":"a"}'),
        ('{"source":null,"data":{"id":"a"}}', '{"id":"a"}'),
        ('{"id":"a","data":{"id":"b"}}', '{"data":{"id":"b"},"id":"a"}'),
        ('{"source":"s","data":[1]}', '{"data":[1],"source":"s"}'),
        ("2", "2"),
    ]
    rows = json_rows(spark, [c for c, _ in cases]).selectExpr("i", f"CAST({unwrap('raw')} AS STRING) AS t").collect()
    assert [r["t"] for r in sorted(rows, key=lambda r: r["i"])] == [e for _, e in cases]


def test_rejects_and_kinds(spark):
    payloads = [
        '{"id":"c1","amount":1200,"currency":"usd","status":"succeeded","created":1700000000}',
        '{"id":7,"amount":12.0,"currency":"jpy","created":"2024-01-01"}',
        '{"id":" ","created":1}',
        '{"id":"c2","created":true}',
        '{"id":"c3","amount":"x","currency":"us","created":1700000000}',
        "5",
    ]
    df = json_rows(spark, payloads).withColumnRenamed("raw", "record")
    rows = {r["i"]: r for r in map_records(Records(df, "record"), MAPPINGS["stripe", "charges"], NOW, ("i",)).collect()}
    assert rows[0]["reject_stage"] is None and rows[0]["amount_minor"] == 1200 and str(rows[0]["amount"]) == "12.00"
    assert rows[1]["unified_id"] == "stripe:transaction:7" and rows[1]["amount_minor"] == 12
    assert [rows[i]["reject_reason"] for i in (2, 3, 4, 5)] == [
        "missing id field 'id'", "missing or unparseable 'created'", "Input should be a valid string",
        "record is not a JSON object",
    ]
    assert [e["field"] for e in rows[4]["reject_errors"]] == ["currency", "amount_minor"]
    assert json.loads(rows[4]["payload"])["id"] == "c3" and rows[0]["payload"] is None


def test_contract_kinds(spark):
    payloads = [
        '{"id":" a ","amount":" 12 ","currency":" USD ","status":"s","created":1700000000,"livemode":"yes"}',
        '{"id":"a","amount":true,"currency":"usd","status":"s","created":"2024-01-01","livemode":0}',
        '{"id":5,"amount":100.5,"currency":null,"created":"x","livemode":null}',
        '{"id":"a","amount":"1e3","currency":"usd","status":"","created":1700000000,"livemode":"2"}',
        "[1]",
    ]
    df = json_rows(spark, payloads).withColumnRenamed("raw", "record")
    rows = {r["i"]: r for r in validate(Records(df, "record"), CONTRACTS["stripe", "charges"], ("i",)).collect()}
    assert rows[0]["is_valid"] and (rows[0]["id"], rows[0]["amount"], rows[0]["currency"], rows[0]["livemode"]) == ("a", 12, "usd", True)
    assert rows[1]["is_valid"] and rows[1]["amount"] == 1 and rows[1]["livemode"] is False
    assert [(e["field"], e["type"]) for e in rows[2]["errors"]] == [
        ("id", "string_type"), ("amount", "int_from_float"), ("currency", "string_type"), ("status", "missing"),
        ("created", "datetime_parsing"), ("livemode", "bool_type"),
    ]
    assert [(e["field"], e["type"]) for e in rows[3]["errors"]] == [("amount", "int_parsing"), ("livemode", "bool_parsing")]
    assert [e["type"] for e in rows[4]["errors"]] == ["dict_type"]


def test_colliding_ids_share_a_key(spark):
    charge = spark.createDataFrame([("x1", "5", "usd", "1700000000")], "id string, amount string, currency string, created string")
    invoice = charge.withColumnRenamed("amount", "amount_due")
    one = transform_records(Records(charge), "stripe", "charges", NOW).unified.first()
    two = transform_records(Records(invoice), "stripe", "invoices", NOW).unified.first()
    assert one["unified_id"] == two["unified_id"] == "stripe:transaction:x1"


def test_mapping_lookup_and_checks():
    with pytest.raises(ValueError, match="no mapping for stripe/refunds"):
        get_mapping("stripe", "refunds")
    with pytest.raises(ValueError, match="unknown entity type"):
        ResourceMapping(("stripe", "x"), "thing", "id", Moments("created"))


def test_dedupe(spark):
    rows = [("a", 1, 1, "old"), ("a", 2, 0, "new"), ("a", None, 9, "null"), ("b", None, 1, "first"), ("b", None, 2, "last")]
    df = spark.createDataFrame(rows, "k string, t int, pos int, v string")
    assert {(r["k"], r["v"]) for r in deduplicate(df, ["k"], "t", ["pos"]).collect()} == {("a", "new"), ("b", "last")}
    assert {(r["k"], r["v"]) for r in deduplicate(df, ["k"], None, ["pos"]).collect()} == {("a", "null"), ("b", "last")}
    assert deduplicate(df, ["nope"], "t").count() == 5
    plan = deduplicate(df, ["k"], "t", ["pos"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_hot_key(spark):
    """A third of all rows share one key; each task sends on one row of it."""
    df = spark.range(0, 90000, 1, 8).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k", "id AS t")
    out = deduplicate(df, ["k"], "t", ["t"])
    assert out.count() == 60001 and out.where("k = -1").first()["t"] == 89997


def snapshot(house):
    return sorted(tuple(r) for r in house.read().collect())


@pytest.mark.parametrize("limit", ["10485760", "10MB", "-1"])
def test_upsert_is_one_path_and_repeats(spark, sf_dir, tmp_path, limit):
    target, incoming = target_batch(spark, sf_dir).cache(), incoming_batch(spark, sf_dir).cache()
    expected = {r["unified_id"]: r for r in target.collect()}
    known = set(expected)
    expected.update({r["unified_id"]: r for r in incoming.collect()})
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        house = Warehouse(spark, f"{tmp_path}/t", buckets=3, slices=2)
        house.upsert(target)
        first = house.upsert(incoming).first()
        once = snapshot(house)
        again = house.upsert(incoming).first()
        assert snapshot(house) == once
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    n = incoming.count()
    overlap = len(known & {r["unified_id"] for r in incoming.collect()})
    assert (first["input"], first["inserted"], first["updated"]) == (n, n - overlap, overlap)
    assert (again["inserted"], again["updated"]) == (0, n)
    assert house.count().first()["row_count"] == len(expected)
    assert {r[0]: r[10] for r in once} == {k: r["status"] for k, r in expected.items()}


def unified_rows(spark, rows):
    return spark.createDataFrame(
        [(f"stripe:customer:{i}", "stripe", "customers", i, "customer", n, "active", t, "2024-07-01") for i, n, t in rows],
        "unified_id string, source string, source_resource string, source_id string, entity_type string, "
        "name string, status string, updated_at string, ingested_at string",
    ).withColumn("created_at", F.lit("2024-01-01"))


def test_last_write_wins_or_newest_wins(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=2)
    house.upsert(unified_rows(spark, [("1", "new", "2024-03-01"), ("2", "keep", "2024-03-01")]))
    late = unified_rows(spark, [("1", "old", "2024-02-01"), ("1", "older", "2024-01-01")])
    house.upsert(late, newest_wins=True)
    assert {r["source_id"]: r["name"] for r in house.read().collect()} == {"1": "new", "2": "keep"}
    stats = house.upsert(late).first()
    assert {r["source_id"]: r["name"] for r in house.read().collect()} == {"1": "old", "2": "keep"}
    assert (stats["input"], stats["updated"], stats["inserted"]) == (2, 1, 0)


def test_failed_merge_changes_nothing(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=2)
    house.upsert(unified_rows(spark, [("1", "a", None), ("3", "x", None)]))
    before = snapshot(house)
    rows = unified_rows(spark, [("1", "b", None), ("2", "c", None)])
    broken = rows.withColumn("name", F.when(F.col("source_id") == "2", F.raise_error(F.lit("lost"))).otherwise(F.col("name")))
    with pytest.raises(Exception, match="lost"):
        house.upsert(broken, stage=False)
    assert snapshot(house) == before
    house.upsert(rows)
    assert {r["name"] for r in house.read().collect()} == {"b", "c", "x"}


def test_merge_moves_no_row_of_the_table(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=3, slices=2)
    house.upsert(unified_rows(spark, [(str(i), "a", None) for i in range(50)]))
    batch = coerce_records(unified_rows(spark, [(str(i), "b", None) for i in range(40, 60)])).withColumn("bucket", house._bucket())
    merged = house.merged(batch)
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SelectedBucketsCount: 2 out of 2" in plan
    assert {(r["merge_action"], r["count"]) for r in merged.groupBy("merge_action").count().collect()} == {("kept", 40), ("updated", 10), ("inserted", 10)}
    house.upsert(unified_rows(spark, [(str(i), "c", None) for i in range(60)]))
    files = [f for _, _, names in os.walk(f"{tmp_path}/t/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 3 * 2


def scanned_rows(df):
    """Rows that came out of the only scan of a plan, once it has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_few_keys_are_looked_up(spark, tmp_path, monkeypatch):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=4, slices=4)
    house.upsert(unified_rows(spark, [(str(i), "a", None) for i in range(3200)]))
    asked = unified_rows(spark, [(str(i), "x", None) for i in (5, 77, 9999)])
    found = sorted(r["unified_id"] for r in house.existing_keys(asked).collect())
    assert found == ["stripe:customer:5", "stripe:customer:77"]
    rows = house.looked_up(["stripe:customer:5"])
    assert scanned_rows(rows) < 3200 / 8 and rows.count() == 1
    assert house.looked_up(["stripe:customer:9999"]).count() == 0 and house.lookup([]) == []
    monkeypatch.setattr("tributary.sources.warehouse.LOOKUP_KEYS", 2)
    joined = house.existing_keys(asked)
    assert "LeftSemi" in joined._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(r["unified_id"] for r in joined.collect()) == found


def test_packed_runs_keep_order_and_bounds(spark, tmp_path):
    folder = f"{tmp_path}/raw/stripe/customers/run_date=20240701/2024-07-01T00-00-00Z"
    for i in range(300):
        put(f"{folder}/part-{i:05}.json", "\n".join(json.dumps({"id": f"{i}-{j}"}) for j in range(i % 5)))
    sizes = sum(os.path.getsize(f"{folder}/{f}") for f in os.listdir(folder))
    n = pack_run(spark, f"{tmp_path}/raw", f"{tmp_path}/packed", "stripe", "customers", "2024-07-01T00-00-00Z", part_bytes=1000)
    out = f"{tmp_path}/packed/stripe/customers/run_date=20240701/2024-07-01T00-00-00Z"
    packed = {f: os.path.getsize(f"{out}/{f}") for f in os.listdir(out) if f.endswith(".txt")}
    assert n == len(packed) <= sizes // 1000 + 1 and max(packed.values()) < 1100

    def ids(root, **options):
        rows = read_raw(spark, root, "stripe", "customers", **options).selectExpr(*POSITION, "variant_get(record, '$.id', 'string') AS id")
        return [r["id"] for r in rows.orderBy(*POSITION).collect()]

    assert ids(f"{tmp_path}/packed", glob="*.txt") == ids(f"{tmp_path}/raw")
    again = pack_run(spark, f"{tmp_path}/raw", f"{tmp_path}/packed", "stripe", "customers", "2024-07-01T00-00-00Z", part_bytes=1000)
    assert again == n and ids(f"{tmp_path}/packed", glob="*.txt") == ids(f"{tmp_path}/raw")
    assert pack_run(spark, f"{tmp_path}/raw", f"{tmp_path}/packed", "stripe", "charges", "2024-07-01T00-00-00Z") is None


def test_bounded_parts_are_dealt_to_tasks_in_order(spark, tmp_path):
    rows = spark.range(0, 2000, 1, 2).selectExpr("concat('c', id) AS id")
    path = land_raw(rows, f"{tmp_path}/raw", "stripe", "customers", "2024-07-01T00-00-00Z", part_records=5)
    files = [f for f in os.listdir(path) if f.endswith(".json")]
    tasks = {f.split("-")[1] for f in files}
    assert len(tasks) == 4 and 400 <= len(files) <= 404
    records = read_raw(spark, f"{tmp_path}/raw", "stripe", "customers")
    found = records.selectExpr(*POSITION, "variant_get(record, '$.id', 'string') AS id").orderBy(*POSITION).collect()
    assert [r["id"] for r in found] == [f"c{i}" for i in range(2000)]


def test_sketches_merge(spark):
    rows = spark.range(30_000).selectExpr("id % 20000 AS key", "id % 3 AS part")
    parts = sketches(rows, "key", "part")
    whole = estimated(merged(parts)).first()["keys"]
    assert abs(whole - 20_000) <= ERROR * 20_000
    a, b, both = overlap(sketches(rows.where("key < 15000"), "key"), sketches(rows.where("key >= 5000"), "key"))
    assert abs(both - 10_000) <= 3 * ERROR * 20_000 and abs(a - 15_000) <= ERROR * 15_000 and abs(b - 15_000) <= ERROR * 15_000
    assert overlap(parts, sketches(rows.limit(0), "key"))[1:] == (0, 0)
    assert layout(10**11, 1000) == {"buckets": 16, "slices": 23284} and layout(0, 1) == {"buckets": 1, "slices": 1}


def test_a_table_is_found_by_another_session(spark, tmp_path):
    root = f"{tmp_path}/it's here/t"
    house = Warehouse(spark, root, buckets=3, slices=2)
    house.upsert(unified_rows(spark, [(str(i), "a", None) for i in range(9)]))
    spark.sql(f"DROP TABLE {house.table}")
    other = Warehouse(spark, root)
    assert other.count().first()["row_count"] == 9
    stats = other.upsert(unified_rows(spark, [("8", "b", None), ("9", "b", None)])).first()
    assert (stats["inserted"], stats["updated"]) == (1, 1)


def test_layout_is_fixed_by_the_first_commit(spark, tmp_path):
    rows = unified_rows(spark, [(str(i), "a", None) for i in range(40)])
    Warehouse(spark, f"{tmp_path}/t", buckets=4, slices=2).upsert(rows)
    for other in ({"buckets": 8}, {"slices": 3}):
        with pytest.raises(ValueError, match="the table has"):
            Warehouse(spark, f"{tmp_path}/t", **other)
    house = Warehouse(spark, f"{tmp_path}/t")
    assert (house.buckets, house.slices) == (4, 2)
    stats = house.upsert(rows.limit(1)).first()
    assert (stats["inserted"], stats["updated"]) == (0, 1) and house.count().first()["row_count"] == 40


def test_slices_grow_with_the_table(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tributary.sources.warehouse.SLICE_ROWS", 10)
    root = f"{tmp_path}/t"
    first = Warehouse(spark, root, buckets=3, slices=2)
    first.upsert(unified_rows(spark, [(str(i), "a", None) for i in range(30)]))
    other = Warehouse(spark, root, slices=2)
    assert other.slices == 2 and os.path.isdir(f"{root}/data")
    stats = other.upsert(unified_rows(spark, [(str(i), "b", None) for i in range(20, 120)])).first()
    assert (stats["input"], stats["inserted"], stats["updated"]) == (100, 90, 10)
    assert other.slices == 13 and [f for f in os.listdir(root) if f.startswith("data")] == ["data-13"]
    # An older handle follows, and merges again move no row of the table.
    assert {r["source_id"]: r["name"] for r in first.read().collect()} == {str(i): "a" if i < 20 else "b" for i in range(120)}
    assert first.slices == 13 and Warehouse(spark, root).slices == 13
    stats = first.upsert(unified_rows(spark, [("0", "c", None), ("120", "c", None)])).first()
    assert (stats["inserted"], stats["updated"]) == (1, 1) and first.count().first()["row_count"] == 121
    at_once = Warehouse(spark, f"{tmp_path}/u", buckets=3, slices=2)
    at_once.upsert(unified_rows(spark, [(str(i), "a", None) for i in range(100)]))
    assert at_once.slices == 10 and at_once.count().first()["row_count"] == 100


def test_tasks_that_sort_whole_records_stay_small(spark, tmp_path, monkeypatch):
    (name,) = SMALL_TASKS
    before = spark.conf.get(name)
    monkeypatch.setitem(SMALL_TASKS, name, "1b")
    rows = coerce_records(unified_rows(spark, [(str(i), "a", None) for i in range(100)])).drop("is_loadable", "reason")
    coalesce = "spark.sql.adaptive.coalescePartitions"
    with settings(spark, {f"{coalesce}.parallelismFirst": "false", f"{coalesce}.minPartitionSize": "1b"}):
        write_unified(deduplicate(rows, ["unified_id"]), f"{tmp_path}/z")
    files = [f for _, _, names in os.walk(f"{tmp_path}/z") for f in names if f.endswith(".parquet")]
    # A task for each of the four partitions of a shuffle, which by itself would be read by one.
    assert len(files) == 4 and read_unified(spark, f"{tmp_path}/z").count() == 100
    assert spark.conf.get(name) == before


def test_shuffles_before_such_sorts_grow_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "SORT_ROWS", 10)
    monkeypatch.setitem(SMALL_TASKS, next(iter(SMALL_TASKS)), "1b")
    rows = coerce_records(unified_rows(spark, [(str(i), "a", None) for i in range(100)])).drop("is_loadable", "reason")
    coalesce, partitions, scans = "spark.sql.adaptive.coalescePartitions", "spark.sql.shuffle.partitions", "spark.sql.files.maxPartitionBytes"
    before = {name: spark.conf.get(name) for name in (partitions, scans)}
    assert before[partitions] == "4"
    with settings(spark, {f"{coalesce}.parallelismFirst": "false", f"{coalesce}.minPartitionSize": "1b"}):
        write_unified(deduplicate(rows, ["unified_id"]), f"{tmp_path}/z", rows=100)
    files = [f for _, _, names in os.walk(f"{tmp_path}/z") for f in names if f.endswith(".parquet")]
    assert len(files) > 4 and read_unified(spark, f"{tmp_path}/z").count() == 100

    seen = []
    write = Warehouse._write

    def noted(self, *args):
        seen.append({name: spark.conf.get(name) for name in before})
        write(self, *args)

    monkeypatch.setattr(Warehouse, "_write", noted)
    house = Warehouse(spark, f"{tmp_path}/t", buckets=2)
    house.upsert(rows)
    house.upsert(rows.where("unified_id < '5'"), skip_unchanged=True)
    house.upsert(rows.withColumn("status", F.lit("failed")))
    assert seen == [{partitions: "10", scans: "16m"}] * 2
    assert {name: spark.conf.get(name) for name in before} == before
    assert house.read().where("status = 'failed'").count() == 100


def test_fields_of_a_record_come_from_one_walk(spark):
    texts = ['{"Id": "a", "id": "b", "x": {"y": 1, "Y": 2}}', '{"id": "c", "ID": "no"}', "[1]", "null", "{}", '"t"', '{"x": null, "Id": null, "id": "d"}']
    df, cells = Records(json_rows(spark, texts), "raw").cells({"Id": ("Id", "id"), "x.y": ("x.y",), "x.Y": ("x.Y",)})
    found = df.orderBy("i").select("_not_object", *[F.expr(c.text) for c in cells.values()], *[F.expr(c.present) for c in cells.values()]).collect()
    none, absent = (None,) * 3, (False,) * 3
    assert [tuple(r) for r in found] == [
        (False, "a", "1", "2", True, True, True), (False, "c", None, None, True, False, False), (True, *none, *absent),
        (True, *none, *absent), (False, *none, *absent), (True, *none, *absent), (False, *none, True, False, False),
    ]
    df, _ = Records(json_rows(spark, texts), "raw").cells({p: (p,) for p in ("id", "amount", "currency")})
    assert df._jdf.queryExecution().optimizedPlan().toString().count("try_variant_get(") == 1


def test_only_rejects_are_written_out_as_text(spark):
    rows = json_rows(spark, ['{"id": "cus_1", "created": 1700000000}', '{"id":"cus_2"}'])
    tagged = map_records(Records(rows, "raw"), get_mapping("stripe", "customers"), NOW, keep=("i",))
    assert [r["payload"] for r in tagged.orderBy("i").collect()] == [None, '{"id":"cus_2"}']
    plan = tagged.select("payload").select("payload", F.lit(1))._jdf.queryExecution().optimizedPlan().toString()
    assert "AS payload#" in plan and not re.search(r"cast\(\w+#\d+ as string\) AS payload#", plan)


def test_staged_records_lie_in_small_row_groups(spark, tmp_path, monkeypatch):
    """A task that sorts what a scan gives it takes as much as the scan cannot cut."""
    for module in (transform, warehouse_module):
        monkeypatch.setattr(module, "discard", lambda spark, path: None)
        monkeypatch.setitem(module.SMALL_ROW_GROUPS, "parquet.block.size", "1024")
        monkeypatch.setattr(module, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    put(f"{tmp_path}/raw/stripe/customers/run_date=20240701/r1/p.json", "".join(
        json.dumps({"id": f"cus_{i}", "name": f"n {i} {i * i}", "created": 1700000000 + i}) + "\n" for i in range(3000)
    ))
    run_transform(spark, f"{tmp_path}/raw", f"{tmp_path}/out", NOW, "r1")
    Warehouse(spark, f"{tmp_path}/t", buckets=2).upsert(read_unified(spark, f"{tmp_path}/out"))
    for label in ("tagged", "incoming"):
        files = glob.glob(f"{tmp_path}/{label}/**/*.parquet", recursive=True)
        assert files and max(pq.ParquetFile(f).metadata.num_row_groups for f in files) > 1


def test_key_is_the_unified_id_alone(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=4)
    house.upsert(unified_rows(spark, [("1", "a", None), ("2", "b", None)]))
    moved = unified_rows(spark, [("1", "moved", None)]).withColumn("entity_type", F.lit("opportunity"))
    stats = house.upsert(moved).first()
    assert (stats["inserted"], stats["updated"]) == (0, 1)
    assert {(r["entity_type"], r["name"]) for r in house.read().collect()} == {("opportunity", "moved"), ("customer", "b")}


def test_many_merges_stay_one_scan(spark, tmp_path):
    house = Warehouse(spark, f"{tmp_path}/t", buckets=4, slices=1)
    for i in range(13):
        house.upsert(unified_rows(spark, [(str(i), f"n{i}", None)]))
    plan = house.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan
    assert house.count().first()["row_count"] == 13
    existing = house.existing_keys(unified_rows(spark, [("3", "x", None), ("99", "x", None)]))
    assert [r["unified_id"] for r in existing.collect()] == ["stripe:customer:3"]


def test_gate(spark, tmp_path):
    rows = unified_rows(spark, [("1", "a", None), ("2", "b", None)]).withColumn(
        "source_id", F.when(F.col("source_id") == "2", "").otherwise(F.col("source_id"))
    ).withColumn("amount_minor", F.lit("12"))
    reasons = {r["name"]: r["reason"] for r in coerce_records(rows).collect()}
    assert reasons == {"a": None, "b": "record missing required columns: source_id"}
    house = Warehouse(spark, f"{tmp_path}/t", buckets=2)
    stats = house.upsert(rows, quarantine=f"{tmp_path}/q").first()
    assert (stats["input"], stats["inserted"], stats["rejected"]) == (2, 1, 1)
    assert spark.read.parquet(f"{tmp_path}/q").count() == 1
    bad = house.upsert(unified_rows(spark, [("3", "c", None)]).withColumn("source_id", F.lit("")))
    assert bad.first()["rejected"] == 1 and house.count().first()["row_count"] == 1


def test_watermarks_do_not_go_back(spark, tmp_path):
    marks = Watermarks(spark, f"{tmp_path}/w")
    assert marks.get("stripe", "charges") is None and marks.read().count() == 0

    def mark(day):
        return spark.createDataFrame(
            [("stripe", "charges", datetime(2024, 1, day, tzinfo=timezone.utc))],
            "source string, resource string, high_water_mark timestamp",
        )

    marks.set(mark(5), "r1", datetime(2024, 7, 1, tzinfo=timezone.utc))
    marks.set(mark(3), "r2", datetime(2024, 7, 2, tzinfo=timezone.utc))
    assert marks.read().first()["last_run_id"] == "r2"
    assert marks.get("stripe", "charges") == datetime(2024, 1, 5, tzinfo=timezone.utc)
    with pytest.raises(ValueError, match="offset"):
        marks.set(mark(6), "r3", datetime(2024, 7, 3))


TOKYO = """
import sys
from datetime import datetime, timezone
from tributary.functions.cells import Records
from tributary.functions.keys import new_run_id
from tributary.plans.run import Zones, run_all
from tributary.session import build_session
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks

spark = build_session("tokyo", "local[2]", **{"spark.sql.shuffle.partitions": "2"})
zones = Zones(sys.argv[1])
now = datetime(2024, 7, 1, tzinfo=timezone.utc)
def run(run_id, rows, **kind):
    records = Records(spark.createDataFrame(rows, "id string, name string, created string"))
    return run_all(spark, {("stripe", "customers"): records}, zones, run_id=run_id, now=now, **kind)
run("2024-07-01T00-00-00Z", [("a", "a", "2024-05-01T12:00:00Z")])
assert Watermarks(spark, zones.watermarks).get("stripe", "customers") == datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
run("2024-07-02T00-00-00Z", [("a", "again", "2024-05-01T12:00:00Z"), ("b", "b", "2024-05-01T13:00:00Z"),
                             ("c", "c", "2024-05-01T22:00:00Z")], incremental=True)
rows = {r["source_id"]: r["name"] for r in Warehouse(spark, zones.warehouse).read().collect()}
assert rows == {"a": "A", "b": "B", "c": "C"}, rows
print("fine")
"""


def test_marks_do_not_depend_on_the_drivers_time_zone(tmp_path):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {**os.environ, "TZ": "Asia/Tokyo", "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", TOKYO, str(tmp_path)], env=env, capture_output=True, text=True, timeout=300)
    assert out.stdout.strip().endswith("fine"), out.stderr[-3000:]


def test_a_run_loads_only_what_it_has_written(spark, tmp_path):
    """A row merged since the last run is not undone by a run that fetches nothing."""
    zones = Zones(str(tmp_path))
    records = customers(spark, [("1", "old", "2024-01-01")])
    run_all(spark, {("stripe", "customers"): records}, zones, run_id="2024-07-01T00-00-00Z", now=NOW, buckets=2)
    house = Warehouse(spark, zones.warehouse)
    house.upsert(house.read().withColumn("name", F.lit("Newer")), decode=False)
    out = run_all(spark, {("stripe", "customers"): records}, zones, run_id="2024-07-02T00-00-00Z", now=NOW, incremental=True)
    assert out["extract"]["stripe/customers"]["fetched"] == 0 and out["load"] == {}
    assert [r["name"] for r in house.read().collect()] == ["Newer"]


def test_a_repeated_run_replaces_what_it_landed(spark, tmp_path):
    def land(rows):
        return run_extract({("stripe", "customers"): customers(spark, rows)}, f"{tmp_path}/raw", "2024-07-01T00-00-00Z", NOW)

    land([("1", "a", "2024-01-01")])
    assert land([("1", "a", "nope")])["stripe/customers"] == {"fetched": 1, "valid": 0, "errors": 1, "failed": 0}
    assert read_raw(spark, f"{tmp_path}/raw", "stripe", "customers").count() == 0


def test_quarantine_tells_the_place(spark, tmp_path):
    rows = [("1", "a", "2024-01-01"), ("2", "b", "nope"), ("3", "c", "2024-01-01"), ("4", "d", "nope")]
    given = Records(customers(spark, rows).df.coalesce(1))
    run_extract({("stripe", "customers"): given}, f"{tmp_path}/raw", "2024-07-01T00-00-00Z", NOW, quarantine_root=f"{tmp_path}/q")
    bad = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/q")
    assert sorted((json.loads(r["payload"])["id"], r["index"]) for r in bad.collect()) == [("2", 1), ("4", 3)]


def test_dedupe_does_not_depend_on_partitions(spark):
    df = spark.range(0, 3000).selectExpr("id % 500 AS k", "id % 2 AS position", "id AS v")
    sums = {deduplicate(df.repartition(n), ["k"], None, ["position"]).agg(F.sum("v")).first()[0] for n in (1, 3, 8)}
    assert len(sums) == 1


def test_custom_mapping_and_whole_files_in_a_run(spark, tmp_path):
    zones = Zones(str(tmp_path))
    put(f"{zones.raw}/stripe/customers/run_date=20240701/r/part-0.json", json.dumps([{"id": "1", "label": "ann", "created": 1700000000}], indent=2))
    mapping = ResourceMapping(("stripe", "customers"), "customer", "id", Moments("created"), name="label", titled=True)
    out = run_all(spark, {}, zones, run_id="2024-07-01T00-00-00Z", now=NOW, whole_files=True, mappings={mapping.origin: mapping}, buckets=2)
    assert out["transform"]["stripe/customers"]["output"] == 1
    assert [r["name"] for r in Warehouse(spark, zones.warehouse).read().collect()] == ["Ann"]


def test_run_ids():
    assert new_run_id(NOW) == "2024-07-01T00-00-00Z"
    assert len(new_run_id()) == 20


def customers(spark, rows):
    return Records(spark.createDataFrame(rows, "id string, name string, created string"))


def test_stages_and_incremental_run(spark, tmp_path):
    zones = Zones(str(tmp_path))
    first = {("stripe", "customers"): customers(spark, [("1", "ann lee", "2024-01-01"), ("2", "bob", "nope"), (" ", "x", "2024-01-01")])}
    out = run_all(spark, first, zones, run_id="2024-07-01T00-00-00Z", now=NOW, buckets=2)
    assert out["extract"]["stripe/customers"] == {"fetched": 3, "valid": 2, "errors": 1, "failed": 0}
    assert out["transform"]["stripe/customers"] == {
        "input": 2, "mapped": 1, "rejected": 1, "duplicates_removed": 0, "output": 1,
    }
    assert out["load"]["stripe/customers"] == {"input": 1, "inserted": 1, "updated": 0, "rejected": 0}
    later = {("stripe", "customers"): customers(spark, [("1", "changed", "2024-01-01"), ("3", "cy", "2024-02-01")])}
    out = run_all(spark, later, zones, run_id="2024-07-02T00-00-00Z", now=NOW, buckets=2, incremental=True)
    assert out["extract"]["stripe/customers"]["fetched"] == 1
    assert out["load"]["stripe/customers"] == {"input": 1, "inserted": 1, "updated": 0, "rejected": 0}
    rows = {r["source_id"]: r["name"] for r in Warehouse(spark, zones.warehouse).read().collect()}
    assert rows == {"1": "Ann Lee", "3": "Cy"}
    assert spark.read.parquet(f"{zones.quarantine}/transform").count() == 1


def test_failed_resource_does_not_stop_the_others(spark, tmp_path):
    def broken():
        raise OSError("source is down")

    inputs = {("stripe", "charges"): broken, ("stripe", "customers"): customers(spark, [("1", "a", "2024-01-01")])}
    summary = run_extract(inputs, f"{tmp_path}/raw", "2024-07-01T00-00-00Z", NOW)
    assert summary["stripe/charges"] == {"fetched": 0, "valid": 0, "errors": 0, "failed": 1}
    assert summary["stripe/customers"]["valid"] == 1


def test_empty_zones(spark, tmp_path):
    assert run_transform(spark, f"{tmp_path}/raw", f"{tmp_path}/out", NOW, "r") == {}
    house, marks = Warehouse(spark, f"{tmp_path}/t"), Watermarks(spark, f"{tmp_path}/w")
    assert run_load(spark, f"{tmp_path}/out", house, marks, "r", NOW) == {}
    assert house.read().count() == 0


def test_json_form(spark, tmp_path):
    unified = transform_records(customers(spark, [("1", "ann", "2024-01-01")]), "stripe", "customers", NOW).unified
    write_json(unified, f"{tmp_path}/json")
    row = read_unified_json(spark, f"{tmp_path}/json").selectExpr("*", "CAST(attributes AS STRING) AS a").first()
    assert row["unified_id"] == "stripe:customer:1" and row["created_at"].startswith("2024-01-01T00:00:00")
    assert row["email"] is None
    back = coerce_records(read_unified_json(spark, f"{tmp_path}/json")).first()
    assert back["is_loadable"] and back["name"] == "Ann"
    assert read_unified(spark, f"{tmp_path}/none") is None


def test_stream_equals_batch_and_resumes(spark, tmp_path):
    def land(run, rows):
        put(f"{tmp_path}/raw/stripe/customers/run_date=20240701/{run}/part-0.json", "\n".join(json.dumps(r) for r in rows))

    house = Warehouse(spark, f"{tmp_path}/t", buckets=2)
    marks = Watermarks(spark, f"{tmp_path}/w")

    def catch_up():
        stream_upsert(
            spark, f"{tmp_path}/raw", "stripe", "customers", house, f"{tmp_path}/cp", NOW, watermarks=marks
        ).awaitTermination()

    land("r1", [{"id": "1", "name": "a", "created": 1700000000}, {"id": "2", "name": "b", "created": 1700000000}])
    catch_up()
    land("r2", [{"id": "2", "name": "bb", "created": 1700000000}, {"id": "3", "name": "c", "created": 1700000100}, 5])
    catch_up()
    catch_up()
    assert {r["source_id"]: r["name"] for r in house.read().collect()} == {"1": "A", "2": "Bb", "3": "C"}
    assert marks.get("stripe", "customers").timestamp() == 1700000100


def test_every_row_is_accounted_for(spark, sf_dir):
    from tributary.queries.registry import QUERIES

    for row in QUERIES["transform_summary"](spark, sf_dir).collect():
        assert row["input"] == row["output"] + row["rejected"] + row["duplicates_removed"]


def test_rows_of_one_row_group_reach_all_tasks(spark, sf_dir, monkeypatch):
    before = sorted(map(tuple, raw_view(spark, sf_dir, "raw_charges").collect()), key=str)
    monkeypatch.setattr("tributary.queries.inputs.FEW_ROWS", 10)
    monkeypatch.setattr("tributary.queries.inputs.TASK_ROWS", 100)
    rows = raw_view(spark, sf_dir, "raw_charges")
    sizes = [r["count"] for r in rows.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 8 and max(sizes) < 200
    assert sorted(map(tuple, rows.collect()), key=str) == before
    assert raw_view(spark, sf_dir, "raw_charges", spread=False).rdd.getNumPartitions() < 8


def test_attributes_are_read_once(spark):
    rows = coerce_records(unified_rows(spark, [("1", "a", None)])).withColumn("attributes", F.lit('{"customer":"c\\"1","livemode":true,"raw_status":null}'))
    out = shown(rows, ("customer", "livemode", "raw_status", "website"))
    assert out.select("attr_customer", "attr_livemode", "attr_raw_status", "attr_website").first() == ('c"1', "true", None, None)
    assert "get_json_object" not in out._jdf.queryExecution().optimizedPlan().toString()


def shuffle_files(spark):
    """Shuffle data on this machine's disk."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return sum(line.endswith(".data") and "shuffle_" in line for line in blocks.split("\n"))


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    """They stayed until the driver collected its garbage, so every step's shuffles filled the disk."""
    rows = coerce_records(unified_rows(spark, [(str(i), "a", None) for i in range(200)])).repartition(3)
    before = shuffle_files(spark)
    write_unified(deduplicate(rows, ["unified_id"]), f"{tmp_path}/zone", rows=200)
    assert shuffle_files(spark) <= before
    assert read_unified(spark, f"{tmp_path}/zone").count() == 200


def test_a_merge_shuffles_its_batch_once(spark, tmp_path, monkeypatch):
    """The dedupe deals the batch to the slices; it was shuffled to them once more."""
    house, plans, merged = Warehouse(spark, f"{tmp_path}/t", buckets=2, slices=3), [], Warehouse.merged

    def seen(self, *args, **options):
        out = merged(self, *args, **options)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(Warehouse, "merged", seen)
    for name in "ab":
        house.upsert(unified_rows(spark, [(str(i), name, None) for i in range(50)]))
    assert [plan.count("Exchange") for plan in plans] == [1, 1]
    assert {r["name"] for r in house.read().collect()} == {"b"} and house.read().count() == 50
    files = [f for _, _, names in os.walk(f"{tmp_path}/t/data") for f in names if f.endswith(".parquet")]
    assert len(files) == 2 * 3


def test_json_form_is_compressed(spark, tmp_path):
    unified = transform_records(customers(spark, [(str(i), "ann", "2024-01-01") for i in range(500)]), "stripe", "customers", NOW).unified
    write_json(unified, f"{tmp_path}/json")
    files = glob.glob(f"{tmp_path}/json/**/part-*", recursive=True)
    assert files and all(f.endswith(".json.gz") for f in files)
    assert read_unified_json(spark, f"{tmp_path}/json").select("unified_id").distinct().count() == 500


def test_extract_lands_compressed_parts_of_bounded_size_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(raw_zone, "SORT_ROWS", 40)
    rows = [(str(i), f"n{i}", "2024-01-01") for i in range(100)]
    given = Records(customers(spark, rows).df.coalesce(1))
    counts = run_extract({("stripe", "customers"): given}, f"{tmp_path}/raw", "2024-07-01T00-00-00Z", NOW)
    assert counts["stripe/customers"]["valid"] == 100
    assert len(glob.glob(f"{tmp_path}/raw/**/part-*.json.gz", recursive=True)) == 3
    for split in (False, True):
        landed = read_raw(spark, f"{tmp_path}/raw", "stripe", "customers", split_files=split)
        ids = [r[0] for r in landed.orderBy(*POSITION).selectExpr("variant_get(record, '$.id', 'string')").collect()]
        assert ids == [r[0] for r in rows]


def test_bounded_parts_are_written_by_tasks_and_replaced_as_a_whole(spark, tmp_path):
    """Spark's writers, which leave a checksum beside each file, took ten milliseconds for a part."""
    rows = spark.range(0, 2000, 1, 2).selectExpr("concat('c', id) AS id", "CAST(NULL AS STRING) AS `a.b`", "id AS `ä`")
    at = (f"{tmp_path}/raw", "stripe", "customers", "2024-07-01T00-00-00Z")
    for _ in range(2):
        path = land_raw(rows, *at, part_records=5)
        names = sorted(os.listdir(path))
        assert 400 <= len([n for n in names if n.endswith(".json")]) <= 404 and "_SUCCESS" in names
        assert not [n for n in names if n.startswith(".part") or n.endswith(".json.crc")]
        with open(f"{path}/{next(n for n in names if n.endswith('.json'))}", encoding="utf-8") as part:
            assert part.read() == "".join(f'{{"id":"c{i}","ä":{i}}}\n' for i in range(5))
    broken = rows.withColumn("id", F.when(F.col("ä") == 1500, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        land_raw(broken, *at, part_records=5)
    assert sorted(os.listdir(path)) == names and [n for n in os.listdir(os.path.dirname(path)) if n[0] == "."] == []


def test_packed_lines_are_those_of_a_scan(spark, tmp_path):
    parts = [b"\xef\xbb\xbf{}\r\n[1]\r{}\n", b"", b"\n\n", b"a\n\nb", b"\xff\xfe\n", "\u2028ä\u0085\x0b\x0c\n".encode(), b"last"]
    for root in ("it's", "a b"):
        os.makedirs(folder := f"{tmp_path}/{root}/stripe/customers/run_date=20240701/2024-07-01T00-00-00Z")
        for i, content in enumerate(parts):
            with open(f"{folder}/part-{i}.json", "wb") as out:
                out.write(content)

    def lines(path):
        return sorted(r[0] for r in spark.read.text(path).selectExpr("hex(value)").collect())

    for root, small in (("it's", packing.SMALL_PART), ("it's", 0), ("a b", packing.SMALL_PART)):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(packing, "SMALL_PART", small)
            assert pack_run(spark, f"{tmp_path}/{root}", f"{tmp_path}/p-{root[0]}{small}", "stripe", "customers", "2024-07-01T00-00-00Z") == 1
        assert lines(f"{tmp_path}/p-{root[0]}{small}/stripe/customers") == lines(f"{tmp_path}/{root}/stripe/customers")
