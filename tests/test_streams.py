"""The stream that keeps the newest version of each key as its state."""

import json
import os
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tributary.queries.inputs import RESOURCES
from tributary.queries.registry import QUERIES
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks
from tributary.streaming.newest import NewestVersion, StreamCounts, stream_newest

NOW = datetime(2024, 7, 1, tzinfo=timezone.utc)


class Feed:
    """Runs of accounts that land one after the other, and the stream that takes them up."""

    def __init__(self, spark, root, **options):
        self.spark, self.root, self.options, self.runs = spark, str(root), options, 0
        self.house = Warehouse(spark, f"{root}/t", buckets=4, slices=2)
        self.counts = StreamCounts()

    def land(self, *rows):
        """(id, name, day of change) rows, others as they are; returns the observed counts."""
        self.runs += 1
        folder = f"{self.root}/raw/salesforce/accounts/run_date=20240701/r{self.runs}"
        os.makedirs(folder)
        records = [
            {"Id": r[0], "Name": r[1], "CreatedDate": "2024-01-01", "LastModifiedDate": r[2]} if isinstance(r, tuple) else r for r in rows
        ]
        with open(f"{folder}/part-0.json", "w", encoding="utf-8") as out:
            out.write("\n".join(map(json.dumps, records)))
        self.spark.streams.addListener(self.counts)
        try:
            query = stream_newest(
                self.spark, f"{self.root}/raw", "salesforce", "accounts", self.house, f"{self.root}/cp", NOW, **self.options
            )
            query.awaitTermination()
            return self.counts.of(query)
        finally:
            self.spark.streams.removeListener(self.counts)

    def names(self):
        return {r["source_id"]: r["name"] for r in self.house.read().collect()}

    def files(self):
        return {f"{folder}/{f}" for folder, _, names in os.walk(f"{self.root}/t/data") for f in names if f.endswith(".parquet")}


def test_late_and_repeated_versions_write_nothing(spark, tmp_path):
    marks = Watermarks(spark, f"{tmp_path}/w")
    feed = Feed(spark, tmp_path, delay="2 days", watermarks=marks, quarantine_root=f"{tmp_path}/q")
    first = [("a", "a5", "2024-03-05"), ("b", "b5", "2024-03-05"), ("c", "c1", "2024-03-01"), {"Name": "no id"}, 7]
    assert feed.land(*first) == {"tagged": {"input": 5, "mapped": 3, "rejected": 2}, "newest": {"passed": 3}}
    before = feed.files()
    # The run again: a and b are known to the state; c has left it, and the table tells that it is the same.
    assert feed.land(*first)["newest"] == {"passed": 1}
    assert feed.files() == before
    # Late versions: of a the state knows better, of c the table does.
    assert feed.land(("a", "a4", "2024-03-04"), ("c", "c0", "2024-02-01"))["newest"] == {"passed": 1}
    assert feed.files() == before and feed.names() == {"a": "A5", "b": "B5", "c": "C1"}
    # A late row of a new key and a late but newer one are not lost; of two versions the newer counts.
    feed.land(("d", "d0", "2024-01-02"), ("c", "c2", "2024-03-02"), ("a", "a6", "2024-03-06"), ("a", "a7", "2024-03-07"))
    assert feed.names() == {"a": "A7", "b": "B5", "c": "C2", "d": "D0"}
    # With the same time the later part wins.
    feed.land(("a", "other", "2024-03-07"))
    assert feed.names()["a"] == "Other"
    assert marks.get("salesforce", "accounts") == datetime(2024, 3, 7, tzinfo=timezone.utc)
    bad = spark.read.option("recursiveFileLookup", True).parquet(f"{tmp_path}/q")
    assert bad.count() == 4 and bad.where("part IS NULL").count() == 0


def test_merge_of_changes_only(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.land(*[(str(i), f"n{i}", "2024-03-01") for i in range(40)])
    before = feed.files()
    same = feed.house.read().withColumn("ingested_at", F.current_timestamp())
    stats = feed.house.upsert(same, decode=False, skip_unchanged=True).first()
    assert (stats["input"], stats["inserted"], stats["updated"]) == (40, 0, 0) and feed.files() == before
    one = same.where("source_id = '7'").withColumn("name", F.lit("changed"))
    assert feed.house.upsert(one, decode=False, skip_unchanged=True).first()["updated"] == 1
    # One of four folders was written.
    assert len(before - feed.files()) == 2 and feed.names()["7"] == "changed"
    older = same.withColumn("updated_at", F.expr("updated_at - INTERVAL 1 DAY")).withColumn("name", F.lit("old"))
    assert feed.house.upsert(older, decode=False, skip_unchanged=True).first()["updated"] == 0
    assert "old" not in feed.names().values()


class FakeState:
    """One group's state and timers, and how often they are asked."""

    def __init__(self):
        self.value, self.timers, self.asked = None, set(), 0

    def getValueState(self, name, schema):  # noqa: N802
        return self

    def get(self):
        self.asked += 1
        return self.value

    def update(self, value):
        self.asked += 1
        self.value = value

    def clear(self):
        self.value = None

    def registerTimer(self, at):  # noqa: N802
        self.timers.add(at)

    def deleteTimer(self, at):  # noqa: N802
        self.timers.remove(at)


class Clock:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):  # noqa: N802
        return self.at

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.at


def test_state_is_asked_once_for_many_keys():
    def version(key, day, part="p1", content=1, stage=None):
        return {"_key": key, "_at": day * 1000, "part": part, "_content": content, "reject_stage": stage}

    state, processor = FakeState(), NewestVersion(["_key", "_at"])
    processor.init(state)
    passed = lambda *rows: sorted((r["_key"], r["_at"] // 1000) for r in processor.handleInputRows((1,), iter(rows), Clock(0)))
    rows = [version(f"k{i}", 10 + i) for i in range(100)] + [version("k5", 3), version("bad", 1, stage="mapping")]
    assert len(passed(*rows)) == 101 and state.asked == 2
    # One timer for the group, where the first version is dropped.
    assert state.timers == {11}
    assert passed(*rows) == [("bad", 1)] and state.timers == {11}
    newer = version("k0", 500), version("k1", 11, part="p2"), version("k2", 12, part="p2", content=2), version("late", 2)
    assert passed(*newer) == [("k0", 500), ("k2", 12), ("late", 2)] and state.timers == {3}
    state.timers.remove(3)
    assert list(processor.handleExpiredTimer((1,), Clock(60), Clock(3))) == [] and state.timers == {61}
    # What is dropped is not known any more, what is left is.
    assert passed(version("k4", 14), version("k90", 100), version("k90", 99)) == [("k4", 14)] and state.timers == {15}
    assert list(processor.handleExpiredTimer((1,), Clock(1000), Clock(15))) == [] and state.value is None


def test_counts_of_every_resource(spark, tmp_path):
    """The query streams each of the five resources, however many rows each has."""
    def keep(name, rows, columns):
        spark.createDataFrame(rows, columns).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    keep("customer", [(k, f"Customer {k}", 1, "BUILDING") for k in (7, 14, 6)], "c_custkey long, c_name string, c_nationkey int, c_mktsegment string")
    keep("orders", [(k, 1, "F", 10.5, "1997-01-01", "5-LOW") for k in (5, 10, 17, 22)],
         "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate string, o_orderpriority string")
    keep("lineitem", [(1, 1, 1, n, 1.0, 2.5, "A", "F", "1997-01-01") for n in range(5)],
         "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_returnflag string, l_linestatus string, l_shipdate string")
    keep("nation", [(1, "FRANCE")], "n_nationkey int, n_name string")
    keep("supplier", [(1, "Supplier 1", 1), (2, "Supplier 2", 1)], "s_suppkey long, s_name string, s_nationkey int")
    keep("part", [(3, "part 3", 4.0)], "p_partkey long, p_name string, p_retailprice double")
    seen = {(r["source"], r["source_resource"]): tuple(r[2:]) for r in QUERIES["stream_counts"](spark, str(tmp_path)).collect()}
    assert set(seen) == set(RESOURCES.values())
    # A customer created at no date, a charge of a negative amount.
    assert seen == {
        ("stripe", "customers"): (3, 2, 1), ("stripe", "charges"): (4, 3, 1), ("stripe", "invoices"): (5, 5, 0),
        ("salesforce", "accounts"): (2, 2, 0), ("salesforce", "opportunities"): (2, 2, 0),
    }
