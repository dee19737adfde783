"""Raw records as shredded VARIANT."""

import glob
import json
from datetime import datetime, timezone

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from tributary.sources.raw_archive import archive, picked_since, read_archive

RUN = "2024-07-01T00-00-00Z"


def records(spark, payloads):
    rows = [("p", 0, i, 0, p) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "part string, block long, line long, item int, j string").withColumn("record", F.try_parse_json("j"))


def test_fields_are_columns_and_records_stay_whole(spark, tmp_path):
    payloads = [json.dumps({"id": str(i), "created": 1700000000 + i, "note": f"{i} " * 200, "deep": {"x": i}}) for i in range(500)]
    odd = ['{"id": 7, "created": "2023-11-14T22:13:20Z"}', '{"created": null}', "[1, 2]", '"text"', None, '{"id": {"a": [true]}, "created": 1700000001500}']
    given = records(spark, payloads + odd)
    path = archive(given, str(tmp_path), "stripe", "customers", RUN)
    back = read_archive(spark, str(tmp_path), "stripe", "customers", run_id=RUN)
    whole = [r["j"] for r in back.orderBy("line").selectExpr("to_json(record) AS j").collect()]
    assert whole == [r["j"] for r in given.orderBy("line").selectExpr("to_json(record) AS j").collect()]
    sizes = {}
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        for group in range(meta.num_row_groups):
            for i in range(meta.num_columns):
                column = meta.row_group(group).column(i)
                sizes[column.path_in_schema] = sizes.get(column.path_in_schema, 0) + column.total_compressed_size
    picked = {p: n for p, n in sizes.items() if ".created." in p or ".id." in p}
    assert picked and sum(picked.values()) < 0.5 * sum(sizes.values())
    for cutoff in (None, datetime.fromtimestamp(1700000000, timezone.utc), datetime.fromtimestamp(1700000450, timezone.utc)):
        found = picked_since(back, "stripe", cutoff, {"id": "id", "x": "deep.x"})
        plan = found._jdf.queryExecution().executedPlan().toString()
        # Only picked fields are asked of the files, none of them the record as a whole.
        assert "record:struct<" in plan and "record:variant" not in plan
        second = None if cutoff is None else int(cutoff.timestamp())
        expected = [(str(i), str(i)) for i in range(500) if second is None or 1700000000 + i > second]
        if second is None:
            expected += [("7", None), (None, None), (None, None), (None, None), (None, None), ('{"a":[true]}', None)]
        elif second < 1700000001:
            expected += [('{"a":[true]}', None)]
        assert sorted(map(str, [(r["id"], r["x"]) for r in found.collect()])) == sorted(map(str, expected))


def test_nothing_archived(spark, tmp_path):
    assert read_archive(spark, str(tmp_path), "stripe", "customers") is None
