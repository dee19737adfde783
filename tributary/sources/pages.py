"""Landed pages as a Spark data source: batch with push-down, and a stream by run.

A page is what a source's listing call returns, `{"data": [record, ...], ...}`, one page a line, in the raw zone's folders
`<root>/<source>/<resource>/run_date=YYYYMMDD/<run_id>/`. The source gives a row for each record: run_id, part, page, item (the
input order), event_second and record (the record's own text, as it was landed). Small parts share a task.

`event_second` is the second of the record's time of change, or the largest number where the source cannot tell, so that a
cutoff `event_second >= s` never loses a record; the exact rule is for what reads the record. Lower bounds on it are applied
where the page is read, before a record becomes a row, and comparisons of `run_id` decide which folders are opened. In a stream
the offset is the last run whose landing is complete (it holds `_SUCCESS`); run ids ascend.

Spark 4.1 keeps the bounds it has pushed with the loaded frame and would apply them to later queries of that frame, so
`read_pages` loads a frame for each set of bounds and hands on columns that no other bound can be pushed on.

Workers open the files with pyarrow: local paths and the URIs it knows, such as s3, gs and hdfs.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceStreamReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition,
    LessThan, LessThanOrEqual,
)

from tributary.functions.cells import Records
from tributary.model import STRIPE
from tributary.plans.extract import newer_than
from tributary.sources.raw_zone import landing_dir, run_date_of, unwrapped

FORMAT = "landed_pages"
PAGE_RECORDS = 100
#: Bytes of parts that share a task.
TASK_BYTES = 64 << 20
#: The second of a record whose time the source cannot tell.
UNKNOWN = (1 << 63) - 1
_SCHEMA = "run_id string, part string, page long, item long, event_second long, record string"
_RUN = re.compile(r"/run_date=[^/]+/([^/]+)/")
_SPACE = re.compile(r"[ \t\n\r]*")
_BATCH = 10_000


# --- pages ------------------------------------------------------------------------------------------


def page_records(page: str) -> Iterator[tuple[str, object]]:
    """Text and value of each record of a page; an object without a list of data has none, all else is an error."""
    decoder = json.JSONDecoder()

    def skip(at: int) -> int:
        return _SPACE.match(page, at).end()

    at = skip(0)
    if page[at:at + 1] != "{":
        raise ValueError("not a page")
    at = skip(at + 1)
    while page[at:at + 1] == '"':
        key, at = decoder.raw_decode(page, at)
        at = skip(skip(at) + 1)
        if key == "data" and page[at:at + 1] == "[":
            at = skip(at + 1)
            while page[at:at + 1] != "]":
                value, end = decoder.raw_decode(page, at)
                yield page[at:end], value
                at = skip(end)
                at = skip(at + 1) if page[at:at + 1] == "," else at
            return
        at = skip(decoder.raw_decode(page, at)[1])
        at = skip(at + 1) if page[at:at + 1] == "," else at


def event_second(value: object, fields: Sequence[str]) -> int:
    """The second of the first of the fields that is there: epoch numbers in seconds or milliseconds, or ISO-8601."""
    found = next((value[f] for f in fields if value.get(f) is not None), None) if isinstance(value, dict) else None
    if isinstance(found, str) and re.fullmatch(r"\d{10}|\d{13}", found):
        found = int(found)
    if isinstance(found, int) and not isinstance(found, bool):
        return found // 1000 if abs(found) > 10**11 else found
    if isinstance(found, str) and re.match(r"\d{4}-\d\d-\d\d", found):
        try:
            moment = datetime.fromisoformat(found)
        except ValueError:
            return UNKNOWN
        return int((moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).timestamp() // 1)
    return UNKNOWN


# --- the source -------------------------------------------------------------------------------------


@dataclass
class Parts(InputPartition):
    """Parts that one task reads, and the bound on their records."""

    files: list[tuple[str, str]]
    least: int | None = None


@dataclass
class Folder:
    """Where the pages of a resource lie, and which of a record's fields tell its time."""

    path: str
    fields: list[str]
    task_bytes: int

    def open(self) -> tuple[fs.FileSystem, str]:
        if "://" in self.path:
            return fs.FileSystem.from_uri(self.path)
        return fs.LocalFileSystem(), self.path.removeprefix("file:")

    def parts(self) -> dict[str, list[fs.FileInfo]]:
        """The parts of each run whose landing is complete."""
        system, path = self.open()
        runs: dict[str, list[fs.FileInfo]] = {}
        complete = set()
        for info in system.get_file_info(fs.FileSelector(path, recursive=True, allow_not_found=True)):
            run = _RUN.search(info.path)
            if run and info.is_file and info.base_name == "_SUCCESS":
                complete.add(run[1])
            elif run and info.is_file and not info.base_name.startswith(("_", ".")):
                runs.setdefault(run[1], []).append(info)
        return {run: sorted(runs.get(run, []), key=lambda i: i.path) for run in sorted(complete)}

    def tasks(self, runs: dict[str, list[fs.FileInfo]], least: int | None = None) -> list[Parts]:
        tasks, held = [], self.task_bytes
        for run, infos in runs.items():
            for info in infos:
                if held + info.size > self.task_bytes:
                    tasks.append(Parts([], least))
                    held = 0
                tasks[-1].files.append((run, info.path))
                held += info.size
        # Without a task Spark would ask for one of its own.
        return tasks or [Parts([], least)]

    def read(self, task: Parts) -> Iterator[pa.RecordBatch]:
        system, _ = self.open()
        rows: list[tuple] = []
        for run, path in task.files:
            with system.open_input_stream(path) as stream:
                for page, line in enumerate(_lines(stream)):
                    try:
                        for item, (text, value) in enumerate(page_records(line)):
                            second = event_second(value, self.fields)
                            if task.least is None or second >= task.least:
                                rows.append((run, path, page, item, second, text))
                    except ValueError:
                        # What cannot be read stays visible as a record that is no JSON.
                        rows.append((run, path, page, -1, UNKNOWN, line))
                    if len(rows) >= _BATCH:
                        yield _batch(rows)
                        rows = []
        if rows:
            yield _batch(rows)


def _lines(stream: pa.NativeFile) -> Iterator[str]:
    """Lines of a file, some megabytes in memory at a time."""
    rest = b""
    while chunk := stream.read(4 << 20):
        *whole, rest = (rest + chunk).split(b"\n")
        for line in whole:
            if line.strip():
                yield line.decode("utf-8", "replace")
    if rest.strip():
        yield rest.decode("utf-8", "replace")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    names = ["run_id", "part", "page", "item", "event_second", "record"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


class PagesReader(DataSourceReader):
    def __init__(self, folder: Folder) -> None:
        self.folder = folder
        self.least: int | None = None
        self.runs: list[tuple[str, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        comparisons = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<=", In: "in"}
        for f in filters:
            if isinstance(f, (GreaterThan, GreaterThanOrEqual)) and f.attribute == ("event_second",):
                bound = f.value + isinstance(f, GreaterThan)
                self.least = bound if self.least is None else max(self.least, bound)
            elif type(f) in comparisons and f.attribute == ("run_id",):
                self.runs.append((comparisons[type(f)], f.value))
            else:
                yield f

    def _wanted(self, run: str) -> bool:
        tests = {
            "=": lambda v: run == v, ">": lambda v: run > v, ">=": lambda v: run >= v, "<": lambda v: run < v, "<=": lambda v: run <= v,
            "in": lambda v: run in v,
        }
        return all(tests[op](value) for op, value in self.runs)

    def partitions(self) -> list[Parts]:
        return self.folder.tasks({run: infos for run, infos in self.folder.parts().items() if self._wanted(run)}, self.least)

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        yield from self.folder.read(partition)


class PagesStream(DataSourceStreamReader):
    def __init__(self, folder: Folder) -> None:
        self.folder = folder

    def initialOffset(self) -> dict:  # noqa: N802
        return {"run": ""}

    def latestOffset(self) -> dict:  # noqa: N802
        return {"run": max(self.folder.parts(), default="")}

    def partitions(self, start: dict, end: dict) -> list[Parts]:
        return self.folder.tasks({run: infos for run, infos in self.folder.parts().items() if start["run"] < run <= end["run"]})

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        yield from self.folder.read(partition)


class LandedPages(DataSource):
    """Options: `path`, the folder of a resource; `fields`, its time fields; `taskBytes`."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return _SCHEMA

    def _folder(self) -> Folder:
        return Folder(self.options["path"].rstrip("/"), self.options.get("fields", "created").split(","), int(self.options.get("taskBytes", TASK_BYTES)))

    def reader(self, schema) -> PagesReader:
        return PagesReader(self._folder())

    def streamReader(self, schema) -> PagesStream:  # noqa: N802
        return PagesStream(self._folder())


# --- use --------------------------------------------------------------------------------------------


def _options(root: str, source: str, resource: str, task_bytes: int) -> dict[str, str]:
    fields = "created" if source == STRIPE else "LastModifiedDate,last_modified_date"
    return {"path": f"{root.rstrip('/')}/{source}/{resource}", "fields": fields, "taskBytes": str(task_bytes)}


def register(spark: SparkSession) -> None:
    spark.dataSource.register(LandedPages)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_pages(
    spark: SparkSession, root: str, source: str, resource: str, *, since: datetime | None = None,
    first_run: str | None = None, last_run: str | None = None, task_bytes: int = TASK_BYTES,
) -> DataFrame:
    """Records strictly after the cutoff, envelopes taken off: run_id, part, page, item, raw, record.

    `first_run` and `last_run` bound the runs that are read, both included.

    The cutoff reaches the scan in whole seconds; the exact rule, the one of `newer_than`, runs on what the scan lets through.
    """
    register(spark)
    rows = spark.read.format(FORMAT).options(**_options(root, source, resource, task_bytes)).load()
    if since is not None:
        rows = rows.where(F.col("event_second") >= int(since.timestamp() // 1))
    if first_run is not None:
        rows = rows.where(F.col("run_id") >= first_run)
    if last_run is not None:
        rows = rows.where(F.col("run_id") <= last_run)
    records = _parsed(rows)
    if since is not None:
        records = newer_than(Records(records, "record"), source, since).df
    return records


def stream_pages(spark: SparkSession, root: str, source: str, resource: str, *, task_bytes: int = TASK_BYTES) -> DataFrame:
    """The records of all runs, each as its landing is complete."""
    register(spark)
    return _parsed(spark.readStream.format(FORMAT).options(**_options(root, source, resource, task_bytes)).load())


def _parsed(rows: DataFrame) -> DataFrame:
    run = F.concat("run_id", F.lit("")).alias("run_id")
    return unwrapped(rows.select(run, "part", "page", "item", F.try_parse_json("record").alias("raw")))


def land_pages(
    records: DataFrame, root: str, source: str, resource: str, run_id: str, *, page_records: int = PAGE_RECORDS
) -> str:
    """Write one run of one resource as pages; running it again replaces the run's parts."""
    spark = records.sparkSession
    path = landing_dir(root, source, resource, run_id, run_date_of(spark, run_id))
    numbered = records.select(F.monotonically_increasing_id().alias("_id"), F.to_json(F.struct(*records.columns)).alias("_text"))
    pages = numbered.groupBy((F.col("_id") / page_records).cast("long")).agg(F.array_sort(F.collect_list(F.struct("_id", "_text"))).alias("_page"))
    text = F.concat(F.lit('{"object":"list","data":['), F.expr("array_join(transform(_page, x -> x._text), ',')"), F.lit("]}"))
    pages.select(text.alias("value")).write.mode("overwrite").text(path)
    return path
