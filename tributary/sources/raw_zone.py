"""The raw zone: JSON parts under `<root>/<source>/<resource>/run_date=YYYYMMDD/<run_id>/`.

Parts are JSON Lines when written here. Parts that hold one JSON array or one object on a line are
read as well. `whole_files=True` reads parts that are spread over several lines, each in one task;
`split_files=True` reads such parts of any size, many tasks to a part.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.cells import in_brackets, quote, strict_json
from tributary.functions.cells import name as column_name
from tributary.functions.keys import run_date
from tributary.model import SOURCES
from tributary.operators.envelope import unwrap
from tributary.operators.mapping import MAPPINGS
from tributary.session import NO_SHUFFLE_LEFT, PACKED_TEXT, SORT_ROWS, discard, file_system, settings
from tributary.sources.json_arrays import split_records

# Input order of a record, most significant first: part paths sort by run, then place in the part.
POSITION = ("part", "block", "line", "item")

PART_RECORDS = 1000
#: Parts of bounded size a task writes, about; names of a task's parts sort up to 1000.
TASK_PARTS = 100
_RESOURCE_DIR = r"^/([^/]+)/([^/]+)/"
_GLOB = "*.json*"
_PLACE = "_place_in_run"


def _select(sources: Iterable[str] | None, resources: Iterable[str] | None) -> list[tuple[str, str]]:
    return [
        (source, resource)
        for source, resource in sorted(MAPPINGS)
        if (sources is None or source in set(sources)) and (resources is None or resource in set(resources))
    ]


def find_raw_parts(spark: SparkSession, root: str, source: str | None = None) -> DataFrame:
    """Every part of a known source: source, resource, path, and whether the resource has a mapping.

    Only file names are listed; no content is read. A missing root gives no rows.
    """
    base = root.rstrip("/")
    try:
        files = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", True).option("pathGlobFilter", _GLOB)
            .load(base).select("path", "length")
        )
    except AnalysisException:
        return spark.createDataFrame([], "source string, resource string, path string, length bigint, is_mapped boolean")
    below_root = F.regexp_replace("path", "^[a-z0-9]+:(//[^/]*)?(?=/)", "")
    tail = F.expr("substring(_below, length(_root) + 1)")
    plain_root = base.split("://", 1)[-1] if "://" in base else base.removeprefix("file:")
    found = (
        files.withColumn("_below", below_root).withColumn("_root", F.lit(plain_root))
        .withColumn("_tail", tail)
        .select(
            F.regexp_extract("_tail", _RESOURCE_DIR, 1).alias("source"),
            F.regexp_extract("_tail", _RESOURCE_DIR, 2).alias("resource"),
            "path", "length",
        )
        .where(F.col("source").isin(*([source] if source else SOURCES)) & F.col("source").isin(*SOURCES))
    )
    mapped = F.concat_ws("/", "source", "resource").isin(*[f"{s}/{r}" for s, r in MAPPINGS])
    return found.withColumn("is_mapped", mapped)


def _lines(spark: SparkSession, path: str, whole_files: bool, glob: str = _GLOB) -> DataFrame | None:
    try:
        return (
            spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
            .text(path, wholetext=whole_files)
            .select("value", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("block"))
        )
    except AnalysisException:
        return None


def explode_records(lines: DataFrame, *, numbered: bool = True) -> DataFrame:
    """One row per array element, or one row for any other value; blank lines hold nothing.

    `raw` is a VARIANT, null when the text is not JSON. `line` and `item` keep the input order. Lines are numbered
    unless they are already, or are a stream, whose lines have no numbers: `line` is null there.
    """
    if lines.isStreaming:
        lines = lines.withColumn("line", F.lit(None).cast("long"))
    elif numbered:
        lines = lines.withColumn("line", F.monotonically_increasing_id())
    return (
        lines.where(F.trim("value") != "")
        .selectExpr("part", "block", "line", f"try_parse_json({in_brackets('value')}) AS _bracketed")
        .selectExpr("part", "block", "line", f"{strict_json('_bracketed')} AS _parsed")
        .select(
            "part", "block", "line",
            F.posexplode(
                F.coalesce(F.try_variant_get("_parsed", "$", "array<variant>"), F.array("_parsed"))
            ).alias("item", "raw"),
        )
    )


def unwrapped(records: DataFrame) -> DataFrame:
    """The same records with `record`, the payload without its envelope."""
    return records.selectExpr("*", f"{unwrap('raw')} AS record")


def read_raw(
    spark: SparkSession,
    root: str,
    source: str,
    resource: str,
    *,
    run_id: str | None = None,
    whole_files: bool = False,
    split_files: bool = False,
    glob: str = _GLOB,
) -> DataFrame | None:
    """Records of one resource with envelopes taken off, or None when nothing has landed.

    `run_id` reads the parts of that run only, `glob` names the files that are parts. Columns: part, block, line, item (the input order),
    raw, record.
    """
    base = f"{root.rstrip('/')}/{source}/{resource}"
    path = f"{base}/run_date=*/{run_id}" if run_id else base
    lines = split_records(spark, path, glob) if split_files else _lines(spark, path, whole_files, glob)
    if lines is None:
        return None
    return unwrapped(explode_records(lines, numbered=not split_files))


def read_raw_zone(
    spark: SparkSession,
    root: str,
    sources: Iterable[str] | None = None,
    resources: Iterable[str] | None = None,
    *,
    run_id: str | None = None,
    whole_files: bool = False,
    split_files: bool = False,
) -> dict[tuple[str, str], DataFrame]:
    """The landed records of every selected resource; each reads its own directory only."""
    landed = {}
    for source, resource in _select(sources, resources):
        records = read_raw(spark, root, source, resource, run_id=run_id, whole_files=whole_files, split_files=split_files)
        if records is not None:
            landed[(source, resource)] = records
    return landed


def landing_dir(root: str, source: str, resource: str, run_id: str, date: str) -> str:
    return f"{root.rstrip('/')}/{source}/{resource}/run_date={date}/{run_id}"


def run_date_of(spark: SparkSession, run_id: str) -> str:
    """The YYYYMMDD partition of a run id."""
    return spark.range(1).selectExpr(f"{run_date(quote(run_id), 'current_timestamp()')} AS d").first()["d"]


def _in_tasks(records: DataFrame, task_records: int) -> DataFrame:
    """The same records in the same order, about so many to a task."""
    tasks = -(-records.count() // task_records)
    if tasks <= 1:
        return records
    placed = records.withColumn(_PLACE, F.monotonically_increasing_id())
    return placed.repartitionByRange(tasks, _PLACE).sortWithinPartitions(_PLACE).drop(_PLACE)


def opened(path: str) -> tuple[fs.FileSystem, str] | None:
    """The file system of a path as workers open it with pyarrow, and the path there; None if pyarrow does not know it."""
    try:
        return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path.removeprefix("file:"))
    except (pa.ArrowException, OSError, ValueError):
        return None


def _write_parts(records: DataFrame, path: str, part_records: int) -> None:
    """JSON Lines parts of at most so many records, named by task and place in it, in place of what the folder holds.

    Spark's writers take some ten milliseconds for a file, which small parts do not repay, so tasks open the parts
    themselves. A part gets its name once it is whole, and a task that runs again writes the same parts, as its records
    are in a fixed order. The folder takes its place once all of them are there.
    """
    spark, name = records.sparkSession, path.rsplit("/", 1)[-1]
    landing = f"{path.removesuffix(name)}.{name}-{uuid.uuid4().hex}"
    hadoop, folder = file_system(spark, landing)
    hadoop.mkdirs(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = opened(landing)
        task, number, held = TaskContext.get().partitionId(), 0, []

        def put(lines: list[str]) -> None:
            part, attempt = f"part-{task:05}-c{number:03}.json", uuid.uuid4().hex
            with system.open_output_stream(f"{base}/.{part}-{attempt}") as out:
                out.write("".join(f"{line}\n" for line in lines).encode())
            system.move(f"{base}/.{part}-{attempt}", f"{base}/{part}")

        for batch in batches:
            held += batch.column(0).to_pylist()
            whole = len(held) - len(held) % part_records
            for start in range(0, whole, part_records):
                put(held[start:start + part_records])
                number += 1
            del held[:whole]
        if held:
            put(held)
        yield pa.RecordBatch.from_pydict({"parts": pa.array([number + bool(held)], pa.int64())})

    try:
        lines = records.select(F.to_json(F.struct(*[F.col(column_name(c)) for c in records.columns])).alias("value"))
        with settings(spark, NO_SHUFFLE_LEFT):
            lines.mapInArrow(run, "parts long").agg(F.sum("parts")).collect()
        hadoop.create(file_system(spark, f"{landing}/_SUCCESS")[1]).close()
        discard(spark, path)
        if not hadoop.rename(folder, file_system(spark, path)[1]):
            raise OSError(f"{landing} could not take the place of {path}")
    except BaseException:
        discard(spark, landing)
        raise


def land_raw(
    records: DataFrame,
    root: str,
    source: str,
    resource: str,
    run_id: str,
    *,
    part_records: int | None = None,
    packed: bool = False,
) -> str:
    """Write one run of one resource as JSON Lines; running it again replaces the run's parts.

    `part_records` bounds the records of a part (`PART_RECORDS` is the customary bound); the records are then dealt
    to tasks, in their order, as a part costs more to open than to fill. Without it a task writes one part, which
    keeps the number of files in proportion to the data. `packed` compresses the parts and, as a scan cannot cut such a
    part, bounds their records too; a task then writes several, in order.
    """
    spark = records.sparkSession
    path = landing_dir(root, source, resource, run_id, run_date_of(spark, run_id))
    if part_records:
        dealt = _in_tasks(records, part_records * TASK_PARTS)
        # Only what is dealt is in an order of its own; a percent sign in a path means another one to pyarrow.
        if dealt is not records and not packed and "%" not in path and opened(path):
            _write_parts(dealt, path, part_records)
            return path
        records = dealt
    writer = records.write.mode("overwrite")
    if packed:
        writer = writer.options(**PACKED_TEXT, maxRecordsPerFile=SORT_ROWS)
    if part_records:
        writer = writer.option("maxRecordsPerFile", part_records)
    writer.json(path)
    return path
