"""Many small raw parts packed into few large ones, run by run.

Sources hand over pages, so a run may land as thousands of files of some kilobytes, and reading them costs more in opening
than in bytes. Packing lists the parts of a run with their sizes, deals them to bins in their order, and writes one part for
each bin, lines in input order. Bins follow from names and sizes alone and the run's folder is replaced as a whole, so packing
a run again gives the same parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.session import NO_SHUFFLE_LEFT, discard, scratch_path, settings
from tributary.sources.raw_zone import landing_dir, opened, run_date_of

#: Bytes of a packed part, about: a bin is closed by the part that fills it.
PART_BYTES = 128 << 20
#: Bytes of the largest part that a task reads at once. Runs that hold larger or compressed ones are read by Spark's scan.
SMALL_PART = 16 << 20
#: So are those whose paths Spark escapes, as pyarrow takes them as they are.
_ODD = r"%|\.(gz|bz2|deflate|zst|zstd|lz4|snappy)$"
#: A scan counts a file as some MB, so a task would read a few dozen small parts, and the tasks cost more than the parts.
_MANY_FILES = {"spark.sql.files.openCostInBytes": str(64 << 10)}
#: Packed parts are text; `read_raw` finds them with this glob.
GLOB = "*.txt"


def bins(parts: DataFrame, part_bytes: int = PART_BYTES) -> DataFrame:
    """The bin of each part (path, length), in the order of their paths. One row for each file passes the running sum."""
    before = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(before), F.lit(0))
    return parts.select("path", "length", F.floor(start / part_bytes).cast("int").alias("bin"))


def _lines_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines of whole parts, as Spark reads them; a scan takes some milliseconds to open one."""
    for batch in batches:
        for path in batch.column(0).to_pylist():
            system, place = opened(path)
            with system.open_input_stream(place, compression=None) as part:
                lines = re.split(rb"\r\n|\n|\r", part.read().removeprefix(b"\xef\xbb\xbf"))
            if not lines[-1]:
                lines.pop()
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, pa.binary())], ["value"])


def pack_run(
    spark: SparkSession, raw_root: str, packed_root: str, source: str, resource: str, run_id: str, *,
    part_bytes: int = PART_BYTES, glob: str = "*.json*",
) -> int | None:
    """Pack the parts of one landed run; returns how many there are now, or None when the run has landed nothing."""
    folder = landing_dir(raw_root, source, resource, run_id, run_date_of(spark, run_id))
    try:
        reader = spark.read.option("pathGlobFilter", glob)
        parts = reader.format("binaryFile").load(folder).select("_metadata.file_path", "length").toDF("path", "length")
    except AnalysisException:
        return None
    out = landing_dir(packed_root, source, resource, run_id, run_date_of(spark, run_id))
    staged = scratch_path(spark, "bins")
    try:
        with settings(spark, {**_MANY_FILES, **NO_SHUFFLE_LEFT}):
            # Written once, as every look at the parts asks the file system for each of them.
            bins(parts, part_bytes).write.parquet(staged)
            dealt = spark.read.schema("path string, length long, bin int").parquet(staged)
            last, odd = dealt.agg(F.max("bin"), F.max((F.col("length") > SMALL_PART) | F.col("path").rlike(_ODD))).first()
            if last is None:
                return None
            if odd or not opened(folder):
                lines = spark.read.option("pathGlobFilter", glob).text(folder).select(
                    "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("line"),
                )
                packed = lines.join(dealt, "path").repartitionById(last + 1, F.col("bin")).sortWithinPartitions("path", "block", "line")
            else:
                packed = dealt.repartitionById(last + 1, F.col("bin")).sortWithinPartitions("path").select("path")
                packed = packed.mapInArrow(_lines_of, "value binary").withColumn("value", F.col("value").cast("string"))
            packed.select("value").write.mode("overwrite").text(out)
    finally:
        discard(spark, staged)
    return last + 1
