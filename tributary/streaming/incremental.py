"""New raw parts into the warehouse with a file stream; the checkpoint is the high-water mark.

The stream only names the parts that are new. Each micro-batch is then an ordinary batch: parse, map,
deduplicate, merge. The merge is idempotent, so a batch that is replayed after a failure changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.functions.cells import Records
from tributary.operators.mapping import ResourceMapping, accepted, get_mapping, map_records, rejected
from tributary.operators.summaries import event_time_marks
from tributary.plans.transform import newest_per_key
from tributary.session import discard, prepare, scratch_path
from tributary.sources.raw_zone import POSITION, explode_records, unwrapped
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks


def merge_batch(
    warehouse: Warehouse,
    mapping: ResourceMapping,
    ingested_at: datetime,
    watermarks: Watermarks | None = None,
    quarantine_root: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """A `foreachBatch` function that merges the lines of one micro-batch."""

    def merge(lines: DataFrame, batch: int) -> None:
        spark = lines.sparkSession
        records = unwrapped(explode_records(lines))
        path = scratch_path(spark, "microbatch")
        map_records(Records(records, "record"), mapping, ingested_at, keep=POSITION).write.parquet(path)
        tagged = spark.read.parquet(path)
        unified = newest_per_key(accepted(tagged), POSITION).drop(*POSITION)
        warehouse.upsert(unified, decode=False, stage=False)
        if watermarks is not None:
            watermarks.set(event_time_marks(accepted(tagged)), f"batch-{batch}", ingested_at)
        if quarantine_root:
            (
                rejected(tagged, keep=POSITION).write.mode("overwrite")
                .parquet(f"{quarantine_root.rstrip('/')}/stream/{'/'.join(mapping.origin)}/batch={batch}")
            )
        discard(spark, path)

    return merge


def stream_upsert(
    spark: SparkSession,
    raw_root: str,
    source: str,
    resource: str,
    warehouse: Warehouse,
    checkpoint: str,
    ingested_at: datetime,
    *,
    mapping: ResourceMapping | None = None,
    watermarks: Watermarks | None = None,
    quarantine_root: str | None = None,
    files_per_batch: int | None = None,
    whole_files: bool = False,
) -> StreamingQuery:
    """Merge every part that has landed since the checkpoint, then stop."""
    prepare(spark)
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(f"{raw_root.rstrip('/')}/{source}/{resource}", wholetext=whole_files).select(
        "value", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("block")
    )
    merge = merge_batch(
        warehouse, mapping or get_mapping(source, resource), ingested_at, watermarks, quarantine_root
    )
    return (
        lines.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
