"""Transform stage: raw records of every resource onto the unified schema, deduplicated, in one zone."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.cells import Records
from tributary.operators.dedupe import deduplicate
from tributary.operators.mapping import ResourceMapping, accepted, get_mapping, map_records, rejected
from tributary.operators.summaries import transform_summary
from tributary.session import SMALL_ROW_GROUPS, discard, prepare, scratch_path
from tributary.sources.processed_zone import read_unified, write_unified
from tributary.sources.quarantine import write_quarantine
from tributary.sources.raw_zone import POSITION, find_raw_parts, read_raw_zone

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Transformed:
    """The outcome for one resource or several. Frames are built when they are asked for."""

    tagged: DataFrame
    position: tuple[str, ...] = ()

    @property
    def unified(self) -> DataFrame:
        return newest_per_key(accepted(self.tagged), self.position).drop(*self.position)

    @property
    def rejected(self) -> DataFrame:
        return rejected(self.tagged, keep=self.position)

    @property
    def stats(self) -> DataFrame:
        return transform_summary(self.tagged)


def newest_per_key(rows: DataFrame, position: Iterable[str] = ()) -> DataFrame:
    """One row per key within a resource: the last update, and among equals the last in input order."""
    return deduplicate(rows, ["source", "source_resource", "unified_id"], "updated_at", list(position))


def transform_records(
    records: Records,
    source: str,
    resource: str,
    ingested_at: datetime,
    *,
    mapping: ResourceMapping | None = None,
    position: tuple[str, ...] = (),
) -> Transformed:
    """Map, validate and deduplicate the records of one resource."""
    tagged = map_records(records, mapping or get_mapping(source, resource), ingested_at, keep=position)
    return Transformed(tagged, position)


def union_all(frames: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def tag_zone(
    zone: Mapping[tuple[str, str], DataFrame],
    ingested_at: datetime,
    mappings: Mapping[tuple[str, str], ResourceMapping] | None = None,
) -> DataFrame:
    """The mapped rows of every landed resource; each resource is a branch with its own projection."""
    custom = mappings or {}
    return union_all(
        map_records(
            Records(records, "record"), custom.get(key) or get_mapping(*key), ingested_at, keep=POSITION
        )
        for key, records in zone.items()
    )


def run_transform(
    spark: SparkSession,
    raw_root: str,
    out_root: str,
    ingested_at: datetime,
    run_id: str,
    *,
    sources: Iterable[str] | None = None,
    resources: Iterable[str] | None = None,
    mappings: Mapping[tuple[str, str], ResourceMapping] | None = None,
    quarantine_root: str | None = None,
    only_this_run: bool = False,
    whole_files: bool = False,
    split_files: bool = False,
    also_json: bool = False,
) -> dict[str, dict[str, int]]:
    """Transform the raw zone into the processed zone; returns counts per `source/resource`.

    `only_this_run` reads what `run_id` has landed instead of the whole zone. `mappings` replaces the mapping
    of some resources. JSON is parsed once: the tagged rows go to a Parquet table by resource, and the zone,
    the quarantine and the counts are made from it.
    """
    prepare(spark)
    for part in find_raw_parts(spark, raw_root).where("NOT is_mapped").select("source", "resource").distinct().collect():
        log.warning("%s/%s has no mapping, skipped", part["source"], part["resource"])
    zone = read_raw_zone(
        spark, raw_root, sources, resources, run_id=run_id if only_this_run else None, whole_files=whole_files,
        split_files=split_files,
    )
    if not zone:
        log.warning("nothing has landed under %s", raw_root)
        return {}
    staged_path = scratch_path(spark, "tagged")
    tagged = tag_zone(zone, ingested_at, mappings)
    tagged.write.options(**SMALL_ROW_GROUPS).partitionBy("source", "source_resource").parquet(staged_path)
    staged = spark.read.schema(tagged.schema).parquet(staged_path)
    # One dedupe per resource, so a shuffle is sized for its own resource and writes only its files.
    unified = union_all(
        newest_per_key(
            accepted(staged.where((F.col("source") == source) & (F.col("source_resource") == resource))), POSITION
        ).drop(*POSITION)
        for source, resource in zone
    )
    write_unified(unified, out_root, also_json=also_json, rows=staged.count())
    if quarantine_root:
        write_quarantine(rejected(staged, keep=POSITION), quarantine_root, run_id, "transform")
    stats = _run_stats(staged, read_unified(spark, out_root))
    discard(spark, staged_path)
    return stats


def _run_stats(staged: DataFrame, written: DataFrame | None) -> dict[str, dict[str, int]]:
    """Counts per `source/resource`. Keys are not grouped again: the zone holds what the dedupe has left."""
    key = ("source", "source_resource")
    tagged = staged.groupBy(*key).agg(
        F.count(F.lit(1)).alias("input"), F.count(F.when(F.col("reject_stage").isNull(), 1)).alias("mapped")
    ).collect()
    output = {} if written is None else {tuple(r[:2]): r["count"] for r in written.groupBy(*key).count().collect()}
    stats = {}
    for row in tagged:
        # A resource without a good row has written nothing; its partition is an earlier run's.
        left = output.get(tuple(row[:2]), 0) if row["mapped"] else 0
        stats["/".join(row[:2])] = {
            "input": row["input"], "mapped": row["mapped"], "rejected": row["input"] - row["mapped"],
            "duplicates_removed": row["mapped"] - left, "output": left,
        }
    return stats
