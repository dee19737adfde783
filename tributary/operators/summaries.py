"""Counts per resource. All are partial aggregates on a handful of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.keys import timestamp_literal

_RESOURCE = ("source", "source_resource")


def transform_summary(tagged: DataFrame) -> DataFrame:
    """Input, mapped, rejected, duplicates removed and output rows of each resource.

    Rows are first counted per key, on both sides of the shuffle, so a hot key moves as one count.
    Rejected rows are counted by themselves and do not take part in the key grouping.
    """
    good = F.col("reject_stage").isNull()
    per_key = tagged.groupBy(*_RESOURCE, F.when(good, F.col("unified_id")).alias("_key"), good.alias("_good")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    mapped = F.coalesce(F.sum(F.when(F.col("_good"), F.col("_n"))), F.lit(0))
    output = F.count(F.when(F.col("_good"), 1))
    return per_key.groupBy(*_RESOURCE).agg(
        F.sum("_n").alias("input"),
        mapped.alias("mapped"),
        F.coalesce(F.sum(F.when(~F.col("_good"), F.col("_n"))), F.lit(0)).alias("rejected"),
        (mapped - output).alias("duplicates_removed"),
        output.alias("output"),
    )


def extraction_summary(validated: DataFrame) -> DataFrame:
    """Fetched, valid and quarantined rows of each resource; needs `source`, `resource`, `is_valid`.

    Rows that were fetched tell nothing of resources that failed; `run_summary` has those.
    """
    return validated.groupBy("source", "resource").agg(
        F.count(F.lit(1)).alias("fetched"),
        F.count(F.when(F.col("is_valid"), 1)).alias("valid"),
        F.count(F.when(~F.col("is_valid"), 1)).alias("errors"),
        F.lit(0).cast("bigint").alias("failed"),
    )


def run_summary(spark: SparkSession, results: dict[str, dict[str, int]]) -> DataFrame:
    """What `run_extract` reports, as a frame: one row for each resource, failed ones included."""
    rows = [(*key.split("/"), *(counts[c] for c in ("fetched", "valid", "errors", "failed"))) for key, counts in results.items()]
    return spark.createDataFrame(rows, "source string, resource string, fetched long, valid long, errors long, failed long")


def event_time_marks(unified: DataFrame) -> DataFrame:
    """The latest creation or update of each resource: its high-water mark."""
    return unified.groupBy("source", F.col("source_resource").alias("resource")).agg(
        F.max(F.greatest("updated_at", "created_at")).alias("high_water_mark")
    )


def since(df: DataFrame, column: str, cutoff) -> DataFrame:
    """Rows strictly after the cutoff; a plain comparison, so it reaches the Parquet scan."""
    mark = cutoff if isinstance(cutoff, Column) else F.expr(timestamp_literal(cutoff))
    return df.where(F.col(column) > mark)
