"""Raw records kept as shredded VARIANT in Parquet.

The raw zone is text, which is parsed whole at every reading. The archive holds the same records, parsed once: Spark
takes the fields that most records of a file share out of the VARIANT into columns of their own, and keeps the rest beside
them. A query that picks fields then reads the columns of those fields, and Parquet's statistics of a field can skip
row groups, while a record as a whole reads back as it was.
"""

from __future__ import annotations

from contextlib import contextmanager
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.functions.cells import Records, name
from tributary.functions.instants import standardize_datetime
from tributary.functions.keys import timestamp_literal
from tributary.plans.extract import cutoff_field
from tributary.sources.raw_zone import POSITION, landing_dir, run_date_of

_SHRED = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true"}
_SCHEMA = "part string, block long, line long, item int, record variant"


@contextmanager
def _shredding(spark: SparkSession):
    before = {key: spark.conf.get(key, None) for key in _SHRED}
    for key, value in _SHRED.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def archive(records: DataFrame, root: str, source: str, resource: str, run_id: str) -> str:
    """Write the records of one run, as `read_raw` gives them; running it again replaces them."""
    spark = records.sparkSession
    path = landing_dir(root, source, resource, run_id, run_date_of(spark, run_id))
    with _shredding(spark):
        records.select("part", "block", "line", F.col("item").cast("int").alias("item"), "record").write.mode("overwrite").parquet(path)
    return path


def read_archive(spark: SparkSession, root: str, source: str, resource: str, *, run_id: str | None = None) -> DataFrame | None:
    """part, block, line, item (the input order) and record of one resource, or None when nothing is archived."""
    base = f"{root.rstrip('/')}/{source}/{resource}"
    try:
        return spark.read.schema(_SCHEMA).option("recursiveFileLookup", True).parquet(f"{base}/run_date=*/{run_id}" if run_id else base)
    except AnalysisException:
        return None


def picked_since(archived: DataFrame, source: str, cutoff: datetime | None, fields: dict[str, str]) -> DataFrame:
    """Position and text of some fields, by name and dotted path, of the records strictly after the cutoff.

    The time and the fields are picked in one step next to the scan, so no other part of a record is read.
    """
    cutoff, spellings = cutoff_field(source, cutoff)
    df, cells = Records(archived, "record").cells({"_moment": spellings, **{column: (path,) for column, path in fields.items()}})
    if cutoff is not None:
        df = df.where(f"({standardize_datetime(cells['_moment'])}) > {timestamp_literal(cutoff)}")
    return df.selectExpr(*POSITION, *[f"{cells[column].text} AS {name(column)}" for column in fields])
