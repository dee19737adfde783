"""Session settings the library relies on, and the shared folder it stages data in."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# One projection holds all rules of a mapping. Its generated method can pass the size up to which the
# JVM compiles methods by default; without this option it would run interpreted.
_COMPILE_LARGE_METHODS = "-XX:-DontCompileHugeMethods"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A JSON object that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.driver.extraJavaOptions": _COMPILE_LARGE_METHODS,
    "spark.executor.extraJavaOptions": _COMPILE_LARGE_METHODS,
    # Plans are built from many small column expressions; looking up the call site of each one takes
    # longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app_name: str = "tributary", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: A task that sorts whole records takes some ten times the memory that they take in a shuffle, once for each sort.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m"}
#: Rows a shuffle partition that feeds such a sort holds at most, about, where the number of rows is known.
SORT_ROWS = 150_000
SHUFFLE_PARTITIONS = "spark.sql.shuffle.partitions"
#: A scan feeds such sorts too, since a dedupe limits the rows of a key before its shuffle.
_SMALL_SCANS = {"spark.sql.files.maxPartitionBytes": "16m"}
#: For staged files, which are read again by tasks that sort: a scan cannot cut a row group. They lie beside what they are
#: staged for, so they are packed well.
SMALL_ROW_GROUPS = {"parquet.block.size": str(16 << 20), "compression": "zstd"}
#: The shuffle files of a job go when it is over. Otherwise they stay until the driver happens to collect its garbage, and
#: the shuffles of one step after the other fill the disk.
NO_SHUFFLE_LEFT = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}
#: For landed records and records as JSON: text that repeats the names of its fields.
PACKED_TEXT = {"compression": "gzip"}


def small_tasks(spark: SparkSession, rows: int | None = None) -> dict[str, str]:
    """Settings for jobs that sort whole records: small tasks after scans and shuffles, and as many shuffle partitions
    as so many rows need, since adaptive plans join small partitions but cut no large ones. They leave no shuffle files."""
    few = int(spark.conf.get(SHUFFLE_PARTITIONS))
    return {**SMALL_TASKS, **_SMALL_SCANS, **NO_SHUFFLE_LEFT, SHUFFLE_PARTITIONS: str(max(few, -(-(rows or 0) // SORT_ROWS)))}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for what is run within, streams that are started included."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def prepare(spark: SparkSession) -> None:
    """Check the session before a run: text without an offset means UTC, so its time zone has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "GMT"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`, or a temporary one in local mode."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="tributary-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder."""
    return f"{shared_dir(spark)}/tributary/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the path as it takes it."""
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def discard(spark: SparkSession, path: str) -> None:
    """Delete a file or folder this library has written and nothing refers to any more."""
    fs, found = file_system(spark, path)
    fs.delete(found, True)
