"""Helpers the operators share: Arrow maps over chosen columns, staged tables, hashing of words."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.session import scratch_path

Batches = Iterator[pa.RecordBatch]


def named(column: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


#: Rows a worker turns into Python objects at a time.
_ROWS = 1_000


def _small(batches: Batches) -> Batches:
    """The same rows in smaller batches, so that few texts are Python strings at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, _ROWS):
            yield batch.slice(start, _ROWS)
        del batch
        pa.default_memory_pool().release_unused()
    _give_back()


def _give_back() -> None:
    """Spark keeps its workers for other tasks, so what a task has freed goes back to the system, where that is possible."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def over_rows(df: DataFrame, columns: Iterable[str | Column], fn: Callable[[Batches], Batches], schema: str) -> DataFrame:
    """`fn` over Arrow batches of the chosen columns only, so that no other column is read."""
    return df.select(*[named(c) if isinstance(c, str) else c for c in columns]).mapInArrow(lambda batches: fn(_small(batches)), schema)


def with_rows(df: DataFrame, fn: Callable[[Batches], Batches], *, add: str = "") -> DataFrame:
    """`fn` over Arrow batches of whole rows, which it may drop or change; `add` names columns it appends.

    Batches stream through the worker, so rows wait in no queue while their text is worked on.
    """
    schema = T.StructType([*df.schema.fields, *(T.StructType.fromDDL(add).fields if add else [])])
    return df.mapInArrow(lambda batches: fn(_small(batches)), schema)


def kept_rows(df: DataFrame, text_col: str, judge: Callable[[], Callable[[list[str]], Iterable[bool]]]) -> DataFrame:
    """The rows for which `judge()` says so, given some texts at a time; it is made once for each task."""
    at = df.columns.index(text_col)

    def run(batches):
        keeps = judge()
        for batch in batches:
            found = ["" if t is None else t for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(list(keeps(found)), pa.bool_()))

    return with_rows(df, run)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name the frame does not have, whatever the case rules of the session."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted = "_" + wanted
    return wanted


class Stage:
    """Tables written to the shared folder, where every executor can read them again.

    A written table cuts the lineage: an executor that is lost costs no earlier step. `drop` deletes a
    table nothing refers to any more.
    """

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark = spark
        self.root = scratch_path(spark, label)

    def keep(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        df.write.mode("overwrite").options(**options).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: Column, sample: int, stage: Stage) -> DataFrame:
    """(doc_id, text, label) of at most `sample` distinct labelled documents, those with the smallest hashes of their ids.

    Repeated labels of an id count once; an id with labels that differ takes no part, nor do null ids and labels. Rows
    that repeat a document count once; an id with several texts gives a row for each, and the bound holds for these rows.
    """
    known = labels.select(named("doc_id").alias("doc_id"), label.alias("label")).dropna().groupBy("doc_id").agg(
        F.min("label").alias("label"), F.max("label").alias("_most")
    ).where(F.col("label") == F.col("_most")).drop("_most")
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(named("doc_id").alias("doc_id"), named("text").alias("text")).join(F.broadcast(chosen), "doc_id")
    # Copies meet by a hash of their text, one of them from each task.
    distinct = rows.groupBy("doc_id", F.xxhash64("text").alias("_text")).agg(F.first("text").alias("text"), F.first("label").alias("label"))
    kept = stage.keep(distinct, "labelled")
    if kept.count() <= sample:
        return kept.drop("_text")
    first = kept.select("doc_id", "_text").orderBy(F.xxhash64("doc_id", "_text"), "doc_id", "_text").limit(sample)
    return kept.join(F.broadcast(first), ["doc_id", "_text"]).drop("_text")


class Memo(dict):
    """Values by key, worked out once. It is emptied when full, so its memory has a bound."""

    def __init__(self, make: Callable, limit: int = 100_000) -> None:
        super().__init__()
        self._make = make
        self._limit = limit

    def __missing__(self, key):
        if len(self) >= self._limit:
            self.clear()
        value = self[key] = self._make(key)
        return value


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: spreads 64-bit values, one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def texts(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch, null as the empty text."""
    return ["" if t is None else t for t in batch.column(batch.schema.get_field_index(name)).to_pylist()]
