"""The warehouse table `unified_records`: one row per `unified_id`, kept by keyed upsert.

It is a Spark table over Parquet files in a folder, partitioned by a hash bucket of the key and, within, bucketed and
sorted by the key (`CLUSTERED BY (unified_id) SORTED BY (unified_id)`). Spark knows that layout, so a merge joins the
table where it lies: the batch is shuffled to the slices of the table, and no row of the table moves. A key has one place
whatever its source or entity type. A merge replaces the folders its keys fall into with Spark's dynamic partition
overwrite, from the join straight to the files, one task for each slice. Running a batch again gives the same table.
A merge that would make slices too large for a task writes the whole table anew, into more of them.

Commits are Spark's: a merge that fails before its commit changes nothing. One writer at a time; two that run side by
side are for a table format or a database to keep apart.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.model import UNIFIED_COLUMNS, UNIFIED_SCHEMA
from tributary.operators.dedupe import deduplicate, row_hash
from tributary.operators.gate import coerce_records, loadable, unloadable
from tributary.session import SHUFFLE_PARTITIONS, SMALL_ROW_GROUPS, discard, file_system, scratch_path, settings, small_tasks

_STAGED_SCHEMA = T.StructType(
    [T.StructField(f.name, f.dataType) for f in UNIFIED_SCHEMA]
    + [T.StructField("is_loadable", T.BooleanType()), T.StructField("reason", T.StringType()),
       T.StructField("bucket", T.IntegerType())]
)
_LAYOUT_SCHEMA = "buckets int, slices int, least int"
#: Rows a slice holds when slices are dealt anew, which is when a merge could double that: some 1.5 kB of memory each.
SLICE_ROWS = 150_000
#: Slices a table grows to by itself; those of larger tables hold more rows, and their sorts spill.
MOST_SLICES = 2_000
#: Up to so many keys are looked up by name, which skips files and row groups; more are joined.
LOOKUP_KEYS = 1_000
_IN_THRESHOLD = "spark.sql.parquet.pushdown.inFilterThreshold"


class Warehouse:
    """`buckets` folders spread the keys, `slices` files each; a merge runs in as many tasks as there are slices.

    Slices are those to begin with: they grow in number with the rows of the table, so that a task has memory and time
    for its slice, which is a file of every folder. Choose buckets so that a file holds some hundred MB: a batch of few
    keys rewrites only the folders they fall into. Both are fixed by the first merge; a table that exists refuses
    others, and takes its own if they are not given.
    """

    def __init__(self, spark: SparkSession, root: str, *, buckets: int | None = None, slices: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        stored = self._layout()
        for name, column, asked in (("buckets", "buckets", buckets), ("slices", "least", slices)):
            if asked is not None and stored and stored[column] != asked:
                raise ValueError(f"the table has {stored[column]} {name}, not {asked}")
        self.buckets: int = stored["buckets"] if stored else buckets or 16
        self.least: int = stored["least"] if stored else slices or 4
        self.slices: int = stored["slices"] if stored else self.least
        if stored:
            self._register()

    # --- layout -------------------------------------------------------------------------------

    @property
    def data(self) -> str:
        """The folder of the rows; every number of slices has its own."""
        return f"{self.root}/data" if self.slices == self.least else f"{self.root}/data-{self.slices}"

    @property
    def table(self) -> str:
        return f"tributary_{hashlib.md5(self.data.encode()).hexdigest()}"

    def _layout(self) -> dict[str, int] | None:
        """The last layout, which has the most slices."""
        try:
            row = self.spark.read.schema(_LAYOUT_SCHEMA).json(f"{self.root}/layout").orderBy(F.desc("slices")).first()
        except AnalysisException:
            return None
        return {**row.asDict(), "least": row["least"] or row["slices"]} if row else None

    def _refresh(self) -> None:
        """Follow a table that another handle has written into more slices."""
        stored = self._layout()
        if stored and (stored["buckets"], stored["slices"], stored["least"]) != (self.buckets, self.slices, self.least):
            self.buckets, self.slices, self.least = stored["buckets"], stored["slices"], stored["least"]
            self._register()

    def _register(self) -> None:
        """Tell the session's catalog of the table and of the folders other sessions have written."""
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in UNIFIED_SCHEMA)
        fs, folder = file_system(self.spark, self.data)
        fs.mkdirs(folder)
        location = self.data.replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} ({columns}, merge_action STRING, bucket INT) USING parquet "
            f"OPTIONS (partitionOverwriteMode 'dynamic', `parquet.bloom.filter.enabled#unified_id` 'true') PARTITIONED BY (bucket) "
            f"CLUSTERED BY (unified_id) SORTED BY (unified_id) INTO {self.slices} BUCKETS LOCATION '{location}'"
        )
        self.spark.sql(f"ALTER TABLE {self.table} RECOVER PARTITIONS")
        self.spark.catalog.refreshTable(self.table)

    def _commit_layout(self) -> None:
        row = (self.buckets, self.slices, self.least)
        self.spark.createDataFrame([row], _LAYOUT_SCHEMA).coalesce(1).write.mode("append").json(f"{self.root}/layout")

    def _needed(self, rows: int) -> int:
        """Slices for so many rows, or as many as there are while none holds twice its share."""
        if rows <= 2 * SLICE_ROWS * self.slices:
            return self.slices
        return max(self.slices, min(MOST_SLICES, -(-rows // SLICE_ROWS)))

    def _create(self, rows: int) -> None:
        """Make the table, if there is none, for so many rows."""
        if self._layout() is None:
            self.slices = self._needed(rows)
            self._commit_layout()
            self._register()

    def _write(self, incoming: DataFrame, newest_wins: bool, touched: set[int], rows: int) -> None:
        """Merge a batch of at most so many rows of distinct keys; if slices would become too large, into a table of more
        of them, which takes the place of this one once it is written."""
        slices = self._needed(self._rows().count() + rows)
        # The shuffle of the dedupe deals the batch to the slices already, so it is the only one.
        with settings(self.spark, {SHUFFLE_PARTITIONS: str(slices)}):
            self._write_slices(incoming, newest_wins, touched, slices)

    def _write_slices(self, incoming: DataFrame, newest_wins: bool, touched: set[int], slices: int) -> None:
        if slices == self.slices:
            self.merged(incoming, newest_wins, touched).write.insertInto(self.table, overwrite=True)
            return
        old_slices, old_data, old_table = self.slices, self.data, self.table
        every = self.merged(incoming, newest_wins, slices=slices)
        self.slices = slices
        try:
            # What an attempt that failed has left.
            self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")
            discard(self.spark, self.data)
            self._register()
            every.write.insertInto(self.table, overwrite=True)
            self._commit_layout()
        except BaseException:
            self.slices = old_slices
            raise
        self.spark.sql(f"DROP TABLE IF EXISTS {old_table}")
        discard(self.spark, old_data)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("unified_id"), F.lit(self.buckets)).cast("int")

    def _rows(self, buckets: set[int] | None = None) -> DataFrame:
        if not self.spark.catalog.tableExists(self.table):
            schema = T.StructType([*_STAGED_SCHEMA.fields[:len(UNIFIED_COLUMNS)], T.StructField("merge_action", T.StringType()),
                                   T.StructField("bucket", T.IntegerType())])
            return self.spark.createDataFrame([], schema)
        rows = self.spark.table(self.table)
        return rows if buckets is None or len(buckets) == self.buckets else rows.where(F.col("bucket").isin(sorted(buckets)))

    # --- reading ------------------------------------------------------------------------------

    def read(self) -> DataFrame:
        """The rows."""
        self._refresh()
        return self._rows().select(*UNIFIED_COLUMNS)

    def count(self) -> DataFrame:
        """The number of rows, from the file footers."""
        self._refresh()
        return self._rows().agg(F.count(F.lit(1)).alias("row_count"))

    def existing_keys(self, incoming: DataFrame) -> DataFrame:
        """Which incoming keys the table already holds; only the buckets they fall into are read.

        A few keys are looked up: the slices they fall into are told by their hashes, and row groups skipped by their
        bounds, files being sorted by key, and by Bloom filters. Many are joined where the table lies.
        """
        self._refresh()
        keys = incoming.select("unified_id").distinct()
        few = [r[0] for r in keys.where("unified_id IS NOT NULL").limit(LOOKUP_KEYS + 1).collect()]
        if len(few) <= LOOKUP_KEYS:
            return self.spark.createDataFrame([(k,) for k in self.lookup(few)], "unified_id string")
        touched = self._touched(keys.withColumn("bucket", self._bucket()))
        return keys.join(self._rows(touched).select("unified_id"), "unified_id", "left_semi")

    def looked_up(self, keys: list[str]) -> DataFrame:
        """The rows of the given keys."""
        self._refresh()
        asked = self.spark.createDataFrame([(k,) for k in keys], "unified_id string").select(self._bucket().alias("bucket"))
        return self._rows({r["bucket"] for r in asked.distinct().collect()}).where(F.col("unified_id").isin(keys))

    def lookup(self, keys: list[str]) -> list[str]:
        """Which of a bounded number of keys the table holds."""
        if not keys:
            return []
        before = self.spark.conf.get(_IN_THRESHOLD)
        # So that the keys themselves, not only their bounds, reach the files.
        self.spark.conf.set(_IN_THRESHOLD, str(max(len(keys), 1)))
        try:
            return [r["unified_id"] for r in self.looked_up(keys).select("unified_id").collect()]
        finally:
            self.spark.conf.set(_IN_THRESHOLD, before)

    @staticmethod
    def _touched(rows: DataFrame) -> set[int]:
        """At most one row for each bucket."""
        return {r["bucket"] for r in rows.select("bucket").distinct().collect()}

    # --- writing ------------------------------------------------------------------------------

    def upsert(
        self,
        records: DataFrame,
        *,
        order_by: tuple[str, ...] = (),
        newest_wins: bool = False,
        skip_unchanged: bool = False,
        quarantine: str | None = None,
        decode: bool = True,
        stage: bool = True,
    ) -> DataFrame:
        """Merge records by key and return the counts per source and resource.

        Rows that fail the gate are counted as rejected and, with `quarantine`, written there. A key
        that comes several times keeps its newest row; `order_by` lists what decides, most significant
        first. A matched row is replaced whole, nulls included. With `newest_wins` an incoming row that
        is older than the stored one does not replace it. With `skip_unchanged`, which implies it, rows that
        would change nothing are left out first, so their folders are not written again; when a record was
        ingested does not count as a change. `decode=False` skips reading attribute text;
        `stage=False` reads the records again for each step, for records that lie in Parquet already.
        """
        self._refresh()
        staged = coerce_records(records, decode=decode).withColumn("bucket", self._bucket())
        staged_path = scratch_path(self.spark, "incoming")
        if stage:
            staged.write.options(**SMALL_ROW_GROUPS).parquet(staged_path)
            staged = self.spark.read.schema(_STAGED_SCHEMA).parquet(staged_path)
        if quarantine:
            unloadable(staged.drop("bucket")).write.mode("overwrite").parquet(quarantine)
        position = [*order_by, "updated_at", "ingested_at"]
        good = loadable(staged)
        counts = staged.groupBy("source", "source_resource").agg(
            F.count(F.lit(1)).alias("input"),
            F.count(F.when(~F.col("is_loadable"), 1)).alias("rejected"),
        ).collect()
        rows = sum(r["input"] - r["rejected"] for r in counts)
        small = small_tasks(self.spark, rows)
        if skip_unchanged:
            with settings(self.spark, small):
                good = self._changes(deduplicate(good, ["unified_id"], None, [*position, row_hash(good)]))
                good.write.options(**SMALL_ROW_GROUPS).parquet(f"{staged_path}-changes")
            good = self.spark.read.schema(good.schema).parquet(f"{staged_path}-changes")
        touched = self._touched(good)
        actions: dict[tuple, dict[str, int]] = {}
        if touched:
            self._create(rows)
            incoming = deduplicate(good, ["unified_id"], None, [*position, row_hash(good)])
            with settings(self.spark, small):
                self._write(incoming, newest_wins or skip_unchanged, touched, rows)
            for row in self._rows(touched).groupBy("source", "source_resource", "merge_action").count().collect():
                actions.setdefault(tuple(row[:2]), {})[row["merge_action"]] = row["count"]
        for path in (staged_path, f"{staged_path}-changes"):
            discard(self.spark, path)
        stats = [
            (*key, r["input"], actions.get(key, {}).get("inserted", 0), actions.get(key, {}).get("updated", 0), r["rejected"])
            for r in counts for key in [(r["source"], r["source_resource"])]
        ]
        return self.spark.createDataFrame(
            stats, "source string, source_resource string, input long, inserted long, updated long, rejected long"
        )

    def _changes(self, incoming: DataFrame) -> DataFrame:
        """The rows, of distinct keys, that are newer than the stored ones, or as new and not the same.

        Like a merge this moves no row of the table, and it reads no attribute of rows that are not asked for.
        """
        at, content = F.coalesce("updated_at", "created_at"), F.xxhash64(*[c for c in UNIFIED_COLUMNS if c != "ingested_at"])
        touched = self._touched(incoming)
        old = self._rows(touched).select("unified_id", at.alias("_old_at"), content.alias("_old_content"))
        both = incoming.repartition(self.slices, "unified_id").join(old, "unified_id", "left")
        same = (at == F.col("_old_at")) & (content == F.col("_old_content"))
        return both.where(F.col("_old_at").isNull() | (at > F.col("_old_at")) | ((at == F.col("_old_at")) & ~same)).select(*incoming.columns)

    def merged(
        self, incoming: DataFrame, newest_wins: bool = False, buckets: set[int] | None = None, slices: int | None = None,
    ) -> DataFrame:
        """The rows of the given folders after a merge with rows of distinct keys, as the table stores them.

        Only the batch is shuffled, and the table too if it is asked for in another number of slices. Both sides of a
        slice are sorted, which may spill, so neither has to fit memory. A batch that is dealt to as many partitions by its
        key, as a dedupe leaves it where the session's shuffles have as many, is not shuffled again.
        """
        stored = self._rows(buckets) if slices is None else self._rows(buckets).repartition(slices, "unified_id")
        old = stored.select(F.col("unified_id"), F.struct(*UNIFIED_COLUMNS, "bucket").alias("old"))
        if self.spark.conf.get(SHUFFLE_PARTITIONS) != str(slices or self.slices):
            incoming = incoming.repartition(slices or self.slices, "unified_id")
        new = incoming.select("unified_id", F.struct(*UNIFIED_COLUMNS, "bucket").alias("new"))
        both = old.join(new, "unified_id", "full_outer")
        replaces = F.col("new").isNotNull()
        if newest_wins:
            when = {side: F.coalesce(f"{side}.updated_at", f"{side}.created_at") for side in ("old", "new")}
            replaces &= F.col("old").isNull() | when["old"].isNull() | F.coalesce(when["new"] >= when["old"], F.lit(False))
        action = F.when(~replaces, "kept").when(F.col("old").isNull(), "inserted").otherwise("updated")
        chosen = F.when(replaces, F.col("new")).otherwise(F.col("old"))
        return both.select(chosen.alias("row"), action.alias("merge_action")).select(
            *[F.col(f"row.{c}").alias(c) for c in UNIFIED_COLUMNS], "merge_action", F.col("row.bucket").alias("bucket")
        )
