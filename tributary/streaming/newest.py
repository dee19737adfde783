"""New raw parts into the warehouse, with the newest version of each key as the state of the stream.

The state knows when the newest version of a key was changed and what it was, not the record. A version that is older, or
the same again, goes no further: a part that is landed twice, or late, costs no read and no write of the table. The
watermark follows the times of change. Once it has passed the newest version of a key, a timer drops it, so the state
holds as many keys as were changed within `delay`. A version that comes later than that is not lost: no state speaks against
it, so it goes on to the merge, which compares it with the stored row and writes only what has changed.

Python asks for a state over a socket, which costs far more than to judge a version. So keys are dealt to a fixed number of
groups, and a state holds the versions of a group: a micro-batch asks once for each group it touches, not for each key.

Of versions with one time of change the one in the later part wins, within a part the one with the larger hash, as lines of
a stream have no numbers.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from datetime import datetime
from threading import Event

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery, StreamingQueryListener

from tributary.functions.cells import Records
from tributary.model import UNIFIED_COLUMNS, UNIFIED_SCHEMA
from tributary.operators.mapping import ResourceMapping, accepted, get_mapping, map_records, rejected
from tributary.operators.summaries import event_time_marks
from tributary.session import discard, prepare, scratch_path, settings
from tributary.sources.raw_zone import explode_records, unwrapped
from tributary.sources.warehouse import Warehouse
from tributary.sources.watermarks import Watermarks

#: How far behind the newest change a version may come and still be judged by the state alone.
DELAY = "30 days"
#: Groups of keys, each with one state. The checkpoint depends on it.
GROUPS = 1 << 12
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PARTITIONS, _ADAPTIVE = "spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"
_INSTANTS = tuple(f.name for f in UNIFIED_SCHEMA if isinstance(f.dataType, T.TimestampType))
_CONTENT = [c for c in UNIFIED_COLUMNS if c != "ingested_at"]


class NewestVersion(StatefulProcessor):
    """Lets a version through if it is newer than all before it; rejected records pass as they are."""

    def __init__(self, columns: list[str]) -> None:
        self.columns = columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest_of_group", "versions string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        best: dict[str, Row] = {}
        for row in rows:
            if row["reject_stage"] is not None:
                yield self._out(row)
            elif row["_key"] not in best or self._version(row) > self._version(best[row["_key"]]):
                best[row["_key"]] = row
        if not best:
            return
        known = self._known()
        timer, passed = self._timer(known), []
        for name, row in best.items():
            version, last = self._version(row), known.get(name)
            # The same content with the same time is no new version, whatever part it came in.
            if last is not None and (version[:2] <= last[:2] or (version[0], version[2]) == (last[0], last[2])):
                continue
            known[name] = version
            passed.append(row)
        if passed:
            self._keep(known, timer)
        for row in passed:
            yield self._out(row)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        over = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        known = {name: version for name, version in self._known().items() if self._due(version[0]) > over}
        # The timer that has expired is deleted by Spark.
        self._keep(known, None)
        yield from ()

    def close(self) -> None:
        pass

    def _known(self) -> dict[str, tuple[int, str, int]]:
        """The newest versions of the group's keys."""
        held = self.newest.get()
        if held is None:
            return {}
        parts, versions = json.loads(held[0])
        return {name: (at, parts[part], content) for name, (at, part, content) in versions.items()}

    def _keep(self, known: dict[str, tuple[int, str, int]], timer: int | None) -> None:
        """Store the versions, and move the group's one timer to where the first of them is dropped. Many are of one
        part, whose name is stored once."""
        due = self._timer(known)
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if due is None:
            self.newest.clear()
            return
        if timer != due:
            self.handle.registerTimer(due)
        parts = {part: number for number, part in enumerate(sorted({part for _, part, _ in known.values()}))}
        versions = {name: (at, parts[part], content) for name, (at, part, content) in known.items()}
        self.newest.update((json.dumps([list(parts), versions], separators=(",", ":")),))

    def _timer(self, known: dict[str, tuple[int, str, int]]) -> int | None:
        return min((self._due(at) for at, _, _ in known.values()), default=None)

    def _out(self, row: Row) -> Row:
        return Row(**{c: row[c] for c in self.columns})

    @staticmethod
    def _version(row: Row) -> tuple[int, str, int]:
        return row["_at"], row["part"], row["_content"]

    @staticmethod
    def _due(at: int) -> int:
        """In milliseconds, when no version of this time can be within the delay any more."""
        return at // 1000 + 1


def newest_versions(tagged: DataFrame, delay: str = DELAY) -> DataFrame:
    """Of a stream of mapped rows with `part`, the rejected ones and those that are newer than all before them."""
    columns = [c for c in tagged.columns if c not in ("block", "line", "item")]
    at = F.coalesce("updated_at", "created_at")
    # Instants cross to Python as numbers, since a clock time of a worker's zone may mean two of them.
    numbers = {c: F.unix_micros(c) for c in _INSTANTS}
    keyed = (
        tagged.select(*columns, at.alias("_event_time")).withWatermark("_event_time", delay)
        # Not as the watermark's column: the state, not the watermark, decides about late rows.
        .withColumns({"_at": F.unix_micros("_event_time"), "_content": F.xxhash64(*_CONTENT)})
        # Rejected rows need no state; they are spread.
        .withColumn("_key", F.coalesce(F.when(F.col("reject_stage").isNull(), F.col("unified_id")), F.xxhash64("payload").cast("string")))
        .withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(GROUPS)).cast("int"))
        .withColumns(numbers).drop("_event_time")
    )
    schema = T.StructType([T.StructField(c, T.LongType() if c in _INSTANTS else tagged.schema[c].dataType) for c in columns])
    out = keyed.groupBy("_group").transformWithState(NewestVersion(columns), schema, "Update", "EventTime")
    return out.withColumns({c: F.timestamp_micros(c) for c in _INSTANTS})


class StreamCounts(StreamingQueryListener):
    """Sums of the metrics that streams observe, by query and name, over all their micro-batches.

    Register it with `spark.streams.addListener` before the stream starts.
    """

    def __init__(self) -> None:
        self.sums: dict[str, dict[str, dict[str, int]]] = {}
        self._over: dict[str, Event] = {}

    def of(self, query: StreamingQuery, timeout: float = 60) -> dict[str, dict[str, int]]:
        """The sums of a query that has ended. Events of the last micro-batch may still be under way."""
        self._over.setdefault(str(query.runId), Event()).wait(timeout)
        return self.sums.get(str(query.runId), {})

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.sums.setdefault(str(event.runId), {})

    def onQueryProgress(self, event) -> None:  # noqa: N802
        mine = self.sums.setdefault(str(event.progress.runId), {})
        for name, row in event.progress.observedMetrics.items():
            totals = mine.setdefault(name, {})
            for metric, value in row.asDict().items():
                totals[metric] = totals.get(metric, 0) + (value or 0)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._over.setdefault(str(event.runId), Event()).set()


def _merge(
    warehouse: Warehouse, columns: list[str], origin: tuple[str, str], ingested_at: datetime,
    watermarks: Watermarks | None, quarantine_root: str | None, of_session: dict[str, str],
) -> Callable[[DataFrame, int], None]:
    def merge(rows: DataFrame, batch: int) -> None:
        # The session of the stream has settings for the stream's own plan: no adaptive one, partitions as the state has.
        with settings(rows.sparkSession, of_session):
            merge_rows(rows, batch)

    def merge_rows(rows: DataFrame, batch: int) -> None:
        spark = rows.sparkSession
        # Written once: reading the rows again would run the stateful step again.
        path = scratch_path(spark, "newest")
        rows.write.parquet(path)
        tagged = spark.read.schema(rows.schema).parquet(path)
        unified = accepted(tagged).select(*columns)
        warehouse.upsert(unified, decode=False, stage=False, skip_unchanged=True)
        if watermarks is not None:
            watermarks.set(event_time_marks(unified), f"batch-{batch}", ingested_at)
        if quarantine_root:
            folder = f"{quarantine_root.rstrip('/')}/stream/{'/'.join(origin)}/batch={batch}"
            rejected(tagged, keep=("part",)).write.mode("overwrite").parquet(folder)
        discard(spark, path)

    return merge


def stream_newest(
    spark: SparkSession,
    raw_root: str,
    source: str,
    resource: str,
    warehouse: Warehouse,
    checkpoint: str,
    ingested_at: datetime,
    *,
    delay: str = DELAY,
    mapping: ResourceMapping | None = None,
    watermarks: Watermarks | None = None,
    quarantine_root: str | None = None,
    files_per_batch: int | None = None,
    whole_files: bool = False,
    partitions: int | None = None,
) -> StreamingQuery:
    """Merge the newest versions among the parts that have landed since the checkpoint, then stop.

    `partitions` are those of the state, by default as many as the session's shuffles have; a micro-batch opens each of
    them, whatever it holds. The first start fixes them. Lines are dealt to as many tasks before the rules, so a part costs no
    more than its share.
    The stream observes `tagged` (input, mapped, rejected) and `newest` (passed) of every micro-batch.
    """
    prepare(spark)
    mapping = mapping or get_mapping(source, resource)
    reader = spark.readStream.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json*")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    lines = reader.text(f"{raw_root.rstrip('/')}/{source}/{resource}", wholetext=whole_files).select(
        "value", F.col("_metadata.file_path").alias("part"), F.col("_metadata.file_block_start").alias("block")
    )
    before = {name: spark.conf.get(name) for name in (_PARTITIONS, _ADAPTIVE)}
    partitions = partitions or int(before[_PARTITIONS])
    records = unwrapped(explode_records(lines.repartition(partitions)))
    good = F.col("reject_stage").isNull()
    tagged = map_records(Records(records, "record"), mapping, ingested_at, keep=("part",)).observe(
        "tagged", F.count(F.lit(1)).alias("input"), F.count(F.when(good, 1)).alias("mapped"), F.count(F.when(~good, 1)).alias("rejected"),
    )
    newest = newest_versions(tagged, delay).observe("newest", F.count(F.when(good, 1)).alias("passed"))
    merge = _merge(warehouse, UNIFIED_COLUMNS, (source, resource), ingested_at, watermarks, quarantine_root, before)
    with settings(spark, {_PROVIDER: _ROCKSDB, _PARTITIONS: str(partitions)}):
        return (
            newest.writeStream.foreachBatch(merge).outputMode("update").option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
