"""Token ids of a corpus in files, ordered by document, compressed with a range asymmetric numeral system.

A token store is a folder of three Parquet tables, so Spark's writers and readers give it commits, retries
and any file system:

* `frequencies` (symbol, frequency): the one table that all blocks share;
* `blocks` (shard, block, doc_ids, doc_tokens, payload): runs of whole documents in order. `payload` is one
  self-contained block of `rans`, with its own checkpoints and checksum;
* `shards` (shard, tokens, start): how many tokens each shard holds, and how many lie before it.

Writing encodes each text once and stages the ids, counts them, and then moves each document to its shard
once. Shards are ranges of the order with about equal numbers of documents; an id that many documents share
may span several.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tributary.llm import rans
from tributary.llm.common import Stage, over_rows, texts
from tributary.llm.word_bpe import word_encoder

#: A block is closed once it holds so many tokens; a longer document has a block of its own.
BLOCK_TOKENS = 1 << 19
#: Documents in a shard, about.
SHARD_DOCS = 4_000
#: Shards whose sum is one number on the driver.
SHARD_GROUP = 4_096
_ENCODED = "doc_id long, ids binary, crc long, symbol int, n long"


def _encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Ids of every document with their checksum and number (symbol null), and for each task the count of each symbol
    (doc_id and ids null). Ids take two bytes each where all of a batch fit, else four."""
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = word_encoder(tokenizer)
        counts = np.zeros(1, np.int64)
        for batch in batches:
            pieces = [encoder.encode(t) for t in texts(batch)]
            if not pieces:
                continue
            sizes = np.array([len(p) // 4 + 1 for p in pieces], np.int64)
            flat = np.frombuffer(end.join(pieces) + end, "<u4")
            found = np.bincount(flat)
            if len(found) > len(counts):
                found, counts = counts, found
            counts[:len(found)] += found
            ids = flat.astype("<u2") if flat.max() < 1 << 16 else flat
            edges = np.concatenate([[0], np.cumsum(sizes)])
            yield _batch(
                batch.column(0), pa.array([ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])], pa.binary()),
                pa.array([zlib.crc32(flat[a:b]) for a, b in zip(edges[:-1], edges[1:])], pa.int64()), [None] * len(pieces), sizes,
            )
        symbols = np.flatnonzero(counts)
        if len(symbols):
            none = [None] * len(symbols)
            yield _batch(none, none, none, symbols, counts[symbols])

    return over_rows(docs, ["doc_id", "text"], run, _ENCODED)


def _batch(keys, ids, crc, symbols, n) -> pa.RecordBatch:
    types = (pa.int64(), pa.binary(), pa.int64(), pa.int32(), pa.int64())
    columns = [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip((keys, ids, crc, symbols, n), types)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "crc", "symbol", "n"])


def _wide(ids: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ids, "<u2" if len(ids) == 2 * n else "<u4")


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 1, shard_docs: int = SHARD_DOCS) -> None:
    """Encode every whole text, append the end id, and write a token store in ascending doc_id order.

    A null or empty text is the end id alone. A null doc_id comes first. Documents with the same id, repeated
    rows among them, are ordered by their ids, so the files never depend on the order of the input. An empty
    table gives empty tables.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "tokens")
    encoded = stage.keep(_encoded(docs, tokenizer, end_id), "encoded")

    # At most one row for each symbol of the vocabulary.
    counted = encoded.where("symbol IS NOT NULL").groupBy("symbol").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(1 + max((r["symbol"] for r in counted), default=0), np.int64)
    for r in counted:
        counts[r["symbol"]] = r["n"]
    precision = max(rans.PRECISION, int(len(counted)).bit_length() + 4)
    frequencies = rans.normalized(counts, precision)
    spark.createDataFrame(
        [(int(s), int(frequencies[s])) for s in np.flatnonzero(frequencies)], "symbol int, frequency long"
    ).coalesce(1).write.mode("overwrite").parquet(f"{path}/frequencies")

    # Ranges of the order, which Spark bounds by a sample of at most some hundred thousand keys. Documents of one id,
    # equal ones too, are told apart by their ids and their place, so none of them is bound to one shard.
    rows = encoded.where("symbol IS NULL")
    shards = max(1, -(-rows.count() // shard_docs))
    by_id = [F.col("doc_id").asc_nulls_first(), "crc", "at"]
    ordered = (
        rows.select("doc_id", "crc", F.monotonically_increasing_id().alias("at"), "ids", "n")
        .repartitionByRange(shards, *by_id).sortWithinPartitions(*by_id[:2], "ids").select("doc_id", "ids", "n")
    )
    shared = spark.sparkContext.broadcast((frequencies, precision))

    def blocks(batches):
        table = rans.Table(*shared.value)
        shard, block, keys, ids, held = TaskContext.get().partitionId(), 0, [], [], 0

        def closed():
            nonlocal block, keys, ids, held
            data = rans.encode(np.concatenate(ids), table)
            missing = np.packbits([k is None for k in keys]).tobytes()
            row = (shard, block, missing, np.array([k or 0 for k in keys], "<i8").tobytes(), np.array([len(i) for i in ids], "<u4").tobytes(), held, data)
            block, keys, ids, held = block + 1, [], [], 0
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.binary()))],
                names=["shard", "block", "no_id", "doc_ids", "doc_tokens", "tokens", "payload"],
            )

        for batch in batches:
            for key, packed, n in zip(*(c.to_pylist() for c in batch.columns)):
                keys.append(key)
                ids.append(_wide(packed, n))
                held += len(ids[-1])
                if held >= BLOCK_TOKENS:
                    yield closed()
        if keys:
            yield closed()

    written = ordered.mapInArrow(
        blocks, "shard int, block int, no_id binary, doc_ids binary, doc_tokens binary, tokens long, payload binary"
    )
    # The payload is compressed already.
    written.write.mode("overwrite").option("compression", "none").parquet(f"{path}/blocks")
    _write_starts(spark.read.parquet(f"{path}/blocks").groupBy("shard").agg(F.sum("tokens").alias("tokens")), path)
    shared.unpersist()
    stage.drop("encoded")


def _write_starts(sizes: DataFrame, path: str) -> None:
    """The tokens before each shard: sums within groups of shards, and one number of each group on the driver."""
    grouped = sizes.withColumn("group", F.floor(F.col("shard") / SHARD_GROUP).cast("int"))
    totals = sorted(map(tuple, grouped.groupBy("group").agg(F.sum("tokens").alias("n")).collect()))
    before, starts = 0, []
    for group, n in totals:
        starts.append((group, before))
        before += n
    spark = sizes.sparkSession
    in_group = Window.partitionBy("group").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    (
        grouped.withColumn("_before", F.coalesce(F.sum("tokens").over(in_group), F.lit(0)))
        .join(F.broadcast(spark.createDataFrame(starts, "group int, group_start long")), "group")
        .select("shard", "tokens", (F.col("group_start") + F.col("_before")).alias("start"))
        .write.mode("overwrite").parquet(f"{path}/shards")
    )


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Every document of a token store: doc_id, start (ids of all documents before it), n_tokens, ids_crc32
    (of its ids as little-endian unsigned 32-bit integers), and with `with_ids` the ids (array of int).

    Blocks are decoded in parallel, each on its own. A block that does not fit its checksum raises.
    """
    # At most one row for each symbol of the vocabulary.
    rows = spark.read.parquet(f"{path}/frequencies").collect()
    frequencies = np.zeros(1 + max((r["symbol"] for r in rows), default=0), np.int64)
    for r in rows:
        frequencies[r["symbol"]] = r["frequency"]
    precision = max(int(frequencies.sum()).bit_length() - 1, 0)
    shared = spark.sparkContext.broadcast((frequencies, precision))
    names = ["shard", "block", "doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]

    def run(batches):
        table = rans.Table(*shared.value)
        for batch in batches:
            for shard, block, no_id, keys, sizes, data in zip(*(c.to_pylist() for c in batch.columns)):
                ids = rans.decode(data, table).astype("<u4")
                keys, sizes = np.frombuffer(keys, "<i8"), np.frombuffer(sizes, "<u4").astype(np.int64)
                if sizes.sum() != len(ids):
                    raise rans.Corrupt("a block holds another number of tokens than its documents")
                ends = np.cumsum(sizes)
                parts = [ids[e - s : e] for e, s in zip(ends, sizes)]
                none = np.unpackbits(np.frombuffer(no_id, np.uint8), count=len(keys)).astype(bool)
                columns = [
                    pa.array(np.full(len(keys), shard, np.int32)), pa.array(np.full(len(keys), block, np.int32)),
                    pa.array(keys, mask=none), pa.array(ends - sizes), pa.array(sizes),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(parts, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    blocks = spark.read.parquet(f"{path}/blocks")
    documents = over_rows(
        blocks, ["shard", "block", "no_id", "doc_ids", "doc_tokens", "payload"], run,
        "shard int, block int, doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids,
    )
    shards = spark.read.parquet(f"{path}/shards")
    in_shard = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    places = (
        blocks.select("shard", "block", "tokens")
        .join(shards.select("shard", F.col("start").alias("shard_start")), "shard")
        .select("shard", "block", (F.col("shard_start") + F.coalesce(F.sum("tokens").over(in_shard), F.lit(0))).alias("block_start"))
    )
    return documents.join(places, ["shard", "block"]).select(
        "doc_id", (F.col("start") + F.col("block_start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids
    )
