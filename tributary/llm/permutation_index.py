"""Approximate nearest neighbours by a permutation index.

A vector is represented by its nearest pivots in order of nearness, and posted with its rank for each of them
in the pivots' inverted files. A query reads the files of its own nearest pivots and ranks all vectors of a
block by the footrule distance, the sum of the differences in rank; the nearest part of them is reranked by
the exact cosine. Near vectors see the pivots in nearly the same order.

The index is kept in blocks of some thousand vectors, each with its own inverted files, and queries in blocks
of their own. A task works on one block of each, so nothing grows with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm.common import Stage, named, over_rows

BLOCK, QUERY_BLOCK = 8_192, 1_024
#: Queries whose distances to a block are worked out at a time.
QUERIES_AT_ONCE = 8
#: Times the rows of a sample that are looked at to take it by hashes.
SPARE = 4
#: Query blocks a task holds while blocks of the index pass it.
HELD = 32
#: For rows of some MB: each is a row group, so that a scan can cut between them and a batch holds one.
_LARGE_ROWS = {
    "parquet.block.size": str(1 << 20), "parquet.block.size.row.check.min": "1", "parquet.block.size.row.check.max": "1",
    "parquet.page.size.row.check.min": "1", "parquet.page.size.row.check.max": "1", "parquet.enable.dictionary": "false",
}


@dataclass(frozen=True)
class Index:
    """Of the `sample` vectors with the smallest id hashes, `pivots` serve as pivots, none within `alike` of
    another by cosine as long as there are others. Each vector is posted for its `posted` nearest; `share` of a
    block, and `least` at least, is reranked."""

    sample: int = 1_024
    alike: float = 0.8
    pivots: int = 128
    posted: int = 96
    share: float = 0.25
    least: int = 512


def choose_pivots(sample: np.ndarray, index: Index) -> np.ndarray:
    """The first vectors that are not alike, filled up with the first others. Vectors have length 1."""
    chosen: list[int] = []
    for i, v in enumerate(sample):
        if len(chosen) < index.pivots and (not chosen or (sample[chosen] @ v).max() < index.alike):
            chosen.append(i)
    taken = set(chosen)
    chosen += [i for i in range(len(sample)) if i not in taken][: index.pivots - len(chosen)]
    return sample[chosen]


def permutations(vectors: np.ndarray, pivots: np.ndarray, posted: int) -> np.ndarray:
    """The nearest pivots of each vector, nearest first. Vectors and pivots have length 1."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :posted]


def inverted_files(order: np.ndarray, pivots: int) -> np.ndarray:
    """The file of pivot p is row p: the rank of p for each vector, one behind the last rank where it is not posted."""
    n, posted = order.shape
    # Sums of so many ranks have to fit.
    files = np.full((pivots, n), posted, np.int16 if posted * posted < 1 << 15 else np.int32)
    files[order.ravel(), np.repeat(np.arange(n), posted)] = np.tile(np.arange(posted), n)
    return files


def footrules(query: np.ndarray, files: np.ndarray, n: int, posted: int) -> np.ndarray:
    """Footrule distance of a query's permutation to all n vectors, over the query's pivots; for several queries, a row
    of them each. A vector that is not in a pivot's file stands behind its last rank."""
    asked = np.atleast_2d(query)
    out, apart = (np.zeros((len(asked), n), files.dtype) for _ in range(2))
    for rank in range(asked.shape[1]):
        np.take(files, asked[:, rank], axis=0, out=apart, mode="clip")
        apart -= rank
        np.abs(apart, out=apart)
        out += apart
    return out if np.ndim(query) == 2 else out[0]


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _in_range(vectors: np.ndarray) -> np.ndarray:
    """The vectors, those times a power of two whose squares would leave the range of doubles: cosines stay as they are."""
    _, exponent = np.frexp(np.abs(vectors).max(axis=1, initial=0))
    return np.ldexp(vectors, np.where(np.abs(exponent) > 300, -exponent, 0)[:, None])


def search_block(ids, vectors, query_ids, queries, pivots, index: Index, k: int):
    """The k nearest found in one block for each query: (query place, vector place, score), nearest first."""
    units, query_units = _unit(vectors), _unit(queries)
    order = permutations(units, pivots, index.posted)
    files = inverted_files(order, len(pivots))
    asked = permutations(query_units, pivots, index.posted)
    most = min(len(ids), max(index.least, int(np.ceil(index.share * len(ids)))))
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    # Cosines in single precision leave out what is further away than the k-th by more than they err.
    units, query_units = units.astype(np.float32), query_units.astype(np.float32)
    err = 4 * (units.shape[1] + 4) * float(np.finfo(np.float32).eps)
    found = []
    for first in range(0, len(query_ids), QUERIES_AT_ONCE):
        some = slice(first, first + QUERIES_AT_ONCE)
        distances = footrules(asked[some], files, len(ids), order.shape[1]) if most < len(ids) else [None] * len(query_ids[some])
        for q, distance in enumerate(distances, first):
            near = np.arange(len(ids)) if distance is None else np.flatnonzero(distance <= np.partition(distance, most - 1)[most - 1])
            near = near[ids[near] != query_ids[q]]
            if len(near) > k:
                about = units[near] @ query_units[q]
                near = near[about >= np.partition(about, -k)[-k] - err]
            score = (vectors[near] * queries[q]).sum(axis=1) / (norms[near] * np.sqrt((queries[q] * queries[q]).sum()))
            best = np.lexsort((ids[near], -score))[:k]
            found += [(q, int(near[i]), float(score[i])) for i in best]
    return found


def _packed(rows: DataFrame, blocks: int, name: str) -> DataFrame:
    """Rows (vec_id, embedding) in blocks by a hash of the id: (name, ids, vectors), packed as bytes."""

    def pack(group: pa.Table) -> pa.Table:
        ids = group.column("vec_id").to_numpy()
        components = group.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        vectors = _in_range(components.astype(np.float64).reshape(len(ids), -1))
        # Rows of one id by their vectors.
        by = np.argsort(ids) if len(np.unique(ids)) == len(ids) else np.lexsort((*vectors.T[::-1], ids))
        return pa.table({
            name: group.column(name)[:1], "ids": pa.array([ids[by].astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([vectors[by].astype("<f8").tobytes()], pa.binary()),
        })

    block = F.pmod(F.xxhash64("vec_id", F.lit(name)), F.lit(blocks)).cast("int")
    return rows.select(block.alias(name), "vec_id", "embedding").groupBy(name).applyInArrow(pack, f"{name} int, ids binary, vectors binary")


def _smallest_hashes(indexed: DataFrame, n: int, sample: int, stage: Stage, name: str) -> DataFrame:
    """At most `sample` of the n rows with the smallest id hashes, copies left out, in their order.

    Taken from a table every task would send `sample` rows to the driver. So the rows are picked in tasks: of those with
    hashes below a bound that some times as many pass, and of all where the hashes lie otherwise.
    """
    hashed = F.xxhash64("vec_id")
    rows = indexed.where("copy = 1").select("vec_id", "embedding")
    bound = min((1 << 63) - 1, -(1 << 63) + (1 << 64) * SPARE * sample // max(n, 1))
    for some in (rows.where(hashed <= bound), rows):
        chosen = stage.keep(some.orderBy(hashed, "vec_id", "embedding").limit(sample), name)
        if bound == (1 << 63) - 1 or chosen.count() == sample:
            break
    # A fixed number of rows in one file.
    return chosen.coalesce(1).sortWithinPartitions(hashed, "vec_id", "embedding")


def nearest(
    vectors: DataFrame, every: int, k: int = 5, index: Index = Index(), id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest found for each query, a row whose id is divisible by `every`, among all other rows:
    query_id, rank (from 1), vec_id, score (cosine in double precision). Ties go to the smaller id.

    Vectors that are null, zero, or hold null or non-finite components take no part, nor do rows without an id.
    Vectors of each length are searched among themselves. Components are read as doubles. Repeated rows count once; a query's own id is never among its results.
    Of rows with equal vectors only the k + 1 smallest ids can be among the nearest, so only they are indexed.
    An empty table gives no rows.
    """
    spark = vectors.sparkSession
    stage = Stage(spark, "permutations")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    valid = (
        vectors.select(named(id_col).cast("long").alias("vec_id"), named(vector_col).cast("array<double>").alias("embedding"))
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & fine)
    )
    rows = stage.keep(valid.distinct(), "rows")
    found = None
    for length in sorted(r["length"] for r in rows.select(F.size("embedding").alias("length")).distinct().collect()):
        some = _nearest_of_length(rows.where(F.size("embedding") == length), length, every, k, index, stage)
        found = some if found is None else found.unionByName(some)
    return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double") if found is None else found


def _nearest_of_length(rows: DataFrame, length: int, every: int, k: int, index: Index, stage: Stage) -> DataFrame:
    spark = rows.sparkSession
    # Sorting compares hashes, and vectors only where these are equal.
    same = Window.partitionBy(F.xxhash64("embedding"), "embedding").orderBy("vec_id")
    indexed = stage.keep(rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k + 1), f"indexed-{length}")
    asked = rows.where(F.col("vec_id") % every == 0)
    n, n_asked = indexed.count(), asked.count()

    chosen = _smallest_hashes(indexed, n, index.sample, stage, f"sample-{length}").collect()
    pivots = spark.sparkContext.broadcast(choose_pivots(_unit(_in_range(np.array([r["embedding"] for r in chosen], np.float64).reshape(-1, length))), index))

    blocks = max(1, -(-n // BLOCK))
    asked_blocks = max(1, -(-n_asked // QUERY_BLOCK))
    query_blocks = _packed(asked, asked_blocks, "query_block")
    query_blocks = stage.keep(query_blocks, f"queries-{length}", **_LARGE_ROWS).repartition(max(1, -(-asked_blocks // HELD)))
    table = stage.keep(_packed(indexed, blocks, "block"), f"blocks-{length}", **_LARGE_ROWS)
    stage.drop(f"indexed-{length}", f"sample-{length}")
    # Every query block meets every block of the index. Neither side is shuffled or broadcast once for each block of the
    # other: pairs of partitions read both from where they lie.
    meetings = table.hint("shuffle_replicate_nl").crossJoin(query_blocks.withColumnsRenamed({"ids": "query_ids", "vectors": "queries"}))

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                query_block, q_ids, queries, ids, table = (batch.column(c)[i].as_py() for c in range(5))
                q_ids, ids = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                queries, table = (np.frombuffer(v, "<f8").reshape(-1, length) for v in (queries, table))
                found = search_block(ids, table, q_ids, queries, pivots.value, index, k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query_block] * len(found), pa.int32()), pa.array([q for q, _, _ in found], pa.int32()),
                        pa.array([int(q_ids[q]) for q, _, _ in found], pa.int64()), pa.array([int(ids[v]) for _, v, _ in found], pa.int64()),
                        pa.array([s for _, _, s in found], pa.float64()),
                    ],
                    names=["query_block", "query", "query_id", "vec_id", "score"],
                )

    partial = over_rows(
        meetings, ["query_block", "query_ids", "queries", "ids", "vectors"], run,
        "query_block int, query int, query_id long, vec_id long, score double",
    )
    of_query = Window.partitionBy("query_block", "query").orderBy(F.desc("score"), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(of_query)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
