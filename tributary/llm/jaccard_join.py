"""Exact join of documents by the Jaccard similarity of their word n-grams, with rare-first prefix filtering.

Shingles are 64-bit hashes. Documents with equal sets form a class and are joined as one. All sets are sorted
by one order, rare shingles first, and a set's prefix is so long that two similar sets share a prefix
shingle. Candidates are the classes that meet on one; they must pass these filters, none of which drops a
similar pair, before they are verified, once per pair, on the whole sets:

* length: the smaller set holds at least the asked share of the larger;
* position: where the shared shingle stands in both bounds what the sets can have in common;
* suffix: shingles fall into parts by hash, about as many as there are shingles; each part whose counts differ
  in parity holds a shingle of one set only, and the asked overlap bounds how many of those there may be.

What classes are linked to which is found in rounds, so that a large group of near copies does not cost
all its pairs. First each class is compared with the leader of every prefix shingle it posts. Leaders are
picked by one of a few hashes, so that the many shingles a group shares have few leaders. Then, for each
shingle whose classes are not yet all connected, the classes outside its largest component are compared with
every class of another component: first for one shingle in sixteen, which connects most of what is left,
then for all. A pair that is never compared is thus connected already, or fails a filter.

Links are counted once the components are known, since two linked classes are in one component: there each
class is compared, on the whole sets, with every class whose size allows a link. A component of many shingles
is cut into bins of like sizes, and bins by hash into blocks, so that a pair of classes meets in one pair of
blocks, and no pair becomes a row. A block lists for each shingle the sets that hold it, or, if most do, those
that do not, so near copies cost what they differ in.

Frequencies are counted over all documents into a table of fixed size, so the order is by the count of a
shingle's bucket. Texts are read several times rather than stored as hashes, which would take more room than
the texts. What reaches the driver or is broadcast has a fixed size: the table (16 MB) and bit maps (2 MB).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm import blocks
from tributary.llm.common import Stage, free_name, mix, over_rows, with_rows
from tributary.llm.common import named as column

#: Buckets of the frequency table, and bits of a bit map, as powers of two.
BUCKET_BITS, MAP_BITS = 24, 24
#: Buckets in a piece of the table, and counts of how many tasks are added up at a time.
PIECE, ADDED = 1 << 14, 128
#: Keys of sets a task remembers, to post copies once; more copies are dropped when shingles meet.
REMEMBERED = 500_000
#: Hashes that leaders are picked by.
LEADERS = 8
#: Shares of the shingles that the later rounds look at: one in so many, all of them in the last.
SHARES = (16, 1)
#: The least number of parts of a signature; the parts that a join compares by itself.
LEAST_PARTS, JOIN_PARTS = 1024, 1024
#: Shingles in a block of classes whose links are counted, about; a class counts as so many at least.
BLOCK, LEAST_WEIGHT = 1 << 18, 64
_SHIFT = np.uint64(64 - BUCKET_BITS)
_LOW = np.uint64((1 << 56) - 1)
_KEYS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
_PARITY = [f"s{i}" for i in range(JOIN_PARTS // 64)]


@dataclass(frozen=True)
class Similar:
    """Sets are linked when 100 * intersection >= percent * union."""

    words: int = 5
    percent: int = 80

    def overlap(self, both):
        """The least intersection of two similar sets with so many shingles together."""
        return -(-self.percent * both // (100 + self.percent))

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1


#: Words stand between spaces, tabs and line breaks of ASCII; A-Z count as a-z.
_KINDS = blocks.byte_kinds(b" \t\n\x0b\x0c\r")
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def shingle_sets(column_of_texts: pa.Array, words: int) -> list[np.ndarray]:
    """For each text the distinct hashes of its word n-grams; of the whole sequence, if it has fewer words; none without.

    All texts are hashed in one go.
    """
    data, offsets = blocks.text_buffer(column_of_texts)
    found = blocks.words_of(data, offsets, _KINDS, _FOLD)
    edges = np.searchsorted(found.doc, np.arange(len(column_of_texts) + 1)).tolist()
    grams = _grams(found.hash, words)
    sets = []
    for start, end in zip(edges[:-1], edges[1:]):
        n = end - start
        out = np.sort(grams[start : end - words + 1] if n >= words else _grams(found.hash[start:end], n) ^ np.uint64(n))
        sets.append(out[np.concatenate([[True], out[1:] != out[:-1]])] if n else out)
    return sets


def _grams(hashes: np.ndarray, words: int) -> np.ndarray:
    n = max(len(hashes) - words + 1, 0) if words else 0
    out = hashes[:n].copy()
    for i in range(1, words):
        out = mix(out) + hashes[i : i + n]
    return mix(out)


def shingles(text: str, words: int) -> np.ndarray:
    """The set of one text."""
    return shingle_sets(pa.array([text]), words)[0]


def _keys(sets: list[np.ndarray]) -> list[bytes | None]:
    """128 bits that name each set; none for an empty one."""
    sizes = np.array([len(s) for s in sets], np.int64)
    held = np.flatnonzero(sizes)
    keys: list[bytes | None] = [None] * len(sets)
    if len(held):
        flat = np.concatenate([sets[i] for i in held])
        first = np.cumsum(sizes[held]) - sizes[held]
        sums = np.stack([np.add.reduceat(mix(flat ^ k), first) for k in _KEYS], axis=1)
        for i, name in zip(held.tolist(), sums):
            keys[i] = name.tobytes()
    return keys


def _half(key: bytes) -> int:
    return int.from_bytes(key[:8], "little", signed=True)


def _ordered(found: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """The shingles renamed, the rank of their frequency first, in order. Names keep 56 bits of the hash."""
    return np.sort((ranks[(found >> _SHIFT).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (found & _LOW))


def _signature(found: np.ndarray) -> np.ndarray:
    """For each part the parity of its shingles, as bytes. There are as many parts as shingles or more, a
    power of two."""
    parts = max(LEAST_PARTS, 1 << (len(found) - 1).bit_length())
    odd = np.bincount((mix(found) & np.uint64(parts - 1)).astype(np.int64), minlength=parts) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little")


def _folded(signature: np.ndarray, size: int) -> np.ndarray:
    """The signature over fewer parts, `size` bytes of them."""
    return np.bitwise_xor.reduce(signature.reshape(-1, size), axis=0)


def _apart(x: np.ndarray, y: np.ndarray) -> int:
    """At least so many shingles are in one of two sets only."""
    size = min(len(x), len(y))
    return int(np.bitwise_count(_folded(x, size) ^ _folded(y, size)).sum())


class _Seen:
    def __init__(self) -> None:
        self._keys: set[bytes] = set()

    def __call__(self, key: bytes) -> bool:
        if key in self._keys:
            return True
        if len(self._keys) >= REMEMBERED:
            self._keys.clear()
        self._keys.add(key)
        return False


def _sets_of(batch: pa.RecordBatch, how: Similar) -> list[np.ndarray]:
    return shingle_sets(batch.column(batch.schema.get_field_index("text")), how.words)


def _sets_and_counts(docs: DataFrame, how: Similar) -> DataFrame:
    """doc_id, n, key of every document (key null if it has no shingles), and each task's counts by bucket, in
    compressed pieces."""
    names = ["doc_id", "n", "key", "part", "piece", "counts"]

    def run(batches):
        total = np.zeros(1 << BUCKET_BITS, np.uint32)
        for batch in batches:
            sets = _sets_of(batch, how)
            n, keys = [len(s) for s in sets], _keys(sets)
            if sets:
                np.add.at(total, (np.concatenate(sets) >> _SHIFT).astype(np.int64), 1)
            none = pa.nulls(len(n), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(keys, pa.binary()), none, none, pa.nulls(len(n), pa.binary())], names=names
            )
        pieces = np.flatnonzero(total.reshape(-1, PIECE).any(axis=1))
        if len(pieces):
            none = pa.nulls(len(pieces), pa.int64())
            packed = [zlib.compress(total[p * PIECE : (p + 1) * PIECE].astype("<u4").tobytes(), 1) for p in pieces.tolist()]
            part = np.full(len(pieces), TaskContext.get().partitionId(), np.int32)
            yield pa.RecordBatch.from_arrays(
                [none, none, pa.nulls(len(pieces), pa.binary()), pa.array(part), pa.array(pieces, pa.int32()), pa.array(packed, pa.binary())], names=names
            )

    return over_rows(docs, ["doc_id", "text"], run, "doc_id long, n long, key binary, part int, piece int, counts binary")


def _ranks(counts: DataFrame) -> np.ndarray:
    """A rank for every bucket by its count, rare first, in eighths of powers of two. Pieces are added up in
    steps of bounded groups."""

    def add(kind: str, last: bool):
        def run(group: pa.Table) -> pa.Table:
            total = np.zeros(PIECE, np.uint64)
            for packed in group.column("counts"):
                total += np.frombuffer(zlib.decompress(packed.as_py()), kind)
            out = np.minimum(255, 8 * np.log2(total + 1.0)).astype(np.uint8) if last else total
            return pa.table({
                "part": group.column("part")[:1], "piece": group.column("piece")[:1],
                "counts": pa.array([zlib.compress(out.tobytes(), 1)], pa.binary()),
            })

        return run

    pieces = counts.select("part", "piece", "counts")
    for step in range(3):  # enough for two million tasks
        pieces = (
            pieces.withColumn("part", F.floor(F.col("part") / ADDED).cast("int"))
            .groupBy("part", "piece").applyInArrow(add("<u8" if step else "<u4", step == 2), "part int, piece int, counts binary")
        )
    ranks = np.zeros(1 << BUCKET_BITS, np.uint8)
    found = pieces.toArrow()
    for piece, packed in zip(found["piece"].to_pylist(), found["counts"].to_pylist()):
        ranks[piece * PIECE : (piece + 1) * PIECE] = np.frombuffer(zlib.decompress(packed), np.uint8)
    return ranks


def _bit_map(values: DataFrame, column: str) -> np.ndarray:
    """A bit for the low MAP_BITS bits of every value: true of each value, and of few others while few are set."""
    bit = F.col(column).bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    words = values.select(
        F.shiftright(bit, 6).cast("int").alias("word"),
        F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int")).alias("bits"),
    )
    out = np.zeros(1 << MAP_BITS - 6, np.int64)
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    out[found["word"].to_numpy()] = found["bits"].to_numpy()
    return out


def _on(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = (values & np.uint64((1 << MAP_BITS) - 1)).astype(np.int64)
    return (bits[at >> 6] >> (at & 63) & 1).astype(bool)


def _prefixes(docs: DataFrame, how: Similar, ranks) -> DataFrame:
    """(token, half) for each shingle of each set's prefix."""

    def run(batches):
        seen = _Seen()
        for batch in batches:
            tokens, halves = [], []
            sets = _sets_of(batch, how)
            for found, key in zip(sets, _keys(sets)):
                if key is not None and not seen(key):
                    tokens.append(_ordered(found, ranks.value)[: how.prefix(len(found))])
                    halves.append(_half(key))
            if tokens:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.repeat(halves, [len(t) for t in tokens]))],
                    names=["token", "half"],
                )

    return over_rows(docs, ["text"], run, "token long, half long")


def _sharing(docs: DataFrame, how: Similar, ranks, shared) -> DataFrame:
    """A row for each set with prefix shingles that the bit map names: key, n, these shingles and their places,
    its signature, and the parities that a join compares by itself."""
    names = ["key", "n", "tokens", "places", "signature", *_PARITY]

    def run(batches):
        seen = _Seen()
        for batch in batches:
            rows, parities = [], []
            sets = _sets_of(batch, how)
            for found, key in zip(sets, _keys(sets)):
                if key is None:
                    continue
                tokens = _ordered(found, ranks.value)[: how.prefix(len(found))]
                places = np.flatnonzero(_on(shared.value, tokens))
                if not len(places) or seen(key):
                    continue
                signature = _signature(found)
                rows.append((key, len(found), tokens[places].view(np.int64), places, signature.tobytes()))
                parities.append(_folded(signature, JOIN_PARTS // 8).view(np.int64))
            if rows:
                kinds = (pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c) for c in np.array(parities).T.copy())], names=names)

    schema = "key binary, n long, tokens array<long>, places array<long>, signature binary, " + ", ".join(f"{s} long" for s in _PARITY)
    return over_rows(docs, ["text"], run, schema)


def _least_overlap(how: Similar, both: Column) -> Column:
    """Rounded up without leaving whole numbers."""
    return F.floor((both * how.percent + (100 + how.percent - 1)) / F.lit(100 + how.percent))


def _may_link(how: Similar, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """The length and position filters on two postings of one shingle."""
    n, m, i, j = a("n"), b("n"), a("place"), b("place")
    reach = F.least(i, j) + 1 + F.least(n - i, m - j) - 1
    return (F.least(n, m) * 100 >= F.greatest(n, m) * how.percent) & (reach >= _least_overlap(how, n + m))


def _parities_allow(how: Similar, a: Callable[[str], Column], b: Callable[[str], Column]) -> Column:
    """The suffix filter as far as a join can apply it by itself."""
    both = a("n") + b("n")
    apart = sum((F.bit_count(a(s).bitwiseXOR(b(s))) for s in _PARITY), F.lit(0))
    return apart <= both - 2 * _least_overlap(how, both)


def _plausible(pairs: DataFrame, sharing: DataFrame, how: Similar) -> DataFrame:
    """The pairs that pass the suffix filter on whole signatures."""
    def side(name: str) -> DataFrame:
        return sharing.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("signature").alias(f"signature_{name}"))

    def run(batches):
        for batch in batches:
            both = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            allowed = both - 2 * how.overlap(both)
            x, y = ([np.frombuffer(v.as_buffer(), np.uint8) for v in batch.column(i)] for i in (4, 5))
            near = [_apart(u, v) <= most for u, v, most in zip(x, y, allowed)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(near, pa.bool_()))

    joined = pairs.join(side("a"), "a").join(side("b"), "b")
    return over_rows(joined, ["a", "b", "n_a", "n_b", "signature_a", "signature_b"], run, "a binary, b binary")


def _side(name: str) -> Callable[[str], Column]:
    return lambda column: F.col(f"{name}.{column}")


def _pairs(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def _verified(docs: DataFrame, pairs: DataFrame, how: Similar, stage: Stage, name: str) -> DataFrame:
    """The pairs whose whole sets are similar: (a, b, overlap)."""
    # Kept, as both joins read them; what the bit map lets through besides drops out in them.
    sets = stage.keep(_whole_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct(), how), f"{name}-sets")
    joined = (
        pairs.join(sets.select(F.col("key").alias("a"), F.col("found").alias("x")), "a")
        .join(sets.select(F.col("key").alias("b"), F.col("found").alias("y")), "b")
    )

    def verify(batches):
        for batch in batches:
            x, y = (
                [np.frombuffer(v.as_buffer(), "<u8") for v in batch.column(i)] for i in (2, 3)
            )
            same = np.array([len(np.intersect1d(u, v, assume_unique=True)) for u, v in zip(x, y)], np.int64)
            both = np.array([len(u) + len(v) for u, v in zip(x, y)], np.int64)
            linked = pa.array(100 * same >= how.percent * (both - same), pa.bool_())
            out = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(same)], names=["a", "b", "overlap"])
            yield out.filter(linked)

    found = stage.keep(over_rows(joined, ["a", "b", "x", "y"], verify, "a binary, b binary, overlap long"), name)
    stage.drop(f"{name}-sets")
    return found


def _whole_sets(docs: DataFrame, wanted: DataFrame, how: Similar) -> DataFrame:
    """(key, found) of the wanted keys, and of few others."""
    bits = docs.sparkSession.sparkContext.broadcast(_bit_map(_halves(wanted), "half"))

    def run(batches):
        seen = _Seen()
        for batch in batches:
            keys, sets = [], []
            made = _sets_of(batch, how)
            for found, key in zip(made, _keys(made)):
                if key is not None and _on(bits.value, np.frombuffer(key, "<u8", 1))[0] and not seen(key):
                    keys.append(key)
                    sets.append(found.tobytes())
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sets, pa.binary())], names=["key", "found"])

    needed = over_rows(docs, ["text"], run, "key binary, found binary")
    return needed.groupBy("key").agg(F.first("found").alias("found"))


def _halves(keys: DataFrame) -> DataFrame:
    """The first 8 bytes of each key as the little-endian number they are."""

    def run(batches):
        for batch in batches:
            half = [_half(k) for k in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(half, pa.int64())], names=["half"])

    return over_rows(keys, ["key"], run, "half long")


def components(edges: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(key, component) for every key of an edge (a, b): the smallest key its component holds.

    Each step links every neighbour above a key to the smallest neighbour, then every neighbour below; the
    edges end as stars. Steps grow with the logarithm of the longest path. A key with many neighbours is
    grouped by partial minima and joined back by a join that Spark can split.
    """
    current = stage.keep(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct(), f"{name}-0")
    before, step = None, 0
    while True:
        both = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        step += 1
        following = stage.keep(small.union(down.select("u", F.col("m").alias("v"))).distinct(), f"{name}-{step}")
        row = following.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        stage.drop(f"{name}-{step - 1}")
        if tuple(row) == before:
            break
        before, current = tuple(row), following
    roots = following.select(F.col("v").alias("key"), F.col("v").alias("component"))
    return following.select(F.col("u").alias("key"), F.col("v").alias("component")).union(roots).distinct()


def _classes(docs: DataFrame, how: Similar) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, key) of every document, and (key, n, component, component_id, n_copies, linked) of every class:
    the component's smallest key, and its smallest doc_id; whether another class is linked to it."""
    spark = docs.sparkSession
    stage = Stage(spark, "jaccard")
    sets = stage.keep(_sets_and_counts(docs, how), "sets")
    ranks = spark.sparkContext.broadcast(_ranks(sets.where("piece IS NOT NULL")))
    named = sets.where("piece IS NULL").select("doc_id", "n", "key")

    known = _prefixes(docs, how, ranks).groupBy("token").agg(F.min("half").alias("x"), F.max("half").alias("y")).where("x < y")
    shared = spark.sparkContext.broadcast(_bit_map(known, "token"))
    sharing = stage.keep(_sharing(docs, how, ranks, shared).dropDuplicates(["key"]), "sharing")

    # All postings of a shingle come together once; its size and leader are then known to each of them.
    of_token = Window.partitionBy("token")
    posting = F.struct("key", "n", "place")
    lists = stage.keep(
        sharing.select("key", "n", F.explode(F.arrays_zip("tokens", "places")).alias("at"))
        .select(F.col("at.tokens").alias("token"), "key", "n", F.col("at.places").alias("place"))
        .repartition("token").withColumn("size", F.count("*").over(of_token)).where("size > 1")
        .withColumn("leader", F.min_by(posting, F.xxhash64("key", F.pmod("token", F.lit(LEADERS)))).over(of_token)),
        "lists",
    )

    # First round: every class against the leaders of its shingles.
    leader = _side("leader")
    stars = lists.where((F.col("key") != leader("key")) & _may_link(how, F.col, leader))
    met = stage.keep(_pairs(stars, F.col("key"), leader("key")), "met")
    first = _verified(docs, stage.keep(_plausible(met, sharing, how), "tried"), how, stage, "first")

    # Later rounds: what is not connected yet, within each shingle; first within a sixteenth of the shingles,
    # which connects most of it, then within all. Two classes have been compared already.
    edges, tested = first.select("a", "b"), met
    links, stale = None, ["lists", "met", "tried", "first", "sharing"]
    for round_, share in enumerate(SHARES):
        if links is None:
            links = components(edges, stage, f"components-{round_}")
        found = links
        stale += [f"{x}-{round_}" for x in ("split", "new", "rest", "linked")]
        split = stage.keep(
            lists.where("size > 2").drop("leader", "size").join(found, "key", "left").withColumn("component", F.coalesce("component", "key"))
            .repartition("token")
            .withColumn("least", F.min("component").over(of_token)).withColumn("most", F.max("component").over(of_token)).where("least != most")
            .withColumn("weight", F.count("*").over(Window.partitionBy("token", "component")))
            .withColumn("main", F.max_by("component", F.struct("weight", "component")).over(of_token))
            .drop("least", "most", "weight").where(F.pmod(F.xxhash64("token"), F.lit(share)) == 0),
            f"split-{round_}",
        )
        if split.isEmpty():
            continue
        marked = split.join(sharing.select("key", *_PARITY), "key")
        a, b = _side("a"), _side("b")
        crossing = marked.where("component != main").alias("a").join(
            marked.alias("b"),
            (a("token") == b("token")) & (a("component") != b("component")) & _may_link(how, a, b) & _parities_allow(how, a, b),
        )
        new = stage.keep(_pairs(crossing, a("key"), b("key")).join(tested, ["a", "b"], "left_anti"), f"new-{round_}")
        if new.isEmpty():
            # Nothing to verify, so the texts are not read again.
            continue
        linked = _verified(docs, stage.keep(_plausible(new, sharing, how), f"rest-{round_}"), how, stage, f"linked-{round_}")
        tested = tested.union(new)
        if not linked.isEmpty():
            # What is connected already goes on as stars, so few steps are left.
            stars_so_far = found.where("key != component").select(F.col("key").alias("a"), F.col("component").alias("b"))
            edges, links = stars_so_far.union(linked.select("a", "b")), None
    if links is None:
        links = components(edges, stage, "components")
    stage.drop(*stale)

    classes = named.where("key IS NOT NULL").groupBy("key").agg(
        F.first("n").alias("n"), F.min("doc_id").alias("least"), F.count("*").alias("n_copies")
    )
    linked = classes.join(links, "key")
    names = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    named_links = linked.join(names, "component").select("key", "component", "component_id")
    return named, classes.join(named_links, "key", "left").select(
        "key", "n", F.coalesce("component", "key").alias("component"),
        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id")).alias("component_id"), "n_copies",
        F.col("component").isNotNull().alias("linked"),
    )


class _Block:
    """Sets side by side, to be compared with one set at a time."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.n = np.array([len(s) for s in sets], np.int64)
        found = np.concatenate(sets)
        order = np.argsort(found, kind="stable")
        holders = np.repeat(np.arange(len(sets)), self.n)[order]
        self._tokens, starts, counts = np.unique(found[order], return_index=True, return_counts=True)
        self._lists = np.split(holders, starts[1:])
        self._common = 2 * counts > len(sets)
        for t in np.flatnonzero(self._common).tolist():
            lacks = np.ones(len(sets), bool)
            lacks[self._lists[t]] = False
            self._lists[t] = np.flatnonzero(lacks)

    def _times(self, tokens: np.ndarray) -> np.ndarray:
        lists = [self._lists[t] for t in tokens.tolist()]
        return np.bincount(np.concatenate(lists), minlength=len(self.n)) if lists else np.zeros(len(self.n), np.int64)

    def linked(self, found: np.ndarray, how: Similar) -> np.ndarray:
        """Which of the sets are similar to this one."""
        at = np.minimum(np.searchsorted(self._tokens, found), len(self._tokens) - 1)
        at = at[self._tokens[at] == found]
        common = self._common[at]
        same = common.sum() + self._times(at[~common]) - self._times(at[common])
        return 100 * same >= how.percent * (self.n + len(found) - same)


def _blocks(members: DataFrame, how: Similar) -> DataFrame:
    """A row for each pair of blocks that a class is in: key, n_copies, component, bin, x, up, y, and second, if the
    class is in the latter of two blocks. The blocks are x of this bin and y of the same bin or the next one up."""
    weight = F.sum(F.greatest("n", F.lit(LEAST_WEIGHT)))
    # Sets in bins that are not neighbours differ too much in size; the bins are a bit wider than need be.
    wide = 1.001 * math.log(100 / how.percent) or 1.0
    whole = members.groupBy("component").agg(weight.alias("weight"))
    binned = members.join(whole, "component").withColumn(
        "bin", F.when(F.col("weight") <= BLOCK, F.lit(0)).otherwise(F.floor(F.log(F.col("n")) / wide)).cast("long")
    )
    bins = binned.groupBy("component", "bin").agg(F.ceil(weight / BLOCK).cast("long").alias("parts"))
    for step, name in ((-1, "above"), (1, "below")):
        bins = bins.join(bins.select("component", (F.col("bin") + step).alias("bin"), F.col("parts").alias(name)), ["component", "bin"], "left")
    meets = F.expr("""concat(
        transform(sequence(0L, parts - 1), j -> struct(bin, least(part, j) AS x, false AS up, greatest(part, j) AS y, j < part AS second)),
        if(above > 0, transform(sequence(0L, above - 1), j -> struct(bin, part AS x, true AS up, j AS y, false AS second)), array()),
        if(below > 0, transform(sequence(0L, below - 1), j -> struct(bin - 1 AS bin, j AS x, true AS up, part AS y, true AS second)), array()))""")
    return (
        binned.join(bins, ["component", "bin"]).withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))
        .select("key", "n_copies", "component", F.explode(meets).alias("at")).select("key", "n_copies", "component", "at.*")
    )


def _linked_to(docs: DataFrame, members: DataFrame, how: Similar) -> DataFrame:
    """(key, n_linked): how many documents of other classes each of these classes is linked to, if any.

    Members are (key, n, component, n_copies), whole components.
    """

    def count(group: pa.Table) -> pa.Table:
        keys = np.array(group.column("key").to_pylist(), object)
        sets = [np.frombuffer(v.as_buffer(), "<u8") for v in group.column("found")]
        copies = group.column("n_copies").to_numpy()
        second = group.column("second").to_numpy().astype(bool)
        linked = np.zeros(len(sets), np.int64)
        alone = not group.column("up")[0].as_py() and group.column("x")[0].as_py() == group.column("y")[0].as_py()
        first = np.flatnonzero(~second)
        rest = first if alone else np.flatnonzero(second)
        if len(first) and len(rest):
            block = _Block([sets[i] for i in first])
            for i in rest.tolist():
                to = first[block.linked(sets[i], how)]
                linked[i] += copies[to].sum()
                if alone:
                    linked[i] -= copies[i]
                else:
                    linked[to] += copies[i]
        some = linked > 0
        return pa.table({"key": pa.array(keys[some].tolist(), pa.binary()), "n_linked": pa.array(linked[some])})

    sets = _whole_sets(docs, members.select("key"), how)
    met = sets.join(_blocks(members, how), "key").groupBy("component", "bin", "x", "up", "y")
    return met.applyInArrow(count, "key binary, n_linked long").groupBy("key").agg(F.sum("n_linked").alias("n_linked"))


def link(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """Per document: doc_id, n_shingles (size of its set), component_id (smallest doc_id reachable by links,
    its own included), n_copies (documents with the same set), n_links (other documents that are similar to
    it, those with the same set included).

    A null text, an empty one and one without words have no shingles, and are linked with nothing. A null
    doc_id links like any other, but is no component's name; a component of null ids only has a null name.
    Rows that repeat are returned as often, in one component, and count as copies. An empty table gives no rows.
    """
    named, classes = _classes(docs, how)
    classes = Stage(docs.sparkSession, "jaccard-links").keep(classes, "classes")
    linked_to = _linked_to(docs, classes.where("linked").select("key", "n", "component", "n_copies"), how)
    return named.join(classes.drop("n").join(linked_to, "key", "left"), "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.coalesce("n_copies", F.lit(1).cast("long")).alias("n_copies"),
        F.coalesce(F.col("n_copies") - 1 + F.coalesce("n_linked", F.lit(0)), F.lit(0)).cast("long").alias("n_links"),
    )


def representatives(docs: DataFrame, how: Similar = Similar()) -> DataFrame:
    """One row of each group of linked documents, all its columns unchanged: that with the smallest doc_id.

    Documents without shingles all stay. A null doc_id comes last within its group. Of rows with one doc_id and
    one set, that with the first text stays.
    """
    found, classes = _classes(docs, how)
    none = F.lit(-(1 << 63))
    chosen = (
        found.join(classes.select("key", "component"), "key")
        .groupBy("component").agg(F.min_by(F.struct("doc_id", "key"), F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("first"))
        .select(F.coalesce("first.doc_id", none).alias("id"), "first.key")
    )
    words = how.words

    key, id_, place, kept = (free_name(docs, n) for n in ("set_key", "set_id", "set_place", "set_kept"))
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            yield batch.append_column(key, pa.array(_keys(shingle_sets(batch.column(at), words)), pa.binary()))

    marked = with_rows(docs, run, add=f"`{key}` binary").withColumn(id_, F.coalesce(column("doc_id"), none))
    # Rows are dealt by id and set, so a large group of copies is spread.
    first = Window.partitionBy(id_, key).orderBy(column("text"))
    flagged = marked.join(chosen.toDF(id_, key).withColumn(kept, F.lit(True)), [id_, key], "left")
    one = flagged.where(F.col(kept) | F.col(key).isNull()).withColumn(place, F.row_number().over(first))
    return one.where((F.col(place) == 1) | F.col(key).isNull()).select(*(column(c) for c in docs.columns))
