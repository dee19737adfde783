"""Vector code compression: product codebooks trained by Lloyd's rounds whose members stay where they are.

A vector of whole numbers is cut into equal parts, and every part position has a codebook of its own. Training deals
each part to an owner, which is a partition of (position, entry, salt): an owner holds the members of one entry, and
salts split an entry that many parts chose. A round has two steps. Owners read the members that reside with them and
sum them up; the sums of all owners of an entry make its next value. Then owners compare their members with the new
codebook, and only the parts whose nearest entry is another one migrate, in one shuffle, to the owner of that entry,
as a new layer. No layer is written again: which members have left follows from the codebooks of the rounds since they
came, which are a few thousand numbers and go with the task. So a round shuffles what changes and no more. All
arithmetic is in whole numbers and exact; a round that moves no entry ends the training, as all later ones would do the same.

* Vectors that are null or hold null or non-finite components take no part and give no row.
* Vectors whose length is no multiple of the number of parts, empty ones, and those with components so large that an
  error could pass 64 bits (beyond 46,340 with 64 components) give a row without code or error and train nothing.
* Every length of vectors has codebooks of its own; those of one length are kept together on the driver.
* Codebooks begin with the vectors of the smallest ids, of equal ids the smaller vectors, null ids last. With fewer
  vectors than entries, codebooks have as many entries as vectors.
* Repeated rows are rows like others. An empty table trains no codebooks and gives an empty table.
* Other columns pass through; the columns this adds take free names if theirs are taken.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.common import Stage, free_name, named, over_rows, with_rows

#: Parts that one owner holds at most, about.
OWNER_PARTS = 1_000_000
#: Vectors compared with a codebook at a time.
_AT_A_TIME = 8_192
#: Whole numbers up to here are exact as doubles.
_EXACT = 1 << 53

_MEMBERS = "length int, position int, entry int, salt int, born int, part array<long>"
_SUMS = "length int, position int, entry int, members long, sums array<long>"


@dataclass(frozen=True)
class Codes:
    """How vectors are coded. `scale` turns components into whole numbers."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    scale: int = 4096


@dataclass
class Codebooks:
    """For each length of vectors: whole numbers by position, entry and place."""

    codes: Codes
    books: dict[int, np.ndarray] = field(default_factory=dict)

    def sha256(self) -> str:
        """Of all numbers in order, as decimal text joined by commas."""
        numbers = [str(x) for length in sorted(self.books) for x in self.books[length].ravel().tolist()]
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def largest(length: int) -> int:
    """The largest component with which the error of a vector of this length fits 64 bits."""
    return int(((1 << 63) // max(length, 1)) ** 0.5 / 2) - 1


def _whole(vectors: pa.Array, codes: Codes) -> tuple[np.ndarray, dict[int, tuple[np.ndarray, np.ndarray]]]:
    """Which rows hold usable vectors, and by length the rows that can be coded with their whole numbers."""
    lists = vectors.cast(pa.large_list(pa.float64()))
    lengths = pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False)
    usable = np.zeros(len(lengths), bool)
    by_length = {}
    for length in np.unique(lengths[lengths >= 0]).tolist():
        rows = np.flatnonzero(lengths == length)
        # Nulls become NaN here.
        values = lists.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)
        finite = np.isfinite(values).all(axis=1)
        usable[rows[finite]] = True
        if length and length % codes.parts == 0:
            with np.errstate(over="ignore"):
                values = np.floor(values[finite] * codes.scale)
            small = (np.abs(values) <= largest(length)).all(axis=1)
            by_length[length] = rows[finite][small], values[small].astype(np.int64)
    return usable, by_length


def _nearest(parts: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of one codebook for each part, of equally near ones the first."""
    if not len(parts):
        return np.zeros(0, np.int64)
    reach = int(max(np.abs(parts).max(initial=0), np.abs(book).max(initial=0)))
    if 4 * parts.shape[1] * reach * reach < _EXACT:
        # The square of the part itself is the same for all entries.
        wide = book.astype(np.float64)
        return np.argmin((wide * wide).sum(axis=1) - 2 * (parts.astype(np.float64) @ wide.T), axis=1)
    return np.argmin(_squares(parts[:, None, :] - book[None]), axis=1)


def _squares(differences: np.ndarray) -> np.ndarray:
    return (differences * differences).sum(axis=-1)


def _lists(matrix: np.ndarray) -> pa.ListArray:
    n, width = matrix.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width), pa.int32()), pa.array(matrix.ravel()))


def _member_rows(length: int, position: np.ndarray, entry: np.ndarray, salt: np.ndarray, born: int, part: np.ndarray) -> pa.RecordBatch:
    n = len(position)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(n, length), pa.int32()), pa.array(position, pa.int32()), pa.array(entry, pa.int32()),
        pa.array(salt, pa.int32()), pa.array(np.full(n, born), pa.int32()), _lists(part),
    ], names=["length", "position", "entry", "salt", "born", "part"])


def _first_members(vectors: DataFrame, vec_col: str, books: Codebooks, salts: int) -> DataFrame:
    """All parts with their nearest entries; parts are salted in turn, so copies spread like others."""

    def run(batches):
        codes, turn = books.codes, 0
        for batch in batches:
            for length, (_, whole) in _whole(batch.column(0), codes)[1].items():
                for start in range(0, len(whole), _AT_A_TIME):
                    cut = whole[start:start + _AT_A_TIME].reshape(-1, codes.parts, length // codes.parts)
                    salt = (turn + np.arange(len(cut))) % salts
                    turn += len(cut)
                    for p, book in enumerate(books.books[length]):
                        yield _member_rows(length, np.full(len(cut), p), _nearest(cut[:, p], book), salt, 0, cut[:, p])

    return over_rows(vectors, [vec_col], run, _MEMBERS)


def _residents(batch: pa.RecordBatch, history: list[Codebooks]):
    """The members that have stayed since they came, for each length and position: entries, salts and parts.

    `history` holds the codebooks of all rounds; members born in round r were dealt by those of round r.
    """
    length, position, entry, salt, born = (batch.column(i).to_numpy() for i in range(5))
    for size in np.unique(length).tolist():
        for p in np.unique(position[length == size]).tolist():
            rows = np.flatnonzero((length == size) & (position == p))
            part = batch.column(5).take(pa.array(rows)).flatten().to_numpy().reshape(len(rows), -1)
            stays = np.ones(len(rows), bool)
            for r in range(int(born[rows].min()) + 1, len(history)):
                asked = np.flatnonzero(stays & (born[rows] < r))
                stays[asked] = _nearest(part[asked], history[r].books[size][p]) == entry[rows[asked]]
            yield size, p, entry[rows[stays]], salt[rows[stays]], part[stays]


def _sums(members: DataFrame, history: list[Codebooks]) -> dict[int, dict[tuple[int, int], tuple[int, list[int]]]]:
    """By length: members and sums of each (position, entry); as many numbers as the codebooks have reach the driver."""

    def run(batches):
        totals: dict[tuple[int, int, int], list] = {}
        for batch in batches:
            for length, p, entry, _, part in _residents(batch, history):
                for e in np.unique(entry).tolist():
                    chosen = part[entry == e]
                    total = totals.setdefault((length, p, e), [0, np.zeros(part.shape[1], np.int64)])
                    total[0] += len(chosen)
                    total[1] += chosen.sum(axis=0)
        if totals:
            yield pa.RecordBatch.from_arrays([
                *[pa.array([k[i] for k in totals], pa.int32()) for i in range(3)],
                pa.array([n for n, _ in totals.values()], pa.int64()),
                pa.array([s.tolist() for _, s in totals.values()], pa.list_(pa.int64())),
            ], names=["length", "position", "entry", "members", "sums"])

    found: dict[int, dict[tuple[int, int], tuple[int, list[int]]]] = {}
    places = members.mapInArrow(run, _SUMS).select("length", "position", "entry", "members", F.posexplode("sums").alias("at", "value"))
    for row in places.groupBy("length", "position", "entry", "at").agg(
        F.sum("members").alias("members"), F.sum(F.col("value").cast("decimal(38,0)")).alias("total")
    ).orderBy("length", "position", "entry", "at").collect():
        of = found.setdefault(row["length"], {}).setdefault((row["position"], row["entry"]), (row["members"], []))
        of[1].append(int(row["total"]))
    return found


def _migrants(members: DataFrame, history: list[Codebooks]) -> DataFrame:
    """The residents whose nearest entry in the newest codebooks is another one, as members of that entry."""
    before, newest, born = history[:-1], history[-1], len(history) - 1

    def run(batches):
        for batch in batches:
            for length, p, entry, salt, part in _residents(batch, before):
                now = _nearest(part, newest.books[length][p])
                moved = now != entry
                if moved.any():
                    yield _member_rows(length, np.full(int(moved.sum()), p), now[moved], salt[moved], born, part[moved])

    return members.mapInArrow(run, _MEMBERS)


def _updated(books: Codebooks, sums: dict) -> Codebooks:
    after = {length: book.copy() for length, book in books.books.items()}
    for length, entries in sums.items():
        for (p, e), (members, totals) in entries.items():
            after[length][p, e] = [total // members for total in totals]
    return Codebooks(books.codes, after)


def _first_books(vectors: DataFrame, id_col: str, vec_col: str, codes: Codes) -> tuple[Codebooks, int]:
    """The parts of the vectors with the smallest ids, for each length, and the number of vectors that are coded."""

    def run(batches):
        for batch in batches:
            lengths = np.zeros(batch.num_rows, np.int32)
            for length, (rows, _) in _whole(batch.column(1), codes)[1].items():
                lengths[rows] = length
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lengths)], names=["id", "vec", "length"])

    types = [vectors.schema[c].dataType.simpleString() for c in (id_col, vec_col)]
    sized = over_rows(vectors, [id_col, vec_col], run, f"id {types[0]}, vec {types[1]}, length int").where("length > 0")
    counts = {r["length"]: r["count"] for r in sized.groupBy("length").count().collect()}
    books = {}
    for length in sorted(counts):
        first = sized.where(F.col("length") == length).orderBy(F.col("id").asc_nulls_last(), "vec").limit(codes.entries).collect()
        _, whole = _whole(pa.array([r["vec"] for r in first], pa.large_list(pa.float64())), codes)[1][length]
        books[length] = whole.reshape(len(first), codes.parts, -1).transpose(1, 0, 2).copy()
    return Codebooks(codes, books), sum(counts.values())


def train(
    vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", codes: Codes = Codes(), owner_parts: int = OWNER_PARTS,
) -> Codebooks:
    spark = vectors.sparkSession
    stage = Stage(spark, "vector-codes")
    first, count = _first_books(vectors, id_col, vec_col, codes)
    if not count:
        return first
    # Even if all parts of a position chose one entry, none of its owners would hold more than asked for.
    salts = -(-count // owner_parts)
    owner = ["length", "position", "entry", "salt"]
    layers = [stage.keep(_first_members(vectors, vec_col, first, salts).repartition(*owner), "layer-0")]
    history = [first]
    for r in range(1, codes.rounds + 1):
        members = layers[0]
        for layer in layers[1:]:
            members = members.unionByName(layer)
        after = _updated(history[-1], _sums(members, history))
        if all(np.array_equal(after.books[n], history[-1].books[n]) for n in after.books):
            break
        history.append(after)
        if r < codes.rounds:
            layers.append(stage.keep(_migrants(members, history).repartition(*owner), f"layer-{r}"))
    stage.drop(*[f"layer-{i}" for i in range(len(layers))])
    return history[-1]


def encode(vectors: DataFrame, books: Codebooks, *, vec_col: str = "embedding") -> DataFrame:
    """The usable rows with `code`, two hex digits for each part's nearest entry, and `error`, its squared distances."""
    at = vectors.columns.index(vec_col)
    added = [free_name(vectors, "code"), free_name(vectors, "error")]

    def run(batches):
        for batch in batches:
            usable, by_length = _whole(batch.column(at), books.codes)
            code = np.full(batch.num_rows, None, object)
            error, known = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, bool)
            for length, (rows, whole) in by_length.items():
                book = books.books.get(length)
                for start in range(0, len(rows) if book is not None else 0, _AT_A_TIME):
                    chosen = rows[start:start + _AT_A_TIME]
                    cut = whole[start:start + _AT_A_TIME].reshape(len(chosen), books.codes.parts, -1)
                    nearest = np.stack([_nearest(cut[:, p], book[p]) for p in range(books.codes.parts)], axis=1)
                    for p in range(books.codes.parts):
                        error[chosen] += _squares(cut[:, p] - book[p][nearest[:, p]])
                    known[chosen] = True
                    code[chosen] = [bytes(row).hex() for row in nearest.astype(np.uint8)]
            full = pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(code, pa.string()), pa.array(error, mask=~known)], names=[*batch.schema.names, *added]
            )
            yield full.filter(pa.array(usable))

    return with_rows(vectors, run, add=f"{added[0]} string, {added[1]} long")


def compress(
    vectors: DataFrame, *, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label", codes: Codes = Codes(),
) -> tuple[DataFrame, Codebooks]:
    """Codes and errors of all usable vectors, by codebooks trained on them, and the codebooks.

    `label_error` is the error of all vectors of the same label, nulls together; one that passes 64 bits is null.
    """
    books = train(vectors, id_col=id_col, vec_col=vec_col, codes=codes)
    stage = Stage(vectors.sparkSession, "vector-codes")
    coded = encode(vectors.select(named(id_col).alias("id"), named(label_col).alias("label"), named(vec_col).alias("vec")), books, vec_col="vec")
    coded = stage.keep(coded.drop("vec"), "coded")
    # A label may hold a third of all rows: only its partial sums are shuffled, and the join can be split.
    totals = coded.groupBy(F.col("label").alias("of")).agg(
        F.expr("try_cast(sum(CAST(error AS DECIMAL(38,0))) AS BIGINT)").alias("label_error")
    )
    joined = coded.join(totals, F.col("label").eqNullSafe(F.col("of")), "left")
    return joined.select(F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error"), books
