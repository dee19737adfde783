"""Blocks of documents, their words as numbers, and an exchange of sorted numbers between blocks.

Counting what all documents share needs every n-gram of the corpus to meet its copies. Rows of one n-gram each
would be many times the corpus, so documents are packed into blocks, and a block posts what it holds to each of
some parts: one row with the sorted n-grams of that part. A part answers each block in the order of its posting,
so answers need no keys. A block posts an n-gram once, so one that a third of all documents hold costs a part one
entry for each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tributary.llm.common import mix

#: Bytes of text in a block; a longer document is a block by itself.
BLOCK_BYTES = 4 << 20
#: Words whose n-grams meet in one part, on average. With more words than some 10^12, raise both sizes alike: a
#: posting should hold a hundred entries and more.
PART_WORDS = 1_000_000

PACKED = "block long, text_bytes long, docs binary"


# --- blocks ---------------------------------------------------------------------------------------


def pack(docs: DataFrame, text_at: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Whole rows of `docs` in compressed blocks, in the order of the input; `text_at` is the column that is measured.

    Block numbers follow from task and place, so keep the blocks in a table before they are used twice.
    """

    def run(batches):
        first = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = done = 0
        for batch in batches:
            lengths = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            start = 0
            ends = size + np.cumsum(lengths)
            while start < batch.num_rows:
                # The rows up to the one that fills the block.
                stop = min(int(np.searchsorted(ends, block_bytes)) + 1, batch.num_rows)
                held.append(batch.slice(start, stop - start))
                size = int(ends[stop - 1])
                if size >= block_bytes:
                    yield _packed(first + done, size, held)
                    held, done = [], done + 1
                    ends = ends - size
                    size = 0
                start = stop
        if held:
            yield _packed(first + done, size, held)

    return docs.mapInArrow(run, PACKED)


def _packed(block: int, size: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        for batch in held:
            out.write_batch(batch)
    return pa.RecordBatch.from_arrays(
        [pa.array([block], pa.int64()), pa.array([size], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
        names=["block", "text_bytes", "docs"],
    )


def unpack(block: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(block)).read_all()


def text_buffer(texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts on end, and where each begins, with the end; null is the empty text."""
    column = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_[starts[0]:starts[-1]], starts - starts[0]


# --- words ----------------------------------------------------------------------------------------

#: What a byte is: part of a word, between words, or the end of a piece that no n-gram crosses.
IN_WORD, GAP, BREAK = 0, 1, 2


def byte_kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[list(gaps)] = GAP
    if breaks:
        kinds[list(breaks)] = BREAK
    return kinds


#: Bytes hashed at a time; a slice ends between words.
_SLICE = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_WORD_STEP = np.uint64(0xD6E8FEB86659FD93)
_PART_STEP = np.uint64(0xA0761D6478BD642F)


class _Powers:
    """Powers of the base of the word hash and of its inverse, modulo 2^64, as far as they were needed."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def reach(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, _SLICE + (_SLICE >> 4))
            steps = np.ones(size, np.uint64)
            steps[1:] = np.uint64(_BASE)
            cls.up = np.cumprod(steps)
            steps[1:] = np.uint64(pow(_BASE, -1, 1 << 64))
            cls.down = np.cumprod(steps)
        return cls.up, cls.down


@dataclass
class Words:
    """The words of a block in order: bytes, document, piece (equal within one), and a hash of the folded bytes."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    piece: np.ndarray
    hash: np.ndarray

    def __len__(self) -> int:
        return len(self.start)


def words_of(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, fold: np.ndarray | None = None) -> Words:
    """All words: hashing works on slices of the bytes, whole words each, whatever the texts' lengths."""
    found: list[tuple[np.ndarray, ...]] = []
    # Tables of bytes are quickest applied by the translation of byte strings.
    kind_table, fold_table = kinds.tobytes(), None if fold is None else fold.tobytes()
    has_breaks = bool((kinds == BREAK).any())
    at, breaks = 0, 0
    while at < len(data):
        to = _word_end(data, offsets, kinds, at + _SLICE)
        part = data[at:to].tobytes()
        kind = np.frombuffer(part.translate(kind_table), np.uint8)
        starts, ends = _word_edges(kind == IN_WORD, offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, to)] - at)
        up, down = _Powers.reach(to - at + 1)
        sums = np.empty(to - at + 1, np.uint64)
        sums[0] = 0
        values = np.frombuffer(part if fold_table is None else part.translate(fold_table), np.uint8).astype(np.uint64)
        values *= up[:to - at]
        np.cumsum(values, out=sums[1:])
        hashes = (sums[ends] - sums[starts]) * down[starts]
        # The length tells words apart that end in zero bytes.
        hashes ^= (ends - starts).astype(np.uint64) * _WORD_STEP
        if has_breaks:
            passed = np.cumsum(kind == BREAK, dtype=np.int32)
            piece = passed[starts] + np.int32(breaks)
            breaks += int(passed[-1])
        else:
            piece = np.zeros(len(starts), np.int32)
        found.append((starts + at, ends + at, piece, mix(hashes)))
        at = to
    if not found:
        empty = np.zeros(0, np.int64)
        return Words(empty, empty, empty, empty, np.zeros(0, np.uint64))
    start, end, broken, hashes = (np.concatenate(x) for x in zip(*found))
    edges = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(edges))
    return Words(start, end, doc, broken + doc, hashes)


def _word_edges(inside: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where words begin and end: where bytes begin or cease to be in words, and where a document begins in between."""
    turns = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    turns = np.concatenate([[0] if inside[0] else [], turns, [len(inside)] if inside[-1] else []]).astype(np.int64)
    starts, ends = turns[::2], turns[1::2]
    doc_starts = doc_starts[doc_starts > 0]
    cuts = np.unique(doc_starts[inside[doc_starts - 1] & inside[doc_starts]])
    if len(cuts):
        starts = np.insert(starts, np.searchsorted(starts, cuts), cuts)
        ends = np.insert(ends, np.searchsorted(ends, cuts), cuts)
    return starts, ends


def _word_end(data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray, at: int) -> int:
    """The first place from `at` on that lies in no word: a gap, the start of a document, or the end."""
    if at >= len(data):
        return len(data)
    limit = int(offsets[np.searchsorted(offsets, at)])
    while at < limit:
        gaps = np.flatnonzero(kinds[data[at:min(at + 65536, limit)]])
        if len(gaps):
            return at + int(gaps[0])
        at += 65536
    return limit


def ngrams(words: Words, n: int, seed: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the n-grams that lie in one piece, their hashes, and a second hash to deal them by."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    first = np.zeros(count, np.uint64) if seed is None else seed[:count].copy()
    second = first.copy()
    for j in range(n):
        word = words.hash[j:j + count]
        first *= _WORD_STEP
        first += word
        second *= _PART_STEP
        second += word
    at = np.flatnonzero(words.piece[:count] == words.piece[n - 1:])
    return at, mix(first[at]), mix(second[at])


def part_of(second: np.ndarray, parts: int) -> np.ndarray:
    return ((second >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def part_count(words: int, tasks: int, part_words: int = PART_WORDS) -> int:
    return max(tasks, -(-words // part_words), 1)


# --- numbers on the way ---------------------------------------------------------------------------


def squeeze(values: np.ndarray) -> bytes:
    """64-bit numbers by byte place, compressed: small ones cost few bytes."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def expand(packed: bytes, n: int, dtype: type = np.uint64) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(packed, decompressed_size=8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel().view(dtype)


def squeeze_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as their differences."""
    return squeeze(np.diff(values, prepend=np.uint64(0)))


def expand_sorted(packed: bytes, n: int) -> np.ndarray:
    return np.cumsum(expand(packed, n), dtype=np.uint64)


def squeeze_bits(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def expand_bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=n).view(bool)


@dataclass
class Dealt:
    """The distinct n-grams of a block, by part and hash: where each part's begin, and each n-gram's number."""

    hashes: np.ndarray
    first: np.ndarray
    number: np.ndarray
    edges: np.ndarray

    def slices(self) -> Iterator[tuple[int, slice]]:
        for part in np.flatnonzero(np.diff(self.edges)):
            yield int(part), slice(int(self.edges[part]), int(self.edges[part + 1]))


def deal(hashes: np.ndarray, second: np.ndarray, parts: int) -> Dealt:
    """`first` is the first of the given n-grams that equals the distinct one; `number` says which one each equals."""
    order = np.argsort(hashes, kind="stable")
    sorted_ = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = sorted_[1:] != sorted_[:-1]
    heads = order[new]
    part = part_of(second[heads], parts)
    by_part = np.argsort(part, kind="stable")
    rank = np.empty(len(heads), np.int64)
    rank[by_part] = np.arange(len(heads))
    number = np.empty(len(order), np.int64)
    number[order] = rank[np.cumsum(new) - 1]
    edges = np.searchsorted(part[by_part], np.arange(parts + 1))
    return Dealt(sorted_[new][by_part], heads[by_part], number, edges)
