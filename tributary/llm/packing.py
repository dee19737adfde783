"""Packing of token ids into sequences of bounded length, balanced by attention cost.

The cost of a sequence is the sum over its pieces of `linear * n + quadratic * n * n`: each token is worked
on once, and each token looks at those of its own piece. Documents are packed in groups of bounded size
within the task that encodes them, so nothing is shuffled and a lost task is simply run again:

* what a document holds beyond whole sequences is cut off first and fills sequences of its own;
* the remainders, longest first, go to the cheapest sequence that can still hold them;
* a remainder that fits nowhere is cut to fill the sequence with the most room;
* the tokens a group holds beyond whole sequences go to sequences whose lengths are powers of two, which
  need no padding. A group thus needs no padding at all, and only a few short sequences.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tributary.llm.common import over_rows, texts
from tributary.llm.word_bpe import REMEMBERED, word_encoder


@dataclass(frozen=True)
class Packing:
    """`capacity` must be a power of two. A group closes once it holds `group_tokens` tokens."""

    capacity: int = 2048
    linear: float = 1.0
    quadratic: float = 1.0 / 1024
    group_tokens: int = 1 << 21


def _sizes(tokens: int, capacity: int) -> list[int]:
    """Lengths of sequences that hold so many tokens without padding."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(lengths: list[int], how: Packing) -> list[tuple[int, int, int, int, int]]:
    """Pack documents of these lengths: (document, start, length, sequence, offset), sequences from 0.

    Documents of length 0 have no piece. Equal lengths keep their order; equal costs go to the sequence
    opened first. Every token lies in one piece, every sequence is filled from 0 without gaps.
    """
    capacity, pieces, opened = how.capacity, [], 0
    rests = []
    for doc, n in enumerate(lengths):
        for start in range(0, n - n % capacity, capacity):
            pieces.append((doc, start, capacity, opened, 0))
            opened += 1
        if n % capacity:
            rests.append((n % capacity, doc, n - n % capacity))
    rests.sort(key=lambda r: (-r[0], r[1]))
    sizes = _sizes(sum(r[0] for r in rests), capacity)
    # `cheap` holds sequences by cost, `parked` those too full for the piece at hand by their room. Pieces
    # come in falling length, so a parked sequence is of use again once its room holds the piece.
    cheap = [(0.0, s) for s in range(len(sizes))]
    parked: list[tuple[int, int, float]] = []
    used = [0] * len(sizes)
    k = 0
    while k < len(rests):
        n, doc, start = rests[k]
        k += 1
        while parked and -parked[0][0] >= n:
            _, s, cost = heapq.heappop(parked)
            heapq.heappush(cheap, (cost, s))
        while cheap and sizes[cheap[0][1]] - used[cheap[0][1]] < n:
            cost, s = heapq.heappop(cheap)
            heapq.heappush(parked, (used[s] - sizes[s], s, cost))
        if cheap:
            cost, s = heapq.heappop(cheap)
        else:  # nothing holds it: fill the sequence with the most room and put the rest back by its length
            _, s, cost = heapq.heappop(parked)
            whole, n = n, sizes[s] - used[s]
            rest = (whole - n, doc, start + n)
            rests.insert(bisect_left(rests, (-rest[0], doc), k, key=lambda r: (-r[0], r[1])), rest)
        pieces.append((doc, start, n, opened + s, used[s]))
        used[s] += n
        if used[s] < sizes[s]:
            heapq.heappush(cheap, (cost + how.linear * n + how.quadratic * n * n, s))
    return pieces


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int = 1, how: Packing = Packing(),
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True, remembered: int = REMEMBERED,
) -> DataFrame:
    """Encode every whole text, add the end id, and pack all documents. One row per piece:

    doc_id, start (ids of its document before it), length, ids_crc32 (of its ids as little-endian unsigned
    32-bit integers), doc_tokens (with the end id), sequence_id, offset (place in the sequence), and with
    `with_ids` the ids themselves (binary). A null or empty text is a document of the end id alone. Repeated rows are documents
    of their own; a null doc_id stays null. An empty table gives no rows. sequence_id is unique and the same
    whenever the same input splits are read: the split's number times 2**33, plus a count. `remembered` bounds
    the words a worker remembers.
    """
    schema = (
        f"`{id_col}` long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
        " offset long" + ", ids binary" * with_ids
    )
    names = [id_col, "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids]
    kinds = [pa.int64()] * 7 + [pa.binary()] * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encoder = word_encoder(tokenizer, remembered)
        first = TaskContext.get().partitionId() << 33
        group: list[tuple[int | None, bytes]] = []
        held = 0

        def closed():
            nonlocal first, held
            rows, last = [], -1
            for doc, start, n, sequence, offset in pack([len(ids) // 4 for _, ids in group], how):
                key, ids = group[doc]
                piece = ids[4 * start : 4 * (start + n)]
                rows.append((key, start, n, zlib.crc32(piece), len(ids) // 4, first + sequence, offset, piece)[: len(kinds)])
                last = max(last, sequence)
            first += last + 1
            held = 0
            group.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), texts(batch, text_col)):
                ids = encoder.encode(text) + end
                group.append((key, ids))
                held += len(ids) // 4
                if held >= how.group_tokens:
                    yield closed()
        if group:
            yield closed()

    return over_rows(docs, [id_col, text_col], run, schema)
