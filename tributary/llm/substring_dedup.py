"""Passages that documents share, found by relative Lempel-Ziv parsing against the blocks of the whole corpus.

Documents are packed into reference blocks. Each block is indexed: it posts its distinct windows of `words` words
to the parts of an index that spans all blocks, each with the smallest id among its documents that hold it. The index
tells every block which of its windows begin in a document with a smaller id, and in which first. A block then parses
its documents: a factor begins at a window that the reference holds and grows by a word for as long as the next
window comes from the same document, so it is as long as that source allows. Factors are at least a window long.
Windows that begin in the last words of one factor and end in the next are checked too: they are looked up like all
others, so what they cover joins the factors they straddle. The words of all factors are the duplicate spans. Places in
the sources are not carried: a factor says that one document holds all its windows.

Windows are compared by 64 bits of a hash and dealt by others, so two different windows pass as equal with a chance
of 2^-64 divided by the number of parts.

* A null text or one without words has no windows and stays as it is; texts shorter than a window lose nothing.
* A document without an id neither takes part as a source nor loses words.
* Rows with one id are all kept and are no sources of one another.
* Of equal documents the one with the smallest id keeps its words. An empty table gives an empty table.
* Texts are parsed whole. A text longer than a block is a block by itself, held by one task.
* Other columns pass through; the columns this adds take free names if theirs are taken.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.llm import blocks
from tributary.llm.common import Stage, free_name, named

#: What lies between words: space, and tab to carriage return.
KINDS = blocks.byte_kinds(b" \t\n\x0b\x0c\r")
WORDS = 13

_POSTED = "part long, block long, n long, windows binary, sources binary"
_ANSWERED = "block long, part long, held binary, sources binary"
_ADDED = "n_words long, n_removed long, kept_text string, factors array<struct<start: long, n_words: long, source: long>>"


@dataclass
class Windows:
    """The windows of a block: places, ids and their distinct ones, by part of the index."""

    words: blocks.Words
    at: np.ndarray
    ids: np.ndarray
    dealt: blocks.Dealt
    smallest: np.ndarray


def _windows(data: np.ndarray, offsets: np.ndarray, ids: pa.ChunkedArray, size: int, parts: int) -> Windows:
    words = blocks.words_of(data, offsets, KINDS)
    at, hashes, second = blocks.ngrams(words, size)
    known = ids.is_valid().to_numpy(zero_copy_only=False)[words.doc[at]] if ids.null_count else slice(None)
    at, hashes, second = at[known], hashes[known], second[known]
    holder = ids.fill_null(0).to_numpy()[words.doc[at]]
    dealt = blocks.deal(hashes, second, parts)
    smallest = np.full(len(dealt.hashes), np.iinfo(np.int64).max)
    np.minimum.at(smallest, dealt.number, holder)
    return Windows(words, at, holder, dealt, smallest)


def post(packed: DataFrame, size: int, parts: int) -> DataFrame:
    """The distinct windows of each block for each part of the index, with the smallest id that holds them."""

    def run(batches):
        for batch in batches:
            for block, docs in zip(batch.column(0).to_pylist(), batch.column(1)):
                table = blocks.unpack(docs.as_py())
                data, offsets = blocks.text_buffer(table.column(1))
                found = _windows(data, offsets, table.column(0).cast(pa.int64()), size, parts)
                for part, held in found.dealt.slices():
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part], pa.int64()), pa.array([block], pa.int64()),
                        pa.array([held.stop - held.start], pa.int64()),
                        pa.array([blocks.squeeze_sorted(found.dealt.hashes[held])], pa.binary()),
                        pa.array([blocks.squeeze(found.smallest[held])], pa.binary()),
                    ], names=["part", "block", "n", "windows", "sources"])

    return packed.select("block", "docs").mapInArrow(run, _POSTED)


def _answer(posted: pa.Table) -> pa.Table:
    """For each posting: which windows a smaller id holds somewhere, and the smallest one."""
    sizes = posted.column("n").to_numpy()
    windows = np.concatenate([blocks.expand_sorted(x.as_py(), n) for x, n in zip(posted.column("windows"), sizes)])
    ids = np.concatenate([blocks.expand(x.as_py(), n, np.int64) for x, n in zip(posted.column("sources"), sizes)])
    order = np.argsort(windows, kind="stable")
    ranked = windows[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    smallest = np.minimum.reduceat(ids[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    source = np.empty_like(ids)
    source[order] = smallest
    held = source < ids
    ends = np.cumsum(sizes)
    spans = [slice(int(e - n), int(e)) for e, n in zip(ends, sizes)]
    return pa.table({
        "block": posted.column("block").combine_chunks(), "part": posted.column("part").combine_chunks(),
        "held": pa.array([blocks.squeeze_bits(held[s]) for s in spans], pa.binary()),
        "sources": pa.array([blocks.squeeze(source[s][held[s]]) for s in spans], pa.binary()),
    })


def _sources(found: Windows, answers: pa.Table) -> np.ndarray:
    """For each distinct window the smallest id that holds it, in any block."""
    source = found.smallest.copy()
    answer = {p: (h, s) for p, h, s in zip(*(answers.column(c).to_pylist() for c in ("part", "held", "sources")))}
    for part, span in found.dealt.slices():
        held, smaller = answer[part]
        there = np.flatnonzero(blocks.expand_bits(held, span.stop - span.start))
        source[span.start + there] = blocks.expand(smaller, len(there), np.int64)
    return source


def _factors(at: np.ndarray, doc: np.ndarray, source: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors from the places of duplicate windows, their documents and sources, left to right without overlap.

    Windows of one source at consecutive places make one factor. The part of a factor that the ones before it
    have covered is theirs; a window across the end of a factor adds only what lies beyond.
    """
    if not len(at):
        return at, at, source
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (doc[1:] != doc[:-1]) | (source[1:] != source[:-1])
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at)) - 1
    start, end = at[heads], at[tails] + size
    # Places ascend, so do ends.
    start[1:] = np.maximum(start[1:], end[:-1])
    return start, end, source[heads]


def _parse(size: int, parts: int, id_at: int, text_at: int, passed: list[int], names: list[str]):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        table = blocks.unpack(packed.column("docs")[0].as_py())
        data, offsets = blocks.text_buffer(table.column(text_at))
        found = _windows(data, offsets, table.column(id_at).cast(pa.int64()), size, parts)
        words, source = found.words, _sources(found, answers)[found.dealt.number]
        dup = source < found.ids
        start, end, origin = _factors(found.at[dup], words.doc[found.at[dup]], source[dup], size)
        step = np.zeros(len(words) + 1, np.int8)
        step[start] += 1
        step[end] -= 1
        gone = np.cumsum(step[:-1]).astype(bool)
        rows = np.arange(table.num_rows + 1)
        edges = np.searchsorted(words.doc, rows)
        removed = np.concatenate([[0], np.cumsum(gone)])[edges]
        raw = data.tobytes()
        kept = []
        for i in range(table.num_rows):
            tokens = raw[offsets[i]:offsets[i + 1]].split()
            if removed[i + 1] > removed[i]:
                tokens = compress(tokens, ~gone[edges[i]:edges[i + 1]])
            kept.append(b" ".join(tokens))
        doc = words.doc[start]
        factors = pa.ListArray.from_arrays(
            pa.array(np.searchsorted(doc, rows), pa.int32()),
            pa.StructArray.from_arrays(
                [pa.array(start - edges[doc]), pa.array(end - start), pa.array(origin)], names=["start", "n_words", "source"]
            ),
        )
        return pa.Table.from_arrays([
            *[table.column(i) for i in passed], pa.array(np.diff(edges)), pa.array(np.diff(removed)),
            pa.array(kept, pa.binary()).cast(pa.string()), factors,
        ], names=names)

    return run


def parse(
    docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", size: int = WORDS, keep: list[str] | None = None,
    block_bytes: int = blocks.BLOCK_BYTES, part_words: int = blocks.PART_WORDS,
) -> DataFrame:
    """The columns `keep` of `docs` (all, if not given) with `n_words`, `n_removed`, `kept_text` (the words left, joined
    by a space) and `factors`. Ids are whole numbers.

    A factor names its first word, its length and the smallest id that holds its windows.
    """
    spark = docs.sparkSession
    stage = Stage(spark, "substring-dedup")
    passed = docs.columns if keep is None else keep
    names = list(dict.fromkeys([id_col, text_col, *passed]))
    packed = stage.keep(blocks.pack(docs.select(*[named(c) for c in names]), 1, block_bytes), "blocks")
    # A word and the gap after it take some six bytes on average.
    words = (packed.agg(F.sum("text_bytes")).first()[0] or 0) // 6
    parts = blocks.part_count(words, int(spark.conf.get("spark.sql.shuffle.partitions")), part_words)
    answers = post(packed, size, parts).groupBy("part").applyInArrow(_answer, _ANSWERED)
    fields = [T.StructField(f"c{i}", docs.schema[c].dataType) for i, c in enumerate(passed)] + T.StructType.fromDDL(_ADDED).fields
    run = _parse(size, parts, 0, 1, [names.index(c) for c in passed], [f.name for f in fields])
    parsed = packed.select("block", "docs").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, T.StructType(fields))
    return parsed.toDF(*passed, *[free_name(docs, f.name) for f in fields[len(passed):]])


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """`docs` with the words left as text."""
    text_col = options.get("text_col", "text")
    parsed = parse(docs, **options)
    kept = free_name(docs, "kept_text")
    return parsed.select(*[named(kept).alias(c) if c == text_col else named(c) for c in docs.columns])
