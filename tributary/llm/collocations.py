"""Phrases that belong together, counted in stripes: each prefix keys a counter of the words that come next.

Documents are packed into blocks. A block counts its stripes, for the empty prefix (all words of a language) and
for longer ones, and posts them to parts, which merge equal stripes elementwise. A stripe is dealt in slices of its next
words, so the stripe of a very common prefix is no part's alone. What a merged stripe holds is all the score needs: its
entries are the frequencies of the extensions of its prefix, the whole stripe of no prefix is the number of words, and its
largest entry says whether an extension subsumes the prefix. Two word lengths are counted a round, and a round counts
only phrases whose shorter parts have come up often enough, as no rarer ones can. The part tells one block of each
frequent phrase to write out its words.

Scores, subsumption and ranks are then joins over the frequent phrases. Stripes and next words are compared by 64 bits of
a hash each, so two different phrases are taken for one with a chance of 2^-64 or less.

* A null text is empty; a text without words counts nothing. A null language counts as `und`.
* Texts are counted whole. A text longer than a block is a block by itself, held by one task.
* Repeated rows count as often as they come. Ties in rank go to the more frequent, then to the smaller phrase in bytes.
* An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tributary.llm import blocks
from tributary.llm.common import Stage, mix, named

#: Words stand between spaces and tabs, pieces between these signs and line ends.
KINDS = blocks.byte_kinds(b" \t", b".,;:!?\n\x0b\x0c\r")
#: A-Z as a-z, all other bytes as they are.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
UNKNOWN = "und"
#: Word lengths counted in a round.
_LEVELS = 2
#: The first ranking runs in so many groups for each language.
_RANK_GROUPS = 256

_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_DEAL = np.uint64(0x165667B19E3779F9)
_POSTED = "part long, block long, prefixes binary, sizes binary, stripes long, nexts binary, counts binary, n long"
_ANSWERED = "block long, round int, part long, often binary, written binary, counts binary"
_PHRASES = "lang string, phrase string, words int, a long"


@dataclass(frozen=True)
class Rules:
    """`subsumed`: a phrase is dropped if a longer one has this percentage of its occurrences."""

    longest: int = 4
    at_least: int = 30
    subsumed: int = 80
    top: int = 2000


# --- stripes of a block -----------------------------------------------------------------------------


@dataclass
class Level:
    """The phrases of one length in a block: where each occurs, its number, and stripe by stripe the distinct ones."""

    at: np.ndarray
    number: np.ndarray
    first: np.ndarray
    prefix: np.ndarray
    next: np.ndarray
    counts: np.ndarray

    def hashes(self) -> np.ndarray:
        return mix(self.prefix * _STEP + self.next)


def _level(at: np.ndarray, keys: np.ndarray, prefix: np.ndarray, next_: np.ndarray) -> Level:
    """Occurrences are alike if their keys are; `prefix` and `next_` hold each occurrence's hashes."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    new = np.ones(len(order), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    heads = np.flatnonzero(new)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    first = order[heads]
    return Level(at, number, at[first], prefix[first], next_[first], np.diff(heads, append=len(order)))


class Block:
    """The words of a block, and its phrases as far as they are known to be frequent enough."""

    def __init__(self, table: pa.Table) -> None:
        self.data, offsets = blocks.text_buffer(table.column(0))
        self.words = blocks.words_of(self.data, offsets, KINDS, FOLD)
        langs = pc.fill_null(table.column(1).cast(pa.string()), UNKNOWN).combine_chunks().dictionary_encode()
        if isinstance(langs, pa.ChunkedArray):
            langs = langs.combine_chunks()
        self.langs = langs.dictionary.to_pylist()
        self.lang = langs.indices.to_numpy()[self.words.doc]
        seeds = np.array([xxhash.xxh64_intdigest(x.encode()) for x in self.langs], np.uint64)
        self.seed = seeds[self.lang]
        self.levels: list[Level] = []
        self.often: list[np.ndarray] = []

    def count(self) -> Level:
        """The phrases one word longer than those counted so far."""
        n = len(self.levels) + 1
        if n == 1:
            word = mix(self.words.hash ^ self.seed)
            level = _level(np.arange(len(word)), word, self.seed, word)
            self.word = word
            self.rank = level.number
        else:
            before, size = self.levels[-1], len(self.words)
            number = np.full(size, -1, np.int64)
            number[before.at] = before.number
            at = before.at[before.at + n <= size]
            at = at[self.words.piece[at] == self.words.piece[at + n - 1]]
            known = min(len(self.often), n - 1)
            if known:
                # Every part of the greatest length whose frequencies are known has to be frequent.
                there = np.zeros(size, bool)
                there[self.levels[known - 1].at] = self.often[known - 1][self.levels[known - 1].number]
                for j in range(n - known + 1):
                    at = at[there[at + j]]
            keys = number[at] << 32 | self.rank[at + n - 1]
            level = _level(at, keys, before.hashes()[before.number][np.searchsorted(before.at, at)], self.word[at + n - 1])
        self.levels.append(level)
        return level

    def phrase(self, level: Level, i: int, n: int) -> str:
        at = int(level.first[i])
        starts, ends = self.words.start[at:at + n].tolist(), self.words.end[at:at + n].tolist()
        return b" ".join(FOLD[self.data[a:b]].tobytes() for a, b in zip(starts, ends)).decode()


def _dealt(levels: list[Level], parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of all entries by part, stripes kept together, and where each part begins."""
    slices = np.uint64(max(16, parts // 16))
    part = []
    for level in levels:
        # Slices of a stripe by next word; one of all words of a language by as many slices as there are parts.
        cut = (level.next >> np.uint64(20)) % (np.uint64(parts) if level is levels[0] else slices)
        part.append(blocks.part_of(mix((level.prefix ^ _DEAL) * _STEP + cut), parts))
    part = np.concatenate(part)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def _joined(levels: list[Level]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.concatenate([getattr(x, f) for x in levels]) for f in ("prefix", "next", "counts"))


def _postings(block: int, levels: list[Level], parts: int):
    order, edges = _dealt(levels, parts)
    prefix, next_, counts = (x[order] for x in _joined(levels))
    for part in np.flatnonzero(np.diff(edges)).tolist():
        span = slice(int(edges[part]), int(edges[part + 1]))
        mine = prefix[span]
        heads = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        yield pa.RecordBatch.from_arrays([
            pa.array([part], pa.int64()), pa.array([block], pa.int64()),
            pa.array([blocks.squeeze(mine[heads])], pa.binary()),
            pa.array([blocks.squeeze(np.diff(heads, append=len(mine)))], pa.binary()),
            pa.array([len(heads)], pa.int64()),
            pa.array([blocks.squeeze(next_[span])], pa.binary()), pa.array([blocks.squeeze(counts[span])], pa.binary()),
            pa.array([len(mine)], pa.int64()),
        ], names=["part", "block", "prefixes", "sizes", "stripes", "nexts", "counts", "n"])


# --- merged stripes ---------------------------------------------------------------------------------


def _merge(at_least: int, round_: int):
    """Equal stripes of all blocks added up elementwise; each block learns which of its entries are frequent."""

    def run(posted: pa.Table) -> pa.Table:
        rows = posted.select(["prefixes", "sizes", "stripes", "nexts", "counts", "n"]).to_pylist()
        prefix, next_, counts = [], [], []
        for r in rows:
            sizes = blocks.expand(r["sizes"], r["stripes"], np.int64)
            prefix.append(np.repeat(blocks.expand(r["prefixes"], r["stripes"]), sizes))
            next_.append(blocks.expand(r["nexts"], r["n"]))
            counts.append(blocks.expand(r["counts"], r["n"], np.int64))
        prefix, next_, counts = np.concatenate(prefix), np.concatenate(next_), np.concatenate(counts)
        order = np.lexsort((next_, prefix))
        new = np.ones(len(order), bool)
        new[1:] = (prefix[order][1:] != prefix[order][:-1]) | (next_[order][1:] != next_[order][:-1])
        heads = np.flatnonzero(new)
        total = np.add.reduceat(counts[order], heads)
        often, written, totals = np.empty(len(order), bool), np.zeros(len(order), bool), np.empty(len(order), np.int64)
        totals[order] = total[np.cumsum(new) - 1]
        often = totals >= at_least
        written[order[heads[total >= at_least]]] = True
        ends = np.cumsum([r["n"] for r in rows])
        spans = [slice(int(e) - r["n"], int(e)) for e, r in zip(ends, rows)]
        return pa.table({
            "block": posted.column("block").combine_chunks(), "round": pa.array([round_] * len(rows), pa.int32()),
            "part": posted.column("part").combine_chunks(),
            "often": pa.array([blocks.squeeze_bits(often[s]) for s in spans], pa.binary()),
            "written": pa.array([blocks.squeeze_bits(written[s]) for s in spans], pa.binary()),
            "counts": pa.array([blocks.squeeze(totals[s][written[s]]) for s in spans], pa.binary()),
        })

    return run


def _learn(block: Block, levels: list[Level], parts: int, answers: dict[int, dict]) -> list[np.ndarray]:
    """Take in which phrases are frequent; for each level, the total of those to be written here, else 0."""
    order, edges = _dealt(levels, parts)
    often, totals = np.zeros(len(order), bool), np.zeros(len(order), np.int64)
    for part in np.flatnonzero(np.diff(edges)).tolist():
        here = order[int(edges[part]):int(edges[part + 1])]
        answer = answers[part]
        often[here] = blocks.expand_bits(answer["often"], len(here))
        written = here[blocks.expand_bits(answer["written"], len(here))]
        totals[written] = blocks.expand(answer["counts"], len(written), np.int64)
    cuts = np.cumsum([len(x.first) for x in levels])[:-1]
    block.often += np.split(often, cuts)
    return np.split(totals, cuts)


def _counted(docs: bytes, answers: pa.Table | None, parts: int, rounds: list[int]) -> tuple[Block, list[np.ndarray]]:
    """A block with the phrases of all rounds whose answers are given."""
    block = Block(blocks.unpack(docs))
    by_round: dict[int, dict[int, dict]] = {}
    for r in answers.to_pylist() if answers is not None else []:
        by_round.setdefault(r["round"], {})[r["part"]] = r
    totals: list[np.ndarray] = []
    for round_, levels in enumerate(rounds):
        totals += _learn(block, [block.count() for _ in range(levels)], parts, by_round.get(round_, {}))
    return block, totals


def _post_first(packed: DataFrame, levels: int, parts: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for block, docs in zip(batch.column(0).to_pylist(), batch.column(1)):
                held = Block(blocks.unpack(docs.as_py()))
                yield from _postings(block, [held.count() for _ in range(levels)], parts)

    return packed.mapInArrow(run, _POSTED)


def _post_next(packed: DataFrame, answers: DataFrame, before: list[int], levels: int, parts: int) -> DataFrame:
    schema = pa.schema([(n, pa.int64() if n in ("part", "block", "stripes", "n") else pa.binary()) for n in
                        ("part", "block", "prefixes", "sizes", "stripes", "nexts", "counts", "n")])

    def run(block: pa.Table, answered: pa.Table) -> pa.Table:
        held, _ = _counted(block.column("docs")[0].as_py(), answered, parts, before)
        number = block.column("block")[0].as_py()
        return pa.Table.from_batches(list(_postings(number, [held.count() for _ in range(levels)], parts)), schema)

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, _POSTED)


def _written(packed: DataFrame, answers: DataFrame, rounds: list[int], parts: int) -> DataFrame:
    """Every frequent phrase once, with its frequency, and the words of each block and language without a phrase."""

    def run(block: pa.Table, answered: pa.Table) -> pa.Table:
        held, totals = _counted(block.column("docs")[0].as_py(), answered, parts, rounds)
        words = np.bincount(held.lang, minlength=len(held.langs)).tolist()
        langs, phrases, lengths, counts = list(held.langs), [None] * len(words), [0] * len(words), words
        for n, (level, total) in enumerate(zip(held.levels, totals), 1):
            for i in np.flatnonzero(total).tolist():
                langs.append(held.langs[held.lang[level.first[i]]])
                phrases.append(held.phrase(level, i, n))
                lengths.append(n)
                counts.append(int(total[i]))
        return pa.table({
            "lang": pa.array(langs, pa.string()), "phrase": pa.array(phrases, pa.string()),
            "words": pa.array(lengths, pa.int32()), "a": pa.array(counts, pa.int64()),
        })

    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, _PHRASES)


def frequent_phrases(
    docs: DataFrame, stage: Stage, rules: Rules, *, text_col: str = "text", lang_col: str = "lang",
    block_bytes: int = blocks.BLOCK_BYTES, part_words: int = blocks.PART_WORDS,
) -> DataFrame:
    """All phrases up to the longest length with their frequencies `a`, and rows without a phrase whose `a` add up to
    the words of a language."""
    spark = docs.sparkSession
    rows = docs.select(named(text_col).alias("text"), named(lang_col).cast("string").alias("lang"))
    packed = stage.keep(blocks.pack(rows, 0, block_bytes), "blocks").select("block", "docs", "text_bytes")
    words = (packed.agg(F.sum("text_bytes")).first()[0] or 0) // 6
    packed = packed.drop("text_bytes")
    parts = blocks.part_count(words, int(spark.conf.get("spark.sql.shuffle.partitions")), part_words)
    rounds, answers = [], None
    while sum(rounds) < rules.longest:
        levels = min(_LEVELS, rules.longest - sum(rounds))
        posted = _post_first(packed, levels, parts) if answers is None else _post_next(packed, answers, rounds, levels, parts)
        merged = posted.groupBy("part").applyInArrow(_merge(rules.at_least, len(rounds)), _ANSWERED)
        answered = stage.keep(merged, f"answers-{len(rounds)}")
        answers = answered if answers is None else answers.unionByName(answered)
        rounds = [*rounds, levels]
    return stage.keep(_written(packed, answers, rounds, parts), "phrases")


# --- scores -----------------------------------------------------------------------------------------


def _slice(words: str, first: str, length: str):
    return F.expr(f"array_join(slice({words}, {first}, {length}), ' ')")


def collocations(
    docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", rules: Rules = Rules(),
    block_bytes: int = blocks.BLOCK_BYTES, part_words: int = blocks.PART_WORDS,
) -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    A phrase is as strong as its weakest cut: of a cut into two parts with frequencies l and r the score is
    2 * a / (l + r) in millionths. Phrases that a longer one subsumes are left out.
    """
    stage = Stage(docs.sparkSession, "collocations")
    table = frequent_phrases(
        docs, stage, rules, text_col=text_col, lang_col=lang_col, block_bytes=block_bytes, part_words=part_words
    )
    totals = table.where("phrase IS NULL").groupBy("lang").agg(F.sum("a").alias("n"))
    phrases = table.where("phrase IS NOT NULL")
    found = phrases.where("words > 1").withColumn("w", F.split("phrase", " "))
    # A phrase that holds another one has an extension of it by one word at least as often, so those decide.
    longer = found.where("words > 2").select(
        "lang", F.explode(F.array(_slice("w", "1", "words - 1"), _slice("w", "2", "words - 1"))).alias("phrase"), F.col("a").alias("longer")
    ).groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    alone = found.join(longer, ["lang", "phrase"], "left").where(
        f"longer IS NULL OR CAST(longer AS DECIMAL(20,0)) * 100 < CAST(a AS DECIMAL(20,0)) * {rules.subsumed}"
    )
    cuts = alone.withColumn("k", F.explode(F.expr("sequence(1, words - 1)"))).select(
        "lang", "phrase", "a", "k", _slice("w", "1", "k").alias("left_part"), _slice("w", "k + 1", "words - k").alias("right_part")
    )
    left = phrases.select("lang", F.col("phrase").alias("left_part"), F.col("a").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right_part"), F.col("a").alias("r"))
    scored = cuts.join(left, ["lang", "left_part"]).join(right, ["lang", "right_part"]).withColumn(
        "score", F.expr("(CAST(a AS DECIMAL(20,0)) * 2000000) div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))")
    )
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "cut.score"
    )
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    group = F.pmod(F.xxhash64("phrase"), F.lit(_RANK_GROUPS))
    first = weakest.withColumn("group", group).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang", "group").orderBy(*order))
    ).where(F.col("rank") <= rules.top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= rules.top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
