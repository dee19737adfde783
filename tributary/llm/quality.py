"""Quality rules: fixed limits, and gradient-boosted trees over statistics of each document."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.boosting import Trees, fit
from tributary.llm.common import Stage, kept_rows, labelled_sample, named, over_rows, texts

_SPACES = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"
#: Words in a window that may repeat, least words of a document, most repeated words in percent.
WINDOW, LEAST_WORDS, MOST_REPEATED = 5, 10, 20

#: Statistics the trees see, and whether the verdict may only rise (+1) or fall (-1) with them.
FEATURES = {
    "log_words": 0, "mean_word": 0, "symbols_per_word": -1, "repeated_words": -1, "repeated_lines": -1,
    "distinct_words": 0, "upper_share": 0, "digit_share": 0, "letter_share": 0, "mark_share": 0,
    "words_per_line": 0, "lines_ended": 0, "longest_word": 0, "single_marks": -1,
}
MONOTONE = np.array(list(FEATURES.values()))
#: Labelled documents the trees are fitted on, at most: those whose ids have the smallest hashes.
SAMPLE = 12_000
#: Kept from this probability of good quality on.
LEAST_QUALITY = 0.5

_LETTERS = re.compile(r"[^\W\d_]+")
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]+")
_MARKS = re.compile(r"[!?#*$%&|<>@~^]+")


def repeated(words: list[bytes], window: int = WINDOW) -> int:
    """Words that lie in a window found twice or more in the text, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    mixed = h[:n].copy()
    for i in range(1, window):
        mixed = mixed * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n]
        mixed ^= mixed >> np.uint64(29)
    order = np.argsort(mixed, kind="stable")
    same = mixed[order][1:] == mixed[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, np.int64)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    # A word is covered if one of the windows that hold it is found twice.
    sums = np.concatenate([[0], np.cumsum(np.concatenate([twice, np.zeros(window - 1, np.int64)]))])
    first = np.maximum(np.arange(len(words)) - window + 1, 0)
    return int((sums[1:] > sums[first]).sum())


def statistics(text: str) -> tuple[tuple[int, int, int, int, int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words), and the trees' features in order."""
    words = text.encode().split()
    n, chars = len(words), len(text)
    spaces = sum(map(text.count, _SPACES))
    word_chars = chars - spaces
    symbols = sum(map(text.count, _SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(_SPACES)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeated(words)
    letters = sum(map(len, _LETTERS.findall(text)))
    marks = _MARKS.findall(text)
    per_word, per_char, per_line = 1 / max(n, 1), 1 / max(word_chars, 1), 1 / max(len(lines), 1)
    features = [
        np.log1p(n), word_chars * per_word, symbols * per_word, repeats * per_word, dup_lines * per_line,
        len(set(words)) * per_word, sum(map(len, _UPPER.findall(text))) * per_char,
        sum(map(text.count, "0123456789")) * per_char, letters * per_char, sum(map(len, marks)) * per_char,
        n * per_line, sum(x.rstrip(_SPACES).endswith((".", "!", "?")) for x in lines) * per_line,
        float(max(map(len, words), default=0)), len(marks) * per_word,
    ]
    return (n, word_chars, symbols, dup_lines, repeats), features


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED * n_words


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, label: str = "quality") -> Trees:
    """Fit the trees on labelled documents, see `labelled_sample`.

    The sample has a fixed bound at any size, so its statistics reach the driver.
    """
    stage = Stage(docs.sparkSession, "quality")
    labelled = labelled_sample(docs, labels, named(label), sample, stage)

    def run(batches):
        for batch in batches:
            found = [statistics(t)[1] for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "label", "x"])

    rows = over_rows(labelled, ["doc_id", "text", F.col("label").cast("double")], run, "doc_id long, label double, x array<double>").collect()
    stage.drop("labelled")
    rows.sort(key=lambda r: (r["doc_id"], r["label"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r["label"] for r in rows]), MONOTONE)


def judge(docs: DataFrame, model: Trees, least: float = LEAST_QUALITY) -> DataFrame:
    """Statistics and verdict of every whole text.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept (not
    base_failed, and a quality of at least `least`), quality. A null or empty text has no words and fails.
    Rows that repeat are returned as often; a null doc_id stays null. Texts are read whole, whatever their length.
    An empty table gives an empty table. Other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            found = [statistics(t) for t in texts(batch)]
            quality = shared.value.probability(np.array([f for _, f in found]).reshape(len(found), len(FEATURES)))
            counts = [pa.array([c[i] for c, _ in found], pa.int64()) for i in range(5)]
            failed = np.array([base_failed(c[0], c[4]) for c, _ in found], bool)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *counts, pa.array(failed), pa.array(~failed & (quality >= least)), pa.array(quality)],
                names=["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"],
            )

    schema = (
        "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
        " base_failed boolean, kept boolean, quality double"
    )
    return over_rows(docs, ["doc_id", "text"], run, schema)


def kept(docs: DataFrame, model: Trees, least: float = LEAST_QUALITY) -> DataFrame:
    """The rows that `judge` keeps, all their columns unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        def good(some: list[str]) -> list[bool]:
            found = [statistics(t) for t in some]
            quality = shared.value.probability(np.array([f for _, f in found]).reshape(len(found), len(FEATURES)))
            return [not base_failed(c[0], c[4]) and bool(q >= least) for (c, _), q in zip(found, quality)]

        return good

    return kept_rows(docs, "text", judge)
