"""Substring deduplication and collocations, against brute force and SQL."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from compare import compare, connect

from tributary.llm import blocks, collocations, substring_dedup
from tributary.llm.collocations import Rules
from tributary.llm.queries import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, sf_dir, name):
    assert compare(spark, connect(sf_dir), name, QUERIES[name], ORACLES[name], sf_dir) is None


# --- blocks -----------------------------------------------------------------------------------------


def test_words_are_hashed_by_their_bytes_wherever_they_stand():
    texts = ["a  bc\td", "", "é x", "bc", " ", "x" * (1 << 19) + " bc " + "y" * 300_000, "d\x0ba"]
    data, offsets = blocks.text_buffer(pa.chunked_array([[*texts[:3]], texts[3:]]))
    words = blocks.words_of(data, offsets, substring_dedup.KINDS)
    raw = data.tobytes()
    found = [(int(d), raw[a:b].decode()) for d, a, b in zip(words.doc, words.start, words.end)]
    assert found == [(i, w) for i, t in enumerate(texts) for w in WORD.findall(t)]
    by_word = defaultdict(set)
    for (_, w), h in zip(found, words.hash.tolist()):
        by_word[w].add(h)
    assert all(len(h) == 1 for h in by_word.values()) and len(set.union(*by_word.values())) == len(by_word)


def test_numbers_survive_the_way():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 1 << 63, 1000).astype(np.uint64) * np.uint64(2)
    assert (blocks.expand(blocks.squeeze(values), 1000) == values).all()
    assert (blocks.expand_sorted(blocks.squeeze_sorted(np.sort(values)), 1000) == np.sort(values)).all()
    signed = np.array([-1, 0, 1 << 62, -(1 << 63)])
    assert (blocks.expand(blocks.squeeze(signed), 4, np.int64) == signed).all()
    assert len(blocks.expand(blocks.squeeze(values[:0]), 0)) == 0
    flags = rng.random(13) < 0.5
    assert (blocks.expand_bits(blocks.squeeze_bits(flags), 13) == flags).all()


# --- substrings -------------------------------------------------------------------------------------


def plain_dedup(rows, size):
    """(id, n_words, n_removed, kept) of (id, text) rows."""
    docs = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, words in docs:
        for j in range(len(words) - size + 1) if i is not None else ():
            key = tuple(words[j:j + size])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in docs:
        gone = set()
        for j in range(len(words) - size + 1) if i is not None else ():
            if first[tuple(words[j:j + size])] < i:
                gone.update(range(j, j + size))
        out.append((i, len(words), len(gone), " ".join(w for j, w in enumerate(words) if j not in gone)))
    return out


def some_texts(seed=0, n=120):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh")
    shared = [" ".join(word() for _ in range(k)) for k in (3, 4, 5, 9, 40)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.6 else " ".join(word() + str(rng.randrange(9)) for _ in range(rng.randrange(6)))
                 for _ in range(rng.randrange(8))]
        rows.append((rng.randrange(n), rng.choice([" ", "\n", " \t "]).join(parts)))
    odd = [(None, shared[4]), (5, None), (-7, ""), (n, " \n "), (n + 1, shared[4]), (n + 1, shared[4]), (1 << 40, "x " * 30_000 + shared[4])]
    return rows + rows[:10] + odd


@pytest.mark.parametrize("size,block_bytes", [(4, 200), (4, 1 << 20), (1, 500), (13, 300)])
def test_passages_of_smaller_ids_go(spark, size, block_bytes):
    rows = some_texts()
    df = spark.createDataFrame([(*r, "kept") for r in rows], "doc_id long, text string, n_words string").repartition(3)
    parsed = substring_dedup.parse(df, size=size, block_bytes=block_bytes, part_words=50)
    assert parsed.columns == ["doc_id", "text", "n_words", "_n_words", "n_removed", "kept_text", "factors"]
    found = parsed.collect()
    key = lambda r: tuple((x is None, x) for x in r)
    ours = [(r["doc_id"], r["_n_words"], r["n_removed"], r["kept_text"]) for r in found]
    assert sorted(ours, key=key) == sorted(plain_dedup(rows, size), key=key)
    texts = defaultdict(set)
    for r in found:
        words = WORD.findall(r["text"] or "")
        texts[r["doc_id"]].update(tuple(words[j:j + size]) for j in range(len(words) - size + 1))
    for r in found:
        words, end = WORD.findall(r["text"] or ""), 0
        for f in r["factors"]:
            assert f["start"] >= end and f["source"] < r["doc_id"]
            end = f["start"] + f["n_words"]
            assert {tuple(words[j:j + size]) for j in range(f["start"], end - size + 1)} <= texts[f["source"]]
        assert sum(f["n_words"] for f in r["factors"]) == r["n_removed"]
    left = substring_dedup.deduplicated(df, size=size, block_bytes=block_bytes)
    assert left.columns == df.columns
    assert sorted((r["text"] for r in left.collect())) == sorted(r[3] for r in plain_dedup(rows, size))


def test_dedup_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert substring_dedup.parse(df).count() == 0
    df = spark.createDataFrame([(1, None), (2, "")], "doc_id int, text string")
    assert sorted(tuple(r)[2:5] for r in substring_dedup.parse(df).collect()) == [(0, 0, ""), (0, 0, "")]


# --- collocations -----------------------------------------------------------------------------------


def plain_collocations(rows, rules):
    counts, totals = Counter(), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, rules.longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i:i + m])] += 1
    longer = Counter()
    for (lang, p), c in counts.items():
        if c >= rules.at_least and len(p) > 2:
            for part in {p[a:b] for a in range(len(p)) for b in range(a + 2, len(p) + 1) if b - a < len(p)}:
                longer[lang, part] = max(longer[lang, part], c)
    by_lang = defaultdict(list)
    for (lang, p), a in counts.items():
        if a >= rules.at_least and len(p) > 1 and not (longer[lang, p] and 100 * longer[lang, p] >= rules.subsumed * a):
            score, k = min((2_000_000 * a // (counts[lang, p[:k]] + counts[lang, p[k:]]), k) for k in range(1, len(p)))
            by_lang[lang].append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    return sorted(
        (lang, i, p.decode(), -a, left, r, totals[lang], -s)
        for lang, found in by_lang.items() for i, (s, a, p, left, r) in enumerate(sorted(found)[:rules.top], 1)
    )


@pytest.mark.parametrize("rules,block_bytes", [
    (Rules(at_least=3, top=25), 300), (Rules(at_least=2, subsumed=50), 1 << 20), (Rules(longest=5, at_least=2), 200), (Rules(longest=1), 200),
])
def test_phrases(spark, rules, block_bytes):
    rng = random.Random(3)
    words = ["A", "b", "Ça", "Zz", "the", "THE", "x-y", "\x00", "naïve"]
    rows = []
    for _ in range(150):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", " the A b "]) for _ in range(rng.randrange(12)))
        rows.append((text, rng.choice(["en", "en", "de", None, "und", ""])))
    rows += rows[:40] + [(None, "en"), ("", None), (" ,,.", "xx"), ("the b " * 20_000, "en")]
    df = spark.createDataFrame([(t, lang, 7) for t, lang in rows], "text string, lang string, phrase int").repartition(4)
    found = collocations.collocations(df, rules=rules, block_bytes=block_bytes, part_words=200)
    assert [t for c, t in found.dtypes if c in ("rank", "a", "l", "r", "n", "score")] == ["bigint"] * 6
    assert sorted(map(tuple, found.collect())) == plain_collocations(rows, rules)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(df).count() == 0
    assert collocations.collocations(spark.createDataFrame([(None, None), ("", "en")], df.schema)).count() == 0


def test_hash_of_kept_words(spark, sf_dir):
    row = QUERIES["op11_substring_dedup"](spark, sf_dir).where("n_words = 0").first()
    assert row is None or row["kept_sha256"] == hashlib.sha256(b"").hexdigest()
