"""Byte-level BPE, the word encoder, the coder, the token store and packing."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tributary.llm import byte_bpe, packing, queries, rans, token_files
from tributary.llm.common import Stage
from tributary.llm.word_bpe import WordEncoder

WORD = Tokenizer.from_file(queries.WORD_BPE)
ENCODER = WordEncoder(queries.WORD_BPE)
BYTES = byte_bpe.encoding(queries.BYTE_BPE, public_tokenizers.PATTERN)
TEXT = st.text(alphabet=st.sampled_from("aBé.,;'s1 \n\t\r\x0b\x1c\x85 ́ ΣσİKſ中😀<|>"), max_size=60)
ODD = [None, "", " ", "a", "it's 12 o'clock.  \n\n x", "x" * 5000, "a b " * 3000, "中文 без 🙂 " * 50, "<|endoftext|> a. b, C."]


def ids_of(text):
    return np.array(WORD.encode(text or "", add_special_tokens=False).ids + [1], "<u4")


def test_capitals_and_marks_need_no_whole_step():
    """Latin-1 capitals, and marks after letters, go to the merging model; ids are those of the library."""
    encoder = WordEncoder(queries.WORD_BPE)
    words = ["Éourément", "ÀÞ", "réré,", "É.", "étre***", "les&&&", "the.", "aß--", "x|]`", "Çà!?.", "ÿ_", "þ\"#"]
    expected = [WORD.encode(f"{w} {w}\n", add_special_tokens=False).ids for w in words]

    class MarksOnly:
        def encode_batch_fast(self, texts, **how):
            assert not any(c.isalpha() for c in "".join(texts))
            return WORD.encode_batch_fast(texts, **how)

    encoder._known._tokenizer = MarksOnly()
    assert [np.frombuffer(encoder.encode(f"{w} {w}\n"), "<u4").tolist() for w in words] == expected


def test_letters_before_other_signs_are_left_to_the_library():
    for text in ("it's it're. don't", "×. ÷, ×, é×. ÷. ", "e\u0301. E\u0301, é\u0301. ", "a.b, c-d x.<|endoftext|> a<|startoftext|>.", "…. a…. ª, º. µ. "):
        assert np.frombuffer(ENCODER.encode(text), "<u4").tolist() == WORD.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(TEXT)
def test_words_encode_like_whole_texts(text):
    assert ENCODER.encode(text) == np.array(WORD.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(1, 9))
def test_safe_parts_change_no_id(text, part):
    assert "".join(byte_bpe.safe_parts(text, part)) == text
    assert byte_bpe.encode(BYTES, text, part) == BYTES.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(TEXT, st.integers(2, 4))
def test_runs_split_by_hand_change_no_id(text, run):
    assert byte_bpe.encode(BYTES, text, 1, run) == BYTES.encode_ordinary(text)


@pytest.mark.parametrize("n", [1_000_000, 5_000_000])
@pytest.mark.parametrize("unit", [" ", "\n", " \n\t", "\u3000"])
def test_very_long_runs(n, unit):
    run = (unit * (n // len(unit) + 1))[:n]
    single = BYTES._encode_single_piece
    assert byte_bpe.encode(BYTES, run) == single(run.encode())
    rest = run[-1] + "word"
    assert byte_bpe.encode(BYTES, "a" + run + "word") == BYTES.encode_ordinary("a") + single(run[:-1].encode()) + BYTES.encode_ordinary(rest)


def test_byte_bpe_round_trip(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a", "x"), (3, "a", "x")], "doc_id long, text string, n_tokens string")
    rows = byte_bpe.round_trip(df, queries.BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert len(rows) == len(ODD) + 2 and sum(r["doc_id"] is None for r in rows) == 1 and sum(r["doc_id"] == 3 for r in rows) == 2
    for r in rows:
        text = "a" if r["doc_id"] is None else ODD[r["doc_id"]] or ""
        ids = BYTES.encode_ordinary(text)
        assert r["n_tokens"] == len(ids) and r["lossless"]
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    ids = byte_bpe.encode_documents(df, queries.BYTE_BPE, public_tokenizers.PATTERN)
    back = byte_bpe.decode_documents(ids, queries.BYTE_BPE, public_tokenizers.PATTERN).collect()
    assert sorted(bytes(r["data"]) for r in back) == sorted([(t or "").encode() for t in ODD] + [b"a", b"a"])
    assert byte_bpe.round_trip(df.limit(0), queries.BYTE_BPE, public_tokenizers.PATTERN).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3000), st.integers(1, 300), st.integers(0, 99))
def test_coder_round_trip(n, alphabet, seed):
    symbols = np.minimum(np.random.default_rng(seed).zipf(1.3, n), alphabet) - 1 if n else np.empty(0, np.int64)
    table = rans.Table(rans.normalized(np.bincount(symbols, minlength=alphabet)))
    data = rans.encode(symbols, table)
    assert (rans.decode(data, table) == symbols).all()
    assert (rans.decode(data, table, n // 3, n // 2) == symbols[n // 3 : n // 2]).all()


def test_coder_reads_from_checkpoints_and_finds_faults():
    symbols = np.random.default_rng(1).integers(0, 50, 3 * rans.CHECKPOINT + 77)
    table = rans.Table(rans.normalized(np.bincount(symbols)))
    data = rans.encode(symbols, table)
    for start in (0, rans.CHECKPOINT - 1, rans.CHECKPOINT, 2 * rans.CHECKPOINT + 5, 3 * rans.CHECKPOINT + 70):
        assert (rans.decode(data, table, start, start + 90) == symbols[start : start + 90]).all()
    for at in (0, 30, len(data) // 2, len(data) - 1):
        with pytest.raises(rans.Corrupt):
            rans.decode(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :], table)
    with pytest.raises(ValueError):
        rans.encode(np.array([60]), table)
    assert rans.normalized(np.array([1, 0, 10**9])).tolist()[:2] == [1, 0]


def test_token_store(spark):
    rows = [(i * 7 % 23 - 5, ODD[i % len(ODD)]) for i in range(23)] + [(3, "twice"), (3, "twice"), (3, "more"), (None, "none")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for shard_docs in (4, 1000):
        path = Stage(spark, "store").root
        token_files.write_tokens(df, path, queries.WORD_BPE, 1, shard_docs)
        found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
        order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
        assert [r["doc_id"] for r in found] == [k for k, _ in order]
        start = 0
        expected = defaultdict(list)
        for key, text in rows:
            expected[key].append(ids_of(text).tolist())
        for r in found:
            assert r["start"] == start and r["ids"] in expected[r["doc_id"]]
            expected[r["doc_id"]].remove(r["ids"])
            assert r["n_tokens"] == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
            start += len(r["ids"])
    path = Stage(spark, "store").root
    token_files.write_tokens(df.limit(0), path, queries.WORD_BPE)
    assert token_files.read_tokens(spark, path).count() == 0


def check_packing(lengths, pieces, capacity):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in pieces:
        by_doc[doc].append((start, n))
        by_sequence[sequence].append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, m in sorted(by_doc[doc]):
            assert start == at and m > 0
            at += m
        assert at == n
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    assert padding == 0 and sorted(by_sequence) == list(range(len(by_sequence)))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=60))
def test_pack(lengths):
    check_packing(lengths, packing.pack(lengths, packing.Packing(capacity=16)), 16)


def test_pack_balances_cost():
    rng = random.Random(3)
    lengths = [rng.randint(1, 700) for _ in range(2000)]
    how = packing.Packing()
    pieces = packing.pack(lengths, how)
    check_packing(lengths, pieces, 2048)

    def spread(placed):
        cost, size = defaultdict(float), defaultdict(int)
        for _, _, n, sequence, _ in placed:
            cost[sequence] += how.linear * n + how.quadratic * n * n
            size[sequence] += n
        return np.std([c for s, c in cost.items() if size[s] > 1900])

    # The plain way: the first sequence with room, in the same order.
    plain, used = [], []
    for doc in sorted(range(len(lengths)), key=lambda d: -lengths[d]):
        s = next((i for i, u in enumerate(used) if u + lengths[doc] <= 2048), len(used))
        used += [0] * (s == len(used))
        plain.append((doc, 0, lengths[doc], s, used[s]))
        used[s] += lengths[doc]
    assert spread(pieces) < spread(plain)


def test_pack_documents(spark):
    rows = [(i, ODD[i % len(ODD)]) for i in range(40)] + [(None, "none"), (3, "twice"), (3, "twice")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, offset int").repartition(3)
    found = packing.pack_documents(df, queries.WORD_BPE, how=packing.Packing(group_tokens=3000)).collect()
    sequences, documents = defaultdict(list), defaultdict(int)
    for r in found:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        documents[r["doc_id"]] += r["length"]
        assert r["length"] == len(r["ids"]) // 4 and r["ids_crc32"] == zlib.crc32(r["ids"])
        if r["doc_id"] is not None and r["doc_id"] != 3:
            ids = ids_of(rows[r["doc_id"]][1])
            assert r["doc_tokens"] == len(ids) and bytes(r["ids"]) == ids[r["start"] : r["start"] + r["length"]].tobytes()
    for parts in sequences.values():
        assert sum(n for _, n in parts) <= 2048 and sorted(parts)[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in zip(sorted(parts), sorted(parts)[1:]))
    assert documents[None] == len(ids_of("none")) and documents[3] == len(ids_of(ODD[3])) + 2 * len(ids_of("twice"))
    assert packing.pack_documents(df.limit(0), queries.WORD_BPE).count() == 0


def test_queries(spark, sf_dir):
    texts = {r["doc_id"]: r["text"] for r in queries.table(spark, sf_dir, "documents").collect()}
    ids = {k: ids_of(t) for k, t in texts.items()}
    start = 0
    stored = {r["doc_id"]: r for r in queries.op5_token_files(spark, sf_dir).collect()}
    for key in sorted(ids):
        r = stored[key]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids[key]), zlib.crc32(ids[key].tobytes()))
        start += len(ids[key])
    pieces = queries.op7_packing(spark, sf_dir).collect()
    assert sum(r["length"] for r in pieces) == start
    for r in pieces:
        part = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(part.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])
    for r in queries.op4_byte_bpe(spark, sf_dir).collect():
        expected = np.array(BYTES.encode_ordinary(texts[r["doc_id"]]), "<u4").tobytes()
        assert r["ids_sha256"] == hashlib.sha256(expected).hexdigest() and r["lossless"]


def test_an_id_of_a_third_of_all_rows_spans_shards(spark, tmp_path):
    rows = [(i, f"own {i}") for i in range(200)] + [(77, f"shared {i % 40}") for i in range(150)] + [(None, "none")] * 50
    df = spark.createDataFrame(rows, "doc_id long, text string")
    stores = []
    for n, parts in ((0, 3), (1, 7)):
        path = f"{tmp_path}/{n}"
        token_files.write_tokens(df.repartition(parts), path, queries.WORD_BPE, 1, shard_docs=20)
        spans = spark.read.parquet(f"{path}/blocks").where("shard IS NOT NULL").groupBy("shard").count().count()
        assert spans > 10
        found = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
        keys = [-1 if r["doc_id"] is None else r["doc_id"] for r in found]
        assert keys == sorted(keys) and len(found) == len(rows)
        total = 0
        for r in found:
            assert r["start"] == total
            total += r["n_tokens"]
        stores.append([(r["doc_id"], r["start"], r["ids_crc32"]) for r in found])
    assert stores[0] == stores[1]
