"""Vector code compression, against the same rounds done plainly."""

import hashlib
import math
import random

import pytest

from tributary.llm import vector_codes
from tributary.llm.vector_codes import Codes


def plain_codes(rows, codes):
    """{(id, label, code, error)} counts and codebooks of (id, label, vector) rows of one length."""
    kept = [(i, la, [math.floor(codes.scale * x) for x in v]) for i, la, v in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0], r[2]))
    size = len(kept[0][2]) // codes.parts
    cut = [[v[p * size:p * size + size] for p in range(codes.parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[:codes.entries]] for p in range(codes.parts)]

    def best(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, entry)), e) for e, entry in enumerate(book))

    for _ in range(codes.rounds):
        for p in range(codes.parts):
            members = {}
            for c in cut:
                members.setdefault(best(c[p], books[p])[1], []).append(c[p])
            for e, of in members.items():
                books[p][e] = [sum(x) // len(of) for x in zip(*of)]
    out = []
    for (i, la, _), c in zip(kept, cut):
        found = [best(c[p], books[p]) for p in range(codes.parts)]
        out.append((i, la, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)))
    return out, books


def with_totals(coded):
    totals = {}
    for _, label, _, error in coded:
        totals[label] = totals.get(label, 0) + (error or 0)
    return sorted(((*r, totals[r[1]]) for r in coded), key=str)


@pytest.mark.parametrize("n,owner_parts", [(500, 1_000_000), (500, 40), (7, 5)])
def test_rounds(spark, n, owner_parts):
    rng = random.Random(n)
    codes = Codes(parts=4, entries=16, rounds=6, scale=4096)
    centres = [[rng.gauss(0, 1) for _ in range(12)] for _ in range(9)]
    rows = [(rng.randrange(n), rng.choice([0, 0, 1, None]), [x + rng.gauss(0, 0.2) for x in rng.choice(centres)]) for _ in range(n)]
    # A third of all rows are copies.
    rows += [(n + i, 5, rows[0][2]) for i in range(n // 2)] + [(None, 0, rows[1][2]), (3, 3, [100_000.0] * 12)]
    bad = [(1, 0, None), (2, 0, [math.nan] + [0.0] * 11), (3, 0, [math.inf] + [0.0] * 11), (4, 0, [None] + [0.0] * 11)]
    df = spark.createDataFrame([(i, la, v, "x") for i, la, v in rows + bad], "vec_id long, label int, embedding array<double>, code string").repartition(5)
    books = vector_codes.train(df, codes=codes, owner_parts=owner_parts)
    expected, plain_books = plain_codes(rows, codes)
    assert books.books[12].tolist() == plain_books
    assert books.sha256() == hashlib.sha256(",".join(str(x) for b in plain_books for e in b for x in e).encode()).hexdigest()
    coded, _ = vector_codes.compress(df, codes=codes)
    assert sorted(map(tuple, coded.collect()), key=str) == with_totals(expected)
    encoded = vector_codes.encode(df, books)
    assert encoded.columns == ["vec_id", "label", "embedding", "code", "_code", "error"] and encoded.count() == len(rows)


def test_other_lengths_and_large_components(spark):
    rng = random.Random(1)
    long = [(i, 0, [rng.random() for _ in range(8)]) for i in range(40)]
    short = [(i, 0, [rng.random() for _ in range(4)]) for i in range(40)]
    odd = [(50, 9, []), (51, 9, [1.0, 2.0, 3.0]), (52, 9, [1e40] * 8), (53, None, [1e300] * 4)]
    df = spark.createDataFrame(long + short + odd, "vec_id long, label int, embedding array<double>")
    codes = Codes(parts=4, entries=4, rounds=3)
    found, books = vector_codes.compress(df, codes=codes)
    plain = [plain_codes(rows, codes) for rows in (short, long)]
    assert [books.books[n].tolist() for n in (4, 8)] == [b for _, b in plain]
    expected = with_totals(plain[0][0] + plain[1][0])
    rows = sorted(map(tuple, found.collect()), key=str)
    assert [r for r in rows if r[2] is not None] == expected
    assert {(r[0], r[1], r[3], r[4]) for r in rows if r[2] is None} == {(i, la, None, None) for i, la, _ in odd}


def test_nothing_to_code(spark):
    df = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    found, books = vector_codes.compress(df)
    assert found.count() == 0 and books.sha256() == hashlib.sha256(b"").hexdigest()
    found, _ = vector_codes.compress(spark.createDataFrame([(1, None, None)], df.schema))
    assert found.count() == 0
