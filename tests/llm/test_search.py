"""Permutation index and n-gram Jaccard join, against brute force."""

import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from tributary.llm import jaccard_join, permutation_index, queries
from tributary.llm.common import Stage, table
from tributary.llm.jaccard_join import Similar

LONG = "vec_id long, embedding array<float>, score string"


def plain_nearest(rows, every, k):
    ids = np.array([i for i, _ in rows])
    vectors = np.array([v for _, v in rows], np.float32).astype(np.float64)
    norms = np.sqrt((vectors**2).sum(1))
    out = {}
    for i, v, n in zip(ids, vectors, norms):
        if i % every == 0:
            score = (vectors * v).sum(1) / (norms * n)
            keep = np.flatnonzero(ids != i)
            out[int(i)] = [(int(ids[j]), score[j]) for j in keep[np.lexsort((ids[keep], -score[keep]))][:k]]
    return out


def found_by(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        assert r["rank"] == len(out[r["query_id"]]) + 1
        out[r["query_id"]].append((r["vec_id"], r["score"]))
    return out


def test_small_tables_are_searched_exactly(spark):
    rng = np.random.default_rng(0)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 4).astype(np.float32)]) for i in range(60)]
    rows = [(i, v if any(v) else [1.0, 0.0, 0.0, 0.0]) for i, v in rows]
    odd = [(None, [1.0, 2.0, 3.0, 4.0]), (100, None), (105, [0.0] * 4), (110, [float("nan"), 1.0, 1.0, 1.0]), (115, [float("inf"), 1.0, 1.0, 1.0]), (120, [None, 1.0, 1.0, 1.0]), (125, [1.0, 2.0]), (130, [])]
    df = spark.createDataFrame([(*r, "x") for r in rows + rows[:20] + odd], LONG).repartition(4)
    found, expected = found_by(permutation_index.nearest(df, 5, 5)), plain_nearest(rows, 5, 5)
    assert found.keys() == expected.keys()
    for q, best in expected.items():
        assert [i for i, _ in found[q]] == [i for i, _ in best]
        assert np.allclose([s for _, s in found[q]], [s for _, s in best], rtol=0, atol=1e-15)
    few = found_by(permutation_index.nearest(df.where("vec_id < 3"), 2, 5))
    assert sorted(few) == [0, 2] and all(len(v) == 2 for v in few.values())
    assert permutation_index.nearest(df.limit(0), 5).count() == 0
    assert permutation_index.nearest(df.where("vec_id = 100"), 5).count() == 0


def test_doubles_and_other_lengths_are_searched(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=3) * 10.0 ** rng.integers(-160, 250)).tolist()) for i in range(40)]
    rows += [(i, rng.normal(size=2).tolist()) for i in range(40, 70)] + [(70, [1e40, 1.0]), (71, [1e40, -1e40])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = found_by(permutation_index.nearest(df, 10, 5))
    assert sorted(found) == [0, 10, 20, 30, 40, 50, 60, 70]
    by_id = dict(rows)

    def unit(v):
        v = np.array(v) / np.abs(v).max()
        return v / np.sqrt(v @ v)

    for q, best in found.items():
        scores = {i: unit(v) @ unit(by_id[q]) for i, v in rows if i != q and len(v) == len(by_id[q])}
        assert [i for i, _ in best] == sorted(scores, key=lambda i: -scores[i])[:5]
        assert np.allclose([s for _, s in best], [scores[i] for i, _ in best], rtol=0, atol=1e-12)


def test_recall_and_many_equal_vectors(spark):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(6000, 32)).astype(np.float32)
    vectors[1000:3000] = vectors[7]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    df = spark.createDataFrame([(*r, "x") for r in rows], LONG).repartition(8)
    found, expected = found_by(permutation_index.nearest(df, 50, 5)), plain_nearest(rows, 50, 5)
    hits = [len({i for i, _ in found[q]} & {i for i, _ in best}) / 5 for q, best in expected.items()]
    assert np.mean(hits) > 0.93
    assert [i for i, _ in found[1000]] == [7, 1001, 1002, 1003, 1004]


def test_footrule():
    order = np.array([[0, 1, 2], [2, 0, 3], [3, 1, 0]])
    files = permutation_index.inverted_files(order, 4)
    for query in ([0, 1, 2], [3, 2, 1]):
        plain = [sum(abs((row.index(p) if p in row else 3) - r) for r, p in enumerate(query)) for row in order.tolist()]
        assert permutation_index.footrules(np.array(query), files, 3, 3).tolist() == plain


def test_blocks_are_searched_for_several_queries_at_once():
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(700, 12))
    # Two that single precision does not tell apart from each other.
    vectors[300:320] = vectors[0] + rng.normal(size=(20, 12)) * 1e-9
    ids, index = np.arange(700) * 3, permutation_index.Index(pivots=24, posted=16, share=0.2, least=50)
    units = permutation_index._unit(vectors)
    pivots = permutation_index.choose_pivots(units[350:], index)
    order = permutation_index.permutations(units, pivots, 16)
    files = permutation_index.inverted_files(order, 24)
    many = permutation_index.footrules(order[:20], files, 700, 16)
    assert many.tolist() == [permutation_index.footrules(o, files, 700, 16).tolist() for o in order[:20]]
    found = permutation_index.search_block(ids, vectors, ids[:20], vectors[:20], pivots, index, 5)
    norms, expected = np.sqrt((vectors**2).sum(1)), []
    for q, distance in enumerate(many):
        near = np.flatnonzero((distance <= np.sort(distance)[139]) & (ids != ids[q]))
        score = (vectors[near] * vectors[q]).sum(1) / (norms[near] * norms[q])
        expected += [(q, int(near[i]), float(score[i])) for i in np.lexsort((ids[near], -score))[:5]]
    assert [f[:2] for f in found] == [f[:2] for f in expected]
    assert np.allclose([f[2] for f in found], [f[2] for f in expected], rtol=0, atol=1e-15)


def test_blocks_meet_without_copies_of_queries(spark):
    """Copies of the queries for every block outgrew the driver, where they were broadcast."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.normal(size=4).tolist()) for i in range(50)], "vec_id long, embedding array<double>")
    found = permutation_index.nearest(df, 5, 5)
    assert found.count() == 50
    plan = found._jdf.queryExecution().toString()
    assert "CartesianProduct" in plan and "Generate" not in plan and "Broadcast" not in plan


def test_sample_by_hashes_is_that_of_a_sort(spark):
    rng = np.random.default_rng(8)
    many = [(i, 1, [float(x) for x in rng.normal(size=2)]) for i in range(400)]
    one_id = [(7, 1, [float(x) for x in rng.normal(size=2)]) for _ in range(400)]
    copies = [(i, 1 + (i > 3), [1.0, 2.0]) for i in range(400)]
    stage = Stage(spark, "samples")
    for number, rows in enumerate((many, one_id, copies)):
        df = spark.createDataFrame(rows, "vec_id long, copy int, embedding array<double>").repartition(4)
        got = permutation_index._smallest_hashes(df, len(rows), 20, stage, f"s{number}").collect()
        expected = df.where("copy = 1").orderBy(F.xxhash64("vec_id"), "vec_id", "embedding").limit(20).collect()
        assert [(r["vec_id"], r["embedding"]) for r in got] == [(r["vec_id"], r["embedding"]) for r in expected]


def test_search_query_recall(spark, sf_dir):
    big = sf_dir.replace("sf0.001", "sf0.1")
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, big, "embeddings").collect()]
    found, expected = found_by(queries.op8_permutation_index(spark, big)), plain_nearest(rows, 50, 5)
    assert found.keys() == expected.keys()
    hits = [len({i for i, _ in found[q]} & {i for i, _ in best}) / 5 for q, best in expected.items()]
    assert np.mean(hits) >= 0.95


def plain_set(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)])


def plain_components(texts, how):
    """Component of each row by comparing all pairs; rows are (doc_id, text)."""
    sets = [plain_set(t, how.words) for _, t in texts]
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            same = len(sets[i] & sets[j])
            if same and 100 * same >= how.percent * (len(sets[i]) + len(sets[j]) - same):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(texts):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return [(len(s), least.get(root(i)) if s else key) for i, ((key, _), s) in enumerate(zip(texts, sets))]


def corpus(seed, base_words=120, copies=40):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 6))) for _ in range(400)]
    out = [None, "", " \n", "one", "one", "One", "one two", "two one"]
    boiler = rng.choices(vocabulary, k=30)
    for _ in range(6):
        base = rng.choices(vocabulary, k=rng.randint(base_words // 4, base_words))
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            out.append(" ".join(words))
        out += [" ".join(base)] * 5 + [" ".join(base).upper(), "  ".join(base) + "\n"]
    for _ in range(60):
        out.append(" ".join(boiler + rng.choices(vocabulary, k=rng.randint(0, 40))))
    for _ in range(60):
        out.append(" ".join(rng.choices(vocabulary[:3], k=rng.randint(1, 14))))
    rng.shuffle(out)
    return out


def test_join_by_brute_force(spark):
    for seed, how in ((1, Similar(3, 90)), (2, Similar(5, 80)), (3, Similar(3, 50)), (4, Similar(1, 100))):
        texts = list(enumerate(corpus(seed)))
        texts += [(None, texts[5][1]), (7, texts[9][1]), texts[11], texts[11], (None, "alone among all of them")]
        df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, n long").repartition(6)
        found = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.link(df, how).collect()), key=str)
        expected = sorted(((k, *c) for (k, _), c in zip(texts, plain_components(texts, how))), key=str)
        assert found == expected, (seed, how)


def plain_links(texts, how):
    """Links of each row by comparing all pairs."""
    sets = [plain_set(t, how.words) for _, t in texts]
    found = [0] * len(sets)
    for i, x in enumerate(sets):
        for j in range(i):
            same = len(x & sets[j])
            if same and 100 * same >= how.percent * (len(x) + len(sets[j]) - same):
                found[i] += 1
                found[j] += 1
    return found


def test_links_by_brute_force(spark, monkeypatch):
    for seed, how, block in ((1, Similar(3, 90), 1 << 18), (2, Similar(5, 80), 1500), (3, Similar(3, 50), 1500), (4, Similar(1, 100), 100)):
        monkeypatch.setattr(jaccard_join, "BLOCK", block)
        texts = list(enumerate(corpus(seed)))
        texts += [(None, texts[5][1]), (7, texts[9][1]), texts[11], texts[11], (None, "alone among all of them")]
        df = spark.createDataFrame([(*t, 1) for t in texts], "doc_id long, text string, n long").repartition(6)
        found = sorted(((r["doc_id"], r["n_links"]) for r in jaccard_join.link(df, how).collect()), key=str)
        links = plain_links(texts, how)
        assert max(links) > 8 and found == sorted(((k, n) for (k, _), n in zip(texts, links)), key=str), (seed, how)


def test_representatives(spark):
    how = Similar(5, 80)
    texts = list(enumerate(corpus(8)))
    df = spark.createDataFrame([(*t, "x", 1) for t in texts + texts[3:40]], "doc_id long, text string, key string, component long").repartition(6)
    kept = jaccard_join.representatives(df, how)
    assert kept.columns == df.columns
    expected = {k for (k, _), (n, c) in zip(texts, plain_components(texts, how)) if n and k == c}
    rows = kept.collect()
    assert sorted(r["doc_id"] for r in rows if plain_set(r["text"], 5)) == sorted(expected)
    assert sum(not plain_set(r["text"], 5) for r in rows) == sum(not plain_set(t, 5) for _, t in texts + texts[3:40])
    assert jaccard_join.representatives(df.limit(0), how).count() == 0 == jaccard_join.link(df.limit(0), how).count()


def test_components_of_long_paths_and_stars(spark):
    from tributary.llm.common import Stage

    pairs = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(200, 201), (201, 200)]
    df = spark.createDataFrame([(f"{a:04}".encode(), f"{b:04}".encode()) for a, b in pairs], "a binary, b binary")
    rows = jaccard_join.components(df, Stage(spark, "test"), "c").collect()
    assert {int(bytes(r["key"])): int(bytes(r["component"])) for r in rows} == {**{i: 0 for i in range(61)}, **{100 + i: 100 for i in range(50)}, 200: 200, 201: 200}


def test_join_query(spark, sf_dir):
    texts = sorted((r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect())
    rows = sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in queries.op10_jaccard_join(spark, sf_dir).collect())
    assert rows == [(k, *c) for (k, _), c in zip(texts, plain_components(texts, Similar(3, 90)))]
