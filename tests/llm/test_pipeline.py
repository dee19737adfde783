"""The pipeline's stages, one by one against plain versions, and on odd rows."""

from collections import defaultdict

import numpy as np
import pytest
from test_scores import plain_severity, plain_spans, plain_statistics
from test_search import plain_components, plain_set
from tokenizers import Tokenizer

import corpus_pipeline
from tributary.llm import quality, secrets, toxicity
from tributary.llm.common import Stage, table
from tributary.llm.jaccard_join import Similar

WORD = Tokenizer.from_file(corpus_pipeline.WORD_BPE)


@pytest.fixture(scope="module")
def kept(spark, sf_dir):
    """What each stage keeps, by name, as run() hands it on."""
    stage = Stage(spark, "test-pipeline")
    docs = {"documents": table(spark, sf_dir, "documents")}
    before = "documents"
    for name, step in corpus_pipeline.STAGES:
        docs[name] = stage.keep(step(spark, docs[before], sf_dir), name)
        before = name
    return docs


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_stages_and_columns(kept):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_duplicates", "secrets", "packing"]
    for name in ("toxicity", "quality", "near_duplicates", "secrets"):
        assert kept[name].dtypes == kept["documents"].dtypes


def test_toxicity(spark, sf_dir, kept):
    model = toxicity.learn(kept["documents"], table(spark, sf_dir, "labels"))
    before, after = rows(kept["documents"]), rows(kept["toxicity"])
    for key, r in before.items():
        likely = 1 / (1 + np.exp(-np.clip(sum(model.weights.get(f, 0.0) for w in toxicity.words_of(r["text"]) for f in toxicity.features_of(w)) - model.cuts[0], -40, 40)))
        assert (key in after) == (likely < toxicity.LEAST_TOXIC)
        assert key not in after or after[key] == r
    assert plain_severity(model, "") < 0.5


def test_quality(spark, sf_dir, kept):
    model = quality.learn(kept["toxicity"], table(spark, sf_dir, "labels"))
    before, after = rows(kept["toxicity"]), rows(kept["quality"])
    for key, r in before.items():
        n, _, _, _, repeats = plain_statistics(r["text"])
        score = model.probability(np.array([quality.statistics(r["text"])[1]]))[0]
        assert (key in after) == (n >= 10 and 100 * repeats <= 20 * n and score >= quality.LEAST_QUALITY)
        assert key not in after or after[key] == r


def test_near_duplicates(kept):
    before, after = rows(kept["quality"]), rows(kept["near_duplicates"])
    texts = sorted((k, r["text"]) for k, r in before.items())
    expected = {k for (k, _), (n, c) in zip(texts, plain_components(texts, Similar(5, 80))) if not n or k == c}
    assert set(after) == expected and all(after[k] == before[k] for k in expected)


def test_secrets(kept):
    formats = secrets.learn_from(kept["near_duplicates"])
    before, after = rows(kept["near_duplicates"]), rows(kept["secrets"])
    assert before.keys() == after.keys()
    for key, r in after.items():
        assert r["text"] == secrets.redact(before[key]["text"], formats) and r["n_chars"] == len(r["text"])
        assert not plain_spans(r["text"])


def test_packing(kept):
    texts = rows(kept["secrets"])
    parts, sequences = defaultdict(list), defaultdict(list)
    for r in kept["packing"].collect():
        parts[r["doc_id"]].append((r["start"], bytes(r["ids"])))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for key, r in texts.items():
        ids = np.array(WORD.encode(r["text"], add_special_tokens=False).ids + [1], "<u4")
        assert b"".join(p for _, p in sorted(parts[key])) == ids.tobytes()
    assert parts.keys() == texts.keys()
    for placed in sequences.values():
        at = 0
        for offset, n in sorted(placed):
            assert offset == at
            at += n
        assert at <= 2048 and (at == 2048 or at & (at - 1) == 0)


def test_run_gives_the_last_stage(spark, sf_dir, kept):
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    assert sorted(corpus_pipeline.run(spark, sf_dir).select(columns).collect()) == sorted(kept["packing"].select(columns).collect())


def test_odd_rows(spark, sf_dir):
    good = table(spark, sf_dir, "documents").where("doc_id < 40").select("doc_id", "text", "lang", "source", "n_chars")
    odd = [(None, None, None, None, None), (1000, None, "en", "s", 0), (1001, "", "en", "s", 0), (None, "long words " * 4000, "en", "s", 1), (1002, "twice told tale", "en", "s", 1), (1002, "twice told tale", "en", "s", 1)]
    docs = good.unionByName(spark.createDataFrame(odd, good.schema)).union(good.limit(5))
    docs = docs.selectExpr("*", "1 AS set_key", "2 AS spans", "3 AS kept", "4 AS toxic", "map('a', 1) AS extra")
    for name, step in corpus_pipeline.STAGES[:-1]:
        after = step(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        n = after.count()
        assert n <= docs.count() and step(spark, docs.limit(0), sf_dir).count() == 0
        if name == "near_duplicates":
            ids = [r["doc_id"] for r in after.collect() if plain_set(r["text"], 5) and r["doc_id"] is not None]
            assert len(ids) == len(set(ids))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).count() >= docs.count()
