import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as tx
from tidemark.llm.linear import WordWeights
from tidemark.sources.tables import table

SF = "/root/testdata/sf0.01"


def test_label_model_without_double_counting():
    rng = np.random.default_rng(3)
    n = 4000
    y = rng.random(n) < 0.2
    rates = [(0.7, 0.05), (0.6, 0.1), (0.5, 0.02), (0.3, 0.3)]
    votes = np.stack([np.where(y, rng.random(n) < a, rng.random(n) < b) for a, b in rates], axis=1)
    copies = np.repeat(votes[:, 3:], 6, axis=1)                     # six copies of a voter that knows nothing
    known = np.where(np.arange(n) < 600, y.astype(int), -1)
    post, model = tx.label_model(np.hstack([votes, copies]), known)
    plain, _ = tx.label_model(votes, known)
    assert ((plain[600:] > 0.5) == y[600:]).mean() > 0.9
    assert np.abs(post - plain).max() < 0.1                          # copies add nothing
    fires = model["fires"]
    strong = int(np.argmax(model["parent"] == np.arange(len(rates) + 6)))
    assert strong == 0 and fires[1, 0, 0] == pytest.approx(0.7, abs=0.06) and fires[0, 0, 0] == pytest.approx(0.05, abs=0.03)
    assert len(set(model["parent"][4:].tolist()) - {3, 4, 5, 6, 7, 8, 9}) == 0      # copies hang on one another


def test_mined_terms_and_votes():
    texts = ["Vequmo x.", "vequta y", "vequna z", "vequla", "plain x", "plain y"]
    assert tx.text_terms(texts[0]) == {"vequmo", "^vequ", "^vequm", "x"}
    assert tx.mine(texts, np.array([1, 1, 1, 1, 0, 0], bool), least=4, lift=2)[0] == "^vequ"
    votes = tx.votes(["you are an idiot!!", "fine"], ["idiot", "fine"])
    assert votes[0].tolist() == [True, False, True, False, True, False] and votes[1].tolist() == [False, True, False, False, False, False]


def test_scores_by_definition():
    weights = np.random.default_rng(4).normal(size=1 << tx.BITS)
    texts = ["", "idiot", "Idiot idiot, IDIOT scumbag", "a\nb a"]
    for text, got in zip(texts, tx.score_texts(texts, WordWeights(weights, tx.features, cache_words=2), -0.5)):
        total = sum(weights[tx.features(w)].sum() for w in set(text.lower().split()))
        assert got == pytest.approx(1 / (1 + np.exp(0.5 - total)))


def test_held_out_documents(spark):
    got = tx.toxicity(table(spark, SF, "documents"), table(spark, SF, "labels")).join(table(spark, SF, "labels"), "doc_id").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == (r["score"] >= 0.5) for r in got)
    held = [r for r in got if r["held_out"]]
    assert np.mean([r["predicted"] == r["toxic"] for r in held]) > 0.94
    assert sum(r["predicted"] for r in held if not r["toxic"]) <= 1


def test_held_out_labels_do_not_count(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    _, known = tx.training_sample(docs, labels, 50)
    assert (known >= 0).sum() == 50 and (known < 0).sum() == 50
    from pyspark.sql import functions as F
    turned = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tx.training_sample(docs, labels, 2000), tx.training_sample(docs, turned, 2000)
    assert a[0] == b[0] and a[1].tolist() == b[1].tolist()


def test_fit_takes_3000_rows_of_each_kind(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(tx, "fit", lambda texts, known: seen.update(known=known) or (np.zeros(1 << tx.BITS), 0.0))
    tx.toxicity(table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels"))
    assert (seen["known"] >= 0).sum() == 3000 and (seen["known"] < 0).sum() == 3000


def test_edge_rows(spark, edge_docs, no_docs):
    schema = "doc_id long, toxic int, quality int"
    labels = spark.createDataFrame([(1, 0, 1), (2, 1, 1), (6, None, 1), (None, 1, 1), (9, 0, 1), (77, 1, 0)], schema)
    got = tx.toxicity(edge_docs, labels).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in edge_docs.collect())
    assert all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (zlib.crc32(("null" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 5 == 0) for r in got)
    assert all(r["score"] < 1e-6 for r in tx.toxicity(edge_docs, labels.limit(0)).collect())
    assert tx.toxicity(no_docs, labels).count() == 0
