import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import quality
from tidemark.llm.linear import WordWeights, sigmoid
from tidemark.sources.tables import table

SF = "/root/testdata/sf0.01"


def loss(scores, cuts, grades):
    edges = np.concatenate(([-np.inf], cuts, [np.inf]))
    return -np.log(sigmoid(edges[grades + 1] - scores) - sigmoid(edges[grades] - scores)).mean()


def test_gradient_of_the_link():
    rng = np.random.default_rng(0)
    grades, scores, cuts = rng.integers(0, 4, 30), rng.normal(size=30), np.array([-1.0, 0.2, 1.5])
    by_score, by_cut = quality.link_gradient(grades, 3)(scores, cuts)
    for k in range(3):
        step = np.eye(3)[k] * 1e-6
        assert by_cut[k] == pytest.approx((loss(scores, cuts + step, grades) - loss(scores, cuts - step, grades)) / 2e-6, abs=1e-6)
    for i in range(5):
        step = np.eye(30)[i] * 1e-6
        assert by_score[i] / 30 == pytest.approx((loss(scores + step, cuts, grades) - loss(scores - step, cuts, grades)) / 2e-6, abs=1e-6)


def test_ordered_grades_are_learned():
    rng = np.random.default_rng(1)
    pools = [["junk", "|||"], ["fair", "plain"], ["good", "fine"], ["best", "top"]]
    grades = rng.integers(0, 4, 600)
    texts = [" ".join(rng.choice(pools[g] + ["the", "of"], 30)) for g in grades]
    weights, cuts = quality.fit(texts[:400], grades[:400])
    assert (np.diff(cuts) >= 0).all()
    scores = quality.score_texts(texts[400:], WordWeights(weights, quality.features))
    assert ((scores[:, None] >= cuts).sum(axis=1) == grades[400:]).mean() > 0.95


def test_scores_by_definition():
    rng = np.random.default_rng(2)
    weights = rng.normal(size=1 << quality.BITS)
    texts = ["", "a", "a a b", "X x!! 12 12 12", "  a\n\na "]
    for text, got in zip(texts, quality.score_texts(texts, WordWeights(weights, quality.features))):
        words = text.split()
        total = sum(weights[quality.features(w)].sum() for w in words) + weights[quality.REPEATED] * sum(a == b for a, b in zip(words, words[1:]))
        assert got == pytest.approx(total / max(1, len(words)))


def test_held_out_documents(spark):
    labels = table(spark, SF, "labels")
    seen = F.crc32(F.col("doc_id").cast("string")) % 3 != 0
    got = (quality.select(table(spark, SF, "documents"), quality.ratings(labels.where(seen)))
           .join(labels.where(~seen), "doc_id").select("quality", "kept", "expected_grade", "tail_probability").collect())
    assert len(got) > 80 and np.mean([(r["quality"] == 1) == r["kept"] for r in got]) > 0.97
    assert all(r["kept"] for r in got if r["quality"] == 1)
    assert all(0 <= r["tail_probability"] <= 1 and 0 <= r["expected_grade"] <= 2 for r in got)


def test_edge_rows(spark, edge_docs, no_docs):
    schema = "doc_id long, quality int, toxic int"
    graded = quality.ratings(spark.createDataFrame([(1, 1, 0), (2, 0, 0), (6, 1, 1), (None, 1, 0), (9, None, 1), (9, 1, None), (77, 0, 0)], schema))
    assert sorted((r["doc_id"], r["grade"]) for r in graded.collect()) == [(1, 2), (2, 0), (6, 1), (9, 2), (77, 0)]
    got = quality.select(edge_docs, graded).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r["doc_id"]) for r in edge_docs.collect())
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (3, 4, 5))
    assert quality.keep_good(edge_docs, graded).columns == edge_docs.columns
    assert quality.select(no_docs, graded).count() == 0 and quality.keep_good(no_docs, graded).count() == 0
    none = quality.select(edge_docs, graded.limit(0)).collect()       # no model: all stay
    assert all(r["kept"] and r["expected_grade"] is None for r in none) and quality.keep_good(edge_docs, graded.limit(0)).count() == edge_docs.count()
    assert quality.select(edge_docs, graded.where("grade = 2")).where("kept").count() == edge_docs.count()


def test_each_row_is_decided_by_itself(spark):
    docs, graded = table(spark, SF, "documents").select("doc_id", "text"), quality.ratings(table(spark, SF, "labels"))
    judged = {r["doc_id"]: r["kept"] for r in quality.select(docs, graded).collect()}
    good, bad = (sorted(d for d, k in judged.items() if k is kept)[0] for kept in (True, False))
    extra = docs.where(F.col("doc_id").isin(good, bad))
    shared = [extra.select(F.lit(i).cast("long").alias("doc_id"), "text") for i in (None, -5)]
    got = quality.keep_good(docs.unionByName(shared[0]).unionByName(shared[1]), graded).collect()
    text = docs.where(F.col("doc_id") == good).first()["text"]
    assert sorted(r["doc_id"] for r in got if r["doc_id"] not in (None, -5)) == sorted(d for d, k in judged.items() if k)
    assert [r["text"] for r in got if r["doc_id"] is None] == [text] and [r["text"] for r in got if r["doc_id"] == -5] == [text]
