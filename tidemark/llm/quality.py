"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One weight vector over hashed words, word shapes and word repetitions gives a
document's score s; ordered thresholds t1 < t2 < ... cut it into grades:
P(grade >= k) = sigmoid(s - t_k). Expected grade and a tail probability select
documents.

The ratings are graded from labels: 0 low quality, 1 readable but toxic, 2
good; any ordered integer grades from 0 on will do.

The fit takes at most ``sample_rows`` rated rows, the first by a hash of the id.

Defined results: a null text counts as empty and has score 0; a null doc_id is
kept and has no rating; repeated rows are each scored; without rated rows of two
grades there is no model, grade and probability are null and all rows are kept;
an empty table gives no rows; further columns are ignored by ``grade`` and kept
by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import filter_texts, id_text, text_batches
from tidemark.llm.linear import WordWeights, batch_words, bucket, fista, shape, sigmoid, sum_by_text, text_rows, word_features

BITS = 18
SAMPLE_ROWS = 4000
REPEATED = bucket("word as before", BITS)
SCHEMA = "doc_id long, score double, expected_grade double, tail_probability double"


def ratings(labels: DataFrame) -> DataFrame:
    """(doc_id, grade) from labels (doc_id, quality 0/1, toxic 0/1); rows without quality are left out."""
    good = F.when(F.coalesce(F.col("toxic"), F.lit(0)) == 1, 1).otherwise(2)
    return (labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.when(F.col("quality") == 0, 0).otherwise(good).alias("grade")))


def features(word: str) -> list[int]:
    return [bucket("w" + word, BITS), bucket("s" + shape(word), BITS)]


def link_gradient(grades: np.ndarray, n_thresholds: int):
    """Derivatives of the cumulative-link loss by each row's score and by the thresholds."""

    def gradient(scores: np.ndarray, thresholds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cuts = np.concatenate(([-np.inf], thresholds, [np.inf]))
        upper, lower = sigmoid(cuts[grades + 1] - scores), sigmoid(cuts[grades] - scores)
        p = np.maximum(upper - lower, 1e-12)
        by_upper, by_lower = upper * (1 - upper) / p, lower * (1 - lower) / p
        n = max(1, len(grades))
        by_cut = np.bincount(grades, -by_upper, n_thresholds + 1)[:-1] + np.bincount(grades, by_lower, n_thresholds + 1)[1:]
        return by_upper - by_lower, by_cut / n

    return gradient


def fit(texts: list[str], grades: np.ndarray, l1: float = 1e-4, l2: float = 1e-6, steps: int = 200) -> tuple[np.ndarray, np.ndarray]:
    """(weights by bucket, ordered thresholds)."""
    top = int(grades.max())
    rows = text_rows([(i, n / max(1, size)) for i, n, size in word_features(texts, False, features, REPEATED)], 1 << BITS, least=2, scaled=False)
    share = np.clip(np.array([(grades >= k).mean() for k in range(1, top + 1)]), 1e-3, 1 - 1e-3)
    gap = np.arange(top) * 1e-6
    w, cuts = fista(rows, link_gradient(grades, top), -np.log(share / (1 - share)), lambda t: np.maximum.accumulate(t - gap) + gap, 0.5, l1, l2, steps)
    return rows.weights(w, 1 << BITS), cuts


def score_texts(texts: list[str], weights: WordWeights) -> np.ndarray:
    """Mean weight over all words of each text."""
    repeated = weights.weights.get(REPEATED, 0.0)
    out = np.zeros(len(texts))
    for a, b, words, which, at in batch_words(texts, False):
        own = weights.of(words)
        each = own[which]
        if len(each):
            same = np.append(False, which[1:] == which[:-1])
            same[at[:-1][at[:-1] < len(which)]] = False
            each = each + repeated * same
        out[a:b] = sum_by_text(each, at) / np.maximum(1, np.diff(at))
    return out


def rated_sample(docs: DataFrame, graded: DataFrame, sample_rows: int) -> tuple[list[str], np.ndarray]:
    rank = F.xxhash64(F.col("doc_id"))
    picked = [(r["doc_id"], r["grade"]) for r in graded.orderBy(rank, "doc_id", "grade").limit(sample_rows).collect()]
    small = docs.sparkSession.createDataFrame(picked or [(None, 0)], "doc_id long, grade int")    # sample_rows at most
    rows = id_text(docs).join(F.broadcast(small), "doc_id").select("text", "grade").orderBy(F.xxhash64("doc_id"), "grade").limit(sample_rows).collect()
    return [r["text"] for r in rows], np.array([r["grade"] for r in rows], np.int64)


def fitted_model(docs: DataFrame, graded: DataFrame, sample_rows: int) -> Broadcast:
    """(used buckets, their weights, thresholds), no thresholds without rated rows of two grades."""
    texts, grades = rated_sample(docs, graded, sample_rows)
    fitted = len(set(grades.tolist())) > 1
    weights, cuts = fit(texts, grades) if fitted else (np.zeros(1 << BITS), np.zeros(0))
    used = np.flatnonzero(weights)
    return docs.sparkSession.sparkContext.broadcast((used, weights[used], cuts))


def word_weights(index: np.ndarray, value: np.ndarray) -> WordWeights:
    w = np.zeros(1 << BITS)
    w[index] = value
    return WordWeights(w, features)


def tail_probability(tails: np.ndarray, at_least: int) -> np.ndarray:
    """P(grade >= ``at_least``), 0 above the highest grade."""
    return tails[:, at_least - 1] if tails.shape[1] >= at_least else np.zeros(len(tails))


def grade(docs: DataFrame, graded: DataFrame, at_least: int = 1, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, score, expected_grade, tail_probability) of each row of ``docs``
    (doc_id, text); the tail is P(grade >= ``at_least``). ``graded``: (doc_id, grade)."""
    model = fitted_model(docs, graded, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, value, thresholds = model.value
        by_word = word_weights(index, value)
        for batch in text_batches(batches):
            score = score_texts(batch["text"].to_pylist(), by_word)
            tails = sigmoid(score[:, None] - thresholds[None, :])
            none = np.full(len(score), not len(thresholds))
            tail = tail_probability(tails, at_least)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score), pa.array(tails.sum(axis=1), mask=none), pa.array(tail, mask=none)],
                                             ["doc_id", "score", "expected_grade", "tail_probability"])

    return id_text(docs).mapInArrow(run, SCHEMA)


def select(docs: DataFrame, graded: DataFrame, at_least: int = 1, least_tail: float = 0.6, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``grade`` with the decision ``kept``: the tail probability is ``least_tail`` or more, or there is no model."""
    return grade(docs, graded, at_least, sample_rows).withColumn("kept", F.coalesce(F.col("tail_probability") >= least_tail, F.lit(True)))


def keep_good(docs: DataFrame, graded: DataFrame, at_least: int = 1, least_tail: float = 0.6, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of ``docs`` that ``select`` keeps, with all their columns; each row is decided by itself."""
    model = fitted_model(docs, graded, sample_rows)

    def judge() -> Callable[[list[str]], np.ndarray]:
        index, value, thresholds = model.value
        by_word = word_weights(index, value)

        def accept(texts: list[str]) -> np.ndarray:
            tails = sigmoid(score_texts(texts, by_word)[:, None] - thresholds[None, :])
            return tail_probability(tails, at_least) >= least_tail if len(thresholds) else np.ones(len(texts), bool)

        return accept

    return filter_texts(docs, judge)
