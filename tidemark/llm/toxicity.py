"""Toxicity by weak supervision.

Many voters look at a text: words of a fixed lexicon, patterns (a word after
"you", shouting, word beginnings) and words mined from labelled rows. A
generative label model estimates by EM how often each voter fires in toxic and
in other texts and, along a tree of the strongest correlations within classes,
how often it fires beside another, so nested voters count once. Its posterior labels on
labelled and unlabelled rows train a linear classifier on hashed words and word
beginnings, which scores every text; the voters are not used for scoring.

The fit takes at most ``sample_rows`` labelled and as many unlabelled rows, the
first by a hash of the id; rows held out give neither labels nor texts to it.

Defined results: a null text counts as empty and gets the score of no words; a
null doc_id is held out like the text ``null`` and has no label; repeated rows
are each scored; labels of rows that repeat are all used; without labelled rows
of both classes every score is the share of toxic rows (0 without any); an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, text_batches
from tidemark.llm.linear import WordWeights, batch_words, bucket, fista, sigmoid, text_rows, word_features

BITS = 18
SAMPLE_ROWS = 3000
PREFIXES = (4, 5)
LEAST_ROWS = 4          # rows of the sample that a feature must occur in
LEXICON = ["idiot", "idiots", "moron", "morons", "stupid", "dumb", "loser", "losers", "scum", "trash", "garbage", "pathetic", "worthless",
           "disgusting", "clown", "clowns", "fool", "jerk", "hate", "ugly", "imbecile", "vermin", "filth", "crap", "bastard"]
PATTERNS = {"you_are": re.compile(r"\byou(?: are|'re) (?:an? )?\w+", re.IGNORECASE), "shouting": re.compile(r"\b[A-Z]{4,}\b(?:\W+[A-Z]{4,}\b){2}"),
            "exclamation": re.compile(r"!{2,}"), "you_insult": re.compile(r"\byou (?:%s)\b" % "|".join(LEXICON), re.IGNORECASE)}
_CORE = re.compile(r"[^\W_]+")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5, is 0."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("null")), "UTF-8")) % 5 == 0


def cores(word: str) -> list[str]:
    return _CORE.findall(word.lower())


def word_terms(word: str) -> list[str]:
    """A word's terms: itself and its beginnings (``^`` and 4 or 5 characters)."""
    return [t for core in cores(word) for t in (core, *("^" + core[:n] for n in PREFIXES if len(core) > n))]


def text_terms(text: str) -> set[str]:
    return {t for w in set(text.lower().split()) for t in word_terms(w)}


def mine(texts: list[str], toxic: np.ndarray, most: int = 250, least: int = 4, lift: float = 4.0) -> list[str]:
    """Terms that fire at least ``lift`` times as often in toxic rows, by chi-square."""
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    hits1, hits0 = Counter(), Counter()
    for text, y in zip(texts, toxic):
        if y:
            hits1.update(text_terms(text))
    hits1 = Counter({t: k for t, k in hits1.items() if k >= least})
    for text, y in zip(texts, toxic):
        if not y:
            hits0.update(t for t in text_terms(text) if t in hits1)
    found = []
    for term, k in hits1.items():
        p1, p0 = (k + 0.5) / (n1 + 1), (hits0[term] + 0.5) / (n0 + 1)
        if p1 >= lift * p0:
            p = (k + hits0[term]) / (n1 + n0)
            found.append((-(k / n1 - hits0[term] / n0) ** 2 / (p * (1 - p) + 1e-9), term))
    return [t for _, t in sorted(found)[:most]]


def votes(texts: list[str], voters: list[str]) -> np.ndarray:
    """Boolean (row, voter): lexicon, mined and pattern voters."""
    number = {v: k for k, v in enumerate(voters)}
    out = np.zeros((len(texts), len(voters) + len(PATTERNS)), bool)
    for i, text in enumerate(texts):
        out[i, [number[t] for t in text_terms(text) if t in number]] = True
        out[i, len(voters):] = [bool(p.search(text)) for p in PATTERNS.values()]
    return out


def dependency_tree(x: np.ndarray, weights: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(parent of each voter or itself, mutual information with it given the class):
    the spanning tree of most conditional mutual information."""
    m = x.shape[1]
    info = np.zeros((m, m))
    total = sum(w.sum() for w in weights)
    for w in weights:
        n, hits = w.sum(), w @ x
        if n <= 0:
            continue
        both = (x * w[:, None]).T @ x
        for cell, row, col in ((both, hits[:, None], hits[None, :]), (hits[:, None] - both, hits[:, None], n - hits[None, :]),
                               (hits[None, :] - both, n - hits[:, None], hits[None, :]), (n - hits[:, None] - hits[None, :] + both, n - hits[:, None], n - hits[None, :])):
            ok = cell > 1e-9
            ratio = np.ones_like(both)
            np.divide(cell * n, row * col, out=ratio, where=ok & (row * col > 0))
            info += np.where(ok, cell, 0) / total * np.log(np.maximum(ratio, 1e-12))
    np.fill_diagonal(info, -np.inf)
    parent, best, inside = np.zeros(m, np.int64), info[0].copy(), np.zeros(m, bool)
    gain = np.zeros(m)
    inside[0] = True
    for _ in range(m - 1):
        j = int(np.argmax(np.where(inside, -np.inf, best)))
        inside[j], gain[j] = True, best[j]
        closer = ~inside & (info[j] > best)
        parent[closer], best[closer] = j, info[j][closer]
    return parent, gain


def label_model(v: np.ndarray, known: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Posterior of the toxic class for each row of votes, and the parameters.

    ``known`` is 1, 0 or -1 (no label). Known rows start the estimates and keep
    counting in them; the rest follows their posterior. Each voter depends on
    the class and on the voter it is most correlated with within classes, so a
    vote that another implies adds nothing. ``fires[y, u, j]``: how often voter j
    fires in class y if its ``parent`` fires (u = 1) or not.
    """
    x = v.astype(np.float64)
    labelled = known >= 0
    share = (float((known == 1).sum()) + 1) / (float(labelled.sum()) + 2)
    post = (known == 1).astype(np.float64)
    trust = labelled.astype(np.float64)            # unlabelled rows count from the second round on
    parent, gain = dependency_tree(x, (trust * post, trust * (1 - post)))
    root = parent == np.arange(len(parent))
    up = x[:, parent]
    for _ in range(rounds):
        fires = np.zeros((2, 2, x.shape[1]))
        for y, weight in enumerate((trust * (1 - post), trust * post)):
            rate = (weight @ x + 0.05) / (weight.sum() + 0.1)
            for u, own in enumerate((weight[:, None] * (1 - up), weight[:, None] * up)):
                fires[y, u] = ((own * x).sum(axis=0) + rate) / (own.sum(axis=0) + 1.0)
            fires[y][:, root] = rate[root]
        fires = np.clip(fires, 1e-4, 1 - 1e-4)
        hit, miss = np.log(fires[1] / fires[0]), np.log((1 - fires[1]) / (1 - fires[0]))
        odds = np.where(up > 0, np.where(x > 0, hit[1], miss[1]), np.where(x > 0, hit[0], miss[0]))
        new = sigmoid(np.log(share / (1 - share)) + odds.sum(axis=1))
        settled = np.abs(new - post)[~labelled].max(initial=0) < 1e-3 and trust.all()
        post, trust = np.where(labelled, known == 1, new), np.ones(len(x))
        if settled:
            break
    return new, {"fires": fires, "parent": parent, "information": gain, "share": np.array(share)}


def features(word: str) -> list[int]:
    return [bucket(t, BITS) for t in word_terms(word)]


def fit_linear(texts: list[str], target: np.ndarray, l1: float = 1.6, l2: float = 1e-3, steps: int = 100) -> tuple[np.ndarray, float]:
    """(weights by bucket, bias) of a logistic fit on soft labels; equal words of a
    text count once. An l1 fit (``l1`` over the root of the rows) selects the
    features, an l2 fit weighs them."""
    each = [(i, n) for i, n, _ in word_features(texts, True, features, distinct_words=True)]

    def gradient(scores: np.ndarray, bias: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        error = sigmoid(scores + bias[0]) - target
        return error, np.array([error.mean()])

    share = float(np.clip(target.mean(), 1e-3, 1 - 1e-3))
    start = np.array([np.log(share / (1 - share))])
    rows = text_rows(each, 1 << BITS, LEAST_ROWS)
    w, _ = fista(rows, gradient, start, lambda b: b, 0.25, l1 / np.sqrt(max(1, len(texts))), 0.0, steps)
    chosen = rows.used[np.abs(w) > 1e-6]
    rows = text_rows([(i[k], n[k]) for i, n in each for k in [np.isin(i, chosen)]], 1 << BITS)
    w, bias = fista(rows, gradient, start, lambda b: b, 0.25, 0.0, l2, 4 * steps)
    return rows.weights(w, 1 << BITS), float(bias[0])


def fit(texts: list[str], known: np.ndarray) -> tuple[np.ndarray, float]:
    """Voters, label model and classifier from a bounded sample; ``known`` as in ``label_model``."""
    labelled = known >= 0
    if not (known == 1).any() or not (known == 0).any():
        share = float((known == 1).sum()) / max(1, int(labelled.sum()))
        return np.zeros(1 << BITS), float(np.log(np.clip(share, 1e-9, 1 - 1e-9) / (1 - np.clip(share, 1e-9, 1 - 1e-9))))
    mined = mine([t for t, k in zip(texts, labelled) if k], known[labelled] == 1)
    voters = list(dict.fromkeys([*LEXICON, *mined]))
    posterior, _ = label_model(votes(texts, voters), known)
    return fit_linear(texts, posterior)


def score_texts(texts: list[str], weights: WordWeights, bias: float) -> np.ndarray:
    """Score of each text from 0 to 1, over all its words."""
    out = np.zeros(len(texts))
    for a, b, words, which, at in batch_words(texts, True):
        own = weights.of(words)
        hit = np.flatnonzero(own[which])
        text = np.searchsorted(at, hit, "right") - 1
        once = np.unique(text * len(words) + which[hit])         # equal words of a text count once
        out[a:b] = np.bincount(once // max(1, len(words)), own[once % max(1, len(words))], b - a)
    return sigmoid(out + bias)


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> tuple[list[str], np.ndarray]:
    """(texts, known): at most ``sample_rows`` labelled and as many unlabelled rows that are not held out."""
    spark = docs.sparkSession
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))))
    rank = F.xxhash64(F.col("doc_id"))
    picked = known.orderBy(rank, "doc_id", "toxic").limit(sample_rows)
    others = (docs.select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .join(known.select("doc_id"), "doc_id", "left_anti").orderBy(rank, "doc_id").limit(sample_rows))
    chosen = [(r["doc_id"], r["toxic"]) for r in picked.collect()] + [(r["doc_id"], -1) for r in others.collect()]
    small = spark.createDataFrame(chosen or [(None, -1)], "doc_id long, known int")    # 2 * sample_rows at most
    rows = id_text(docs).join(F.broadcast(small), "doc_id").select("text", "known").orderBy(F.xxhash64("doc_id"), "known").limit(2 * sample_rows).collect()
    return [r["text"] for r in rows], np.array([r["known"] for r in rows], np.int64)


def toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of ``docs`` (doc_id, text)."""
    texts, known = training_sample(docs, labels, sample_rows)
    weights, bias = fit(texts, known)
    used = np.flatnonzero(weights)
    model = docs.sparkSession.sparkContext.broadcast((used, weights[used], bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, value, offset = model.value
        w = np.zeros(1 << BITS)
        w[index] = value
        by_word = WordWeights(w, features)
        for batch in text_batches(batches):
            score = score_texts(batch["text"].to_pylist(), by_word, offset)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= 0.5).astype(np.int32))],
                                             ["doc_id", "held_out", "score", "predicted"])

    return id_text(docs).withColumn("held_out", held_out(F.col("doc_id"))).mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")
