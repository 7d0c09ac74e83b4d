import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm.decontaminate import ItemIndex, Searcher, keep_clean_rows, leaks, question_answer, shingles, words_of

rnd = random.Random(7)
WORDS = [f"w{k}" for k in range(400)] + ["the", "of", "and"] * 30


def sentence(n):
    return " ".join(rnd.choice(WORDS) for _ in range(n)) + "."


ITEMS = [(k, " ".join(sentence(rnd.randint(4, 14)) for _ in range(rnd.randint(1, 4)))) for k in range(60)]


def index_of(items, shingle=5):
    frequency, total = Counter(), 0
    for _, text in items:
        frequency.update(set(words_of(text)))
        total += len(words_of(text))
    return ItemIndex(items, len(items), total / len(items), frequency, shingle)


def test_question_and_answer():
    assert question_answer("What is it? It is a fox.") == ("What is it?", "It is a fox.")
    assert question_answer("How many?\nAnswer: four") == ("How many?", " four")
    assert question_answer("one sentence") == ("", "one sentence")


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.5])
def test_wand_finds_all_above_the_threshold(threshold):
    index = index_of(ITEMS)
    for _ in range(150):
        terms = sorted(rnd.sample(range(1, len(index.vocab) + 1), rnd.randint(1, 150)))
        scores = np.zeros(len(index.ids))
        for t in terms:
            scores[index.docs[index.at[t]:index.at[t + 1]]] += index.weights[index.at[t]:index.at[t + 1]]
        got = dict(index.wand(terms, threshold))
        assert {i for i in got if scores[i] > threshold + 1e-9} == set(np.flatnonzero(scores > threshold + 1e-9).tolist())
        assert all(abs(scores[i] - s) < 1e-9 for i, s in got.items())


def test_bounds_lose_no_passage():
    index = index_of(ITEMS)
    searcher = Searcher(index, 5)
    texts = [" ".join(rnd.choice(WORDS) for _ in range(rnd.randint(0, 400))) + " " + rnd.choice(ITEMS)[1] for _ in range(20)]
    ids, at = searcher.terms(texts)
    found = {(d, first) for d, first, _ in index.candidates(ids, at, searcher.size, 0.6)}
    for d in range(len(texts)):
        own = ids[at[d]:at[d + 1]]
        for first in range(0, len(own), searcher.size):
            terms = np.unique(own[first:first + 2 * searcher.size])
            if index.wand([t for t in terms.tolist() if t], 0.6):
                assert (d, first) in found


def brute(docs, items, overlap=0.8, n=5):
    """Leaks by joint shingle overlap within the whole document."""
    out = set()
    for doc_id, text in docs:
        words = words_of(text or "")
        for item_id, item in items:
            parts = [shingles(words_of(p), n) for p in question_answer(item or "") if words_of(p)]
            total = sum(map(len, parts))
            grams = {len(g): {tuple(words[k:k + len(g)]) for k in range(len(words) - len(g) + 1)} for p in parts for g in p}
            if total and sum(len(p & grams[len(next(iter(p)))]) for p in parts) >= overlap * total:
                out.add((doc_id, item_id))
    return out


def edited(text):
    words = text.split()
    if len(words) > 25:
        words[len(words) // 2] = "edited"
    return " ".join(words).upper()


def test_leaks_equal_brute_force(spark):
    docs = []
    for d in range(80):
        body = [sentence(rnd.randint(5, 60)) for _ in range(rnd.randint(0, 6))]
        if d % 3 == 0:
            body.insert(rnd.randint(0, len(body)), rnd.choice(ITEMS)[1])
        elif d % 3 == 1:
            body.insert(rnd.randint(0, len(body)), edited(rnd.choice(ITEMS)[1]))
        docs.append((d, "\n".join(body)))
    expected = brute(docs, ITEMS)
    assert len(expected) > 30
    documents, items = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = leaks(documents, items).collect()
    assert len(got) == len({(r["doc_id"], r["item_id"]) for r in got}) and {(r["doc_id"], r["item_id"]) for r in got} == expected
    split = leaks(documents, items, index_bytes=2000).collect()      # several indexes, the same statistics
    assert sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in split) == sorted((r["doc_id"], r["item_id"], round(r["score"], 9)) for r in got)
    assert sorted(r["doc_id"] for r in keep_clean_rows(documents, items).collect()) == sorted({d for d, _ in docs} - {d for d, _ in expected})


def test_edge_rows(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog."), (None, "the quick brown fox jumps over the lazy dog"), (2, None), (3, "  ...  "),
                                   (4, "alpha beta gamma delta alpha beta gamma delta")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in leaks(edge_docs, items).collect()}
    assert got == {(d, i) for d in (1, 2, None) for i in (1, None)} | {(6, 4), (7, 4)}
    clean = keep_clean_rows(edge_docs, items)
    assert clean.columns == edge_docs.columns and sorted(str(r["doc_id"]) for r in clean.collect()) == sorted(["3", "4", "5", "8", "9", "9", "10", "None"])
    assert leaks(no_docs, items).count() == 0
    assert leaks(edge_docs, items.limit(0)).count() == 0


@pytest.mark.parametrize("index_bytes", [1 << 22, 100])
def test_each_row_is_decided_by_itself(spark, edge_docs, no_docs, index_bytes):
    leak, clean = ITEMS[5][1], "nothing of the benchmark stands here at all"
    items = spark.createDataFrame(ITEMS[4:8], "item_id long, text string")
    rows = [(None, leak, 1), (None, clean, 2), (None, None, 3), (7, leak, 4), (7, clean, 5), (8, ITEMS[6][1], 6), (9, clean, None)]
    out = keep_clean_rows(spark.createDataFrame(rows, "doc_id long, text string, n long"), items, index_bytes=index_bytes)
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(map(str, [(None, clean, 2), (None, None, 3), (7, clean, 5), (9, clean, None)]))
    assert keep_clean_rows(edge_docs, items, index_bytes=index_bytes).schema == edge_docs.schema
    assert keep_clean_rows(edge_docs, items).count() == edge_docs.count() and keep_clean_rows(no_docs, items).count() == 0
    assert keep_clean_rows(edge_docs, items.limit(0)).count() == edge_docs.count()


@pytest.mark.parametrize("inserted", [40])
def test_inserted_words_hide_no_item_whatever_the_number_of_indexes(spark, inserted):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.1/benchmark.parquet").collect()][:200]
    docs = []
    for k, (_, text) in enumerate(items):
        words = text.split()
        half = len(words) // 2
        spread = words[:half] + [f"x{rnd.randint(0, 10 ** 6)}" for _ in range(inserted)] + words[half:]
        docs.append((k, " ".join([f"y{rnd.randint(0, 10 ** 6)}" for _ in range(rnd.randint(0, 150))] + spread + ["end"] * rnd.randint(0, 90))))
    want = brute(docs, items)
    documents, tests = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    size = sum(len(t.encode()) for _, t in items)
    one, eight = ({(r["doc_id"], r["item_id"]) for r in leaks(documents, tests, index_bytes=b).collect()} for b in (1 << 22, size // 8 + 1))
    assert len(want) > 100 and one == eight and one <= want and len(one) >= 0.99 * len(want)


def test_copies_of_an_item_are_each_reported(spark):
    items = spark.createDataFrame([(k, ITEMS[3][1]) for k in (5, 5, 9)] + [(None, ITEMS[3][1]), (7, ITEMS[8][1])], "item_id long, text string")
    docs = spark.createDataFrame([(1, "so " + ITEMS[3][1]), (2, "nothing")], "doc_id long, text string")
    assert sorted(str(r["item_id"]) for r in leaks(docs, items).collect()) == ["5", "5", "9", "None"]


def test_question_and_answer_are_verified_together(spark):
    question, answer = " ".join(f"q{k}" for k in range(20)) + "?", " ".join(f"a{k}" for k in range(20)) + "."
    short = " ".join(f"s{k}" for k in range(30)) + "?"
    items = spark.createDataFrame([(1, f"{question} {answer}"), (2, f"{short} yes.")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"{question} {answer}"), (2, question), (3, answer), (4, short)], "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["question_overlap"], r["answer_overlap"]) for r in leaks(docs, items).collect()}
    assert got == {(1, 1): (1.0, 1.0), (4, 2): (1.0, 0.0)}            # half of the shingles do not suffice, nearly all do
