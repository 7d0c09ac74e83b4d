import random
import re

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.llm import license_scan as ls
from tidemark.llm.queries import LICENSE_PHRASES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
rnd = random.Random(5)


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, phrases, texts, slack=ls.SLACK, least=ls.LEAST_SHARE):
    """(n_words, n_base, first, last, base labels, labels, score) from the words themselves."""
    own, places, base, shares = words(text), [], set(), {}
    for phrase, label in phrases:
        p = words(phrase)
        found = [k for k in range(len(own) - len(p) + 1) if own[k:k + len(p)] == p]
        places += found
        if found:
            base.add(label)
    best = 1.0 if places else 0.0
    labels = set(base)
    for template, label in texts:
        t, votes = words(template), {}
        grams = {}
        for j in range(len(t) - 4):
            grams.setdefault(tuple(t[j:j + 5]), []).append(j)
        for w in range(len(own) - 4):
            for j in grams.get(tuple(own[w:w + 5]), []):
                votes.setdefault(w - j, set()).add(j)
        for start in votes:
            covered = {j + i for near, js in votes.items() if abs(near - start) <= slack for j in js for i in range(5)}
            shares[label] = max(shares.get(label, 0), len(covered) / len(t))
    labels |= {label for label, share in shares.items() if share >= least}
    best = max([best, *shares.values()])
    return len(own), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


TEXTS = [(t, label) for label, t in ls.LICENSES]
MIT = dict((label, t) for label, t in ls.LICENSES)["mit"]


def edited(text, every):
    out = text.split()
    for k in range(every, len(out), every):
        out[k] = rnd.choice(["", out[k] + " really", "changed"])
    return " ".join(out)


ROWS = [
    (1, "Released under the MIT License."), (2, "the gnu  GENERAL-public\nlicense, and CC BY-NC 4.0; cc by cc by"), (3, None), (4, ""), (5, " \n\t..."),
    (6, f"intro {MIT} outro"), (7, edited(MIT, 14)), (8, edited(MIT, 3)), (9, MIT[:len(MIT) // 2]), (10, f"{MIT} {MIT}"),
    (10, f"{MIT} {MIT}"), (None, "mit license"), (None, "mit licence"), (11, "mit license " * 30_000), (12, "licence mit\x00license mit_license mitlicense"),
    (13, "éMIT License İ mit LİCENSE 许可 cc by"), (14, "mit"), (15, "license mit"), (16, "the above copyright notice and this " * 2000), (17, "w" * 3_000_000 + " apache license"),
    *((20 + k, text) for k, (_, text) in enumerate(ls.LICENSES)),
]


def scanned(spark, rows, parts=3):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, row long, label string, n_words long").repartition(parts)
    return [tuple(r) for r in ls.scan(df, LICENSE_PHRASES).collect()]


def test_equals_brute_force(spark):
    want = sorted(((i, *brute(t, LICENSE_PHRASES, TEXTS)) for i, t in ROWS), key=str)
    assert sorted(scanned(spark, ROWS), key=str) == want


def test_edited_license_is_found_and_a_fragment_is_not(spark):
    got = {r[0]: r for r in scanned(spark, [r for r in ROWS if r[0] in (6, 7, 8, 9)])}
    assert got[6][6] == got[7][6] == "mit" and got[7][7] < 1 and got[6][7] == 1
    assert got[8][6] == got[9][6] == "" and 0 < got[9][7] < 0.8


def test_all_given_documents_equal_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((r["doc_id"], *brute(r["text"], LICENSE_PHRASES, TEXTS)) for r in docs.collect())
    assert sorted(tuple(r) for r in ls.scan(docs, LICENSE_PHRASES).collect()) == want and any(w[2] for w in want)


def test_more_templates_than_a_broadcast_holds(spark, monkeypatch):
    monkeypatch.setattr(ls, "BROADCAST_GRAMS", 10)
    rows = ROWS[:10]
    assert sorted(scanned(spark, rows), key=str) == sorted(((i, *brute(t, LICENSE_PHRASES, TEXTS)) for i, t in rows), key=str)


def test_empty_table(spark):
    assert scanned(spark, []) == []


@settings(max_examples=80, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(st.lists(st.text(alphabet=st.sampled_from(list("aAbZz09 -_.\n\x00\x7fé许")), max_size=40), max_size=6), st.sampled_from([4, 1 << 20]))
def test_equal_words_have_equal_hashes_and_others_do_not(texts, size):
    hasher, before = ls.Hasher(), ls.BATCH_BYTES
    ls.BATCH_BYTES = size                        # words are hashed in pieces of any size
    try:
        data = [t.encode() for t in texts]
        at = np.concatenate(([0], np.cumsum([len(d) for d in data], dtype=np.int64)))
        hashes, offsets = hasher.words(np.frombuffer(b"".join(data), np.uint8), at)
    finally:
        ls.BATCH_BYTES = before
    every = [w for t in texts for w in words(t)]
    assert np.diff(offsets).tolist() == [len(words(t)) for t in texts]
    for family in hashes:
        seen = dict(zip(every, family.tolist()))
        assert [seen[w] for w in every] == family.tolist() and len(set(seen.values())) == len(seen)


@pytest.mark.parametrize("n", [0, 1, 4, 5, 9])
def test_grams_of_short_texts(n):
    hasher = ls.Hasher()
    own = ls.text_words(hasher, " ".join(f"w{k}" for k in range(n)))
    assert len(own[0]) == n and len(hasher.grams(own, 5)[0]) == max(0, n - 4)


def test_lists_of_grams_are_cut_without_a_gap(spark, monkeypatch):
    monkeypatch.setattr(ls, "LIST_GRAMS", 7)
    df = spark.createDataFrame([(1, " ".join(f"w{k}" for k in range(40)) + " mit license")], "doc_id long, text string")
    rows = [r for r in ls.rolling_grams(df).collect() if r["n_words"] is None]
    assert sorted(r["first"] for r in rows) == sorted([*range(0, 41, 7), *range(0, 38, 7)])
    assert sum(len(r["grams"]) for r in rows) == 41 + 38
