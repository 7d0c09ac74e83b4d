"""Registered queries on the given tables, against SQL or brute force, and the pipeline against its plain form."""

import re
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from public_tokenizers import path
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import decontaminate, quality, toxicity
from tidemark.llm.linear import WordWeights
from tidemark.llm.queries import ORACLE_SQL, QUERIES
from tidemark.sources.tables import table

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def texts(duck):
    return dict(duck.execute("SELECT doc_id, coalesce(text, '') FROM documents").fetchall())


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.fixture(scope="module")
def word_ids(texts):
    library = Tokenizer.from_file(path("word_bpe_49k.json"))
    return {d: library.encode(t, add_special_tokens=False).ids for d, t in texts.items()}


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF), duck.execute(ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(str, (tuple(r) for r in got.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


def test_op1(spark, word_ids):
    start, want = 0, []
    for d in sorted(word_ids):
        ids = word_ids[d] + [1]
        want.append((d, start, len(ids), crc(ids)))
        start += len(ids)
    got = QUERIES["op1_huffman_ids"](spark, SF).collect()
    assert sorted((r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) for r in got) == want


def check_pieces(rows, word_ids, docs):
    windows, pieces = defaultdict(list), defaultdict(list)
    for r in rows:
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
    assert set(pieces) == set(docs)
    for d in docs:
        ids, at = word_ids[d] + [2], 0
        for start, n, value, total in sorted(pieces[d]):
            assert start == at and value == crc(ids[at:at + n]) and total == len(ids)
            at += n
        assert at == len(ids)
    for own in windows.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert 0 < at <= 4096 and (at & (at - 1)) == 0       # 4096 is one of them


def test_op5(spark, word_ids):
    check_pieces(QUERIES["op5_packing"](spark, SF).collect(), word_ids, word_ids)


def fingerprint(text):
    words = [w for w in text.translate(LOWER).encode().split()]
    grams = [b" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
    bits = np.zeros(64, np.int64)
    for g in grams:
        bits += np.array([xxhash.xxh64_intdigest(g, 42) >> j & 1 for j in range(64)])
    return sum(1 << j for j in range(64) if 2 * bits[j] > len(grams))


def components(fps):
    ids, parent = sorted(fps), {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (fps[a] ^ fps[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


def test_op6(spark, texts):
    fps = {d: fingerprint(t) for d, t in texts.items()}
    want = components(fps)
    got = QUERIES["op6_simhash"](spark, SF).collect()
    assert sorted((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == sorted((d, f"{fps[d]:016x}", want[d]) for d in fps)


def contained(texts, items):
    """Documents that hold an item: its question and answer shingles, 0.8 of them."""
    out = set()
    for item_id, item in items:
        parts = [decontaminate.shingles(decontaminate.words_of(p), 5) for p in decontaminate.question_answer(item)]
        total = sum(map(len, parts))
        for d, t in texts.items():
            words = decontaminate.words_of(t)
            have = {n: {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} for n in {len(g) for p in parts for g in p}}
            if total and sum(len({g for g in p if g in have[len(g)]}) for p in parts) >= 0.8 * total:
                out.add((d, item_id))
    return out


def test_op7(spark, duck, texts):
    want = contained(texts, duck.execute("SELECT item_id, text FROM benchmark").fetchall())
    got = {(r["doc_id"], r["item_id"]) for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert got == want and want


def test_op10(spark, texts):
    library = Tokenizer.from_file(path("byte_bpe_50k.json"))
    want = sorted((d, len(t.encode()), n, n > 1024) for d, t in texts.items() for n in [len(library.encode(t, add_special_tokens=False).ids)])
    got = QUERIES["op10_token_counts"](spark, SF).collect()
    assert sorted((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want


def plain_mean_weight(text, weights):
    """A text's quality score, word by word: mean weight of its words, a repeated word adds its own feature."""
    total = 0.0
    words = [w for w in re.split("[\t\n\x0b\x0c\r ]+", text) if w]
    for k, word in enumerate(words):
        total += sum(weights[i] for i in quality.features(word))
        if k and words[k - 1] == word:
            total += weights[quality.REPEATED]
    return total / max(1, len(words))


def test_op3_equals_a_plain_refit(spark, texts):
    docs = table(spark, SF, "documents")
    sample, grades = quality.rated_sample(docs, quality.ratings(table(spark, SF, "labels")), quality.SAMPLE_ROWS)
    weights, cuts = quality.fit(sample, grades)
    got = {r["doc_id"]: r for r in QUERIES["op3_quality"](spark, SF).collect()}
    assert sorted(got) == sorted(texts)
    for d, t in texts.items():
        score = plain_mean_weight(t, weights)
        tails = [1 / (1 + np.exp(c - score)) for c in cuts]
        r = got[d]
        assert (r["score"], r["expected_grade"], r["tail_probability"]) == pytest.approx((score, sum(tails), tails[0]), abs=1e-6)
        assert r["kept"] == (r["tail_probability"] >= 0.6)


def test_op8_equals_a_plain_refit(spark, texts):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    weights, bias = toxicity.fit(*toxicity.training_sample(docs, labels, toxicity.SAMPLE_ROWS))
    got = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, SF).collect()}
    assert sorted(got) == sorted(texts)
    for d, t in texts.items():
        words = {w for w in re.split("[\t\n\x0b\x0c\r ]+", pc.utf8_lower(pa.scalar(t)).as_py()) if w}
        score = 1 / (1 + np.exp(-bias - sum(weights[i] for w in words for i in toxicity.features(w))))
        assert got[d]["score"] == pytest.approx(score, abs=1e-6)
        assert got[d]["predicted"] == int(got[d]["score"] >= 0.5) and got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)


def test_the_fit_itself_is_that_of_its_loss():
    """Cumulative-link weights: the loss that the fit reports no better than cannot be lowered by moving a threshold."""
    rnd = np.random.default_rng(4)
    sample = [" ".join(rnd.choice(["good", "fine", "bad", "awful", "the", "of"], 12, p=p)) for p in [[.4, .3, .05, .05, .1, .1]] * 60 + [[.05, .05, .4, .3, .1, .1]] * 60]
    grades = np.array([2, 1] * 30 + [0, 0, 0, 1] * 15)
    weights, cuts = quality.fit(sample, grades)
    score = np.array([plain_mean_weight(t, weights) for t in sample])

    def loss(cuts):
        below = np.concatenate(([1.0 * np.ones(len(score))], 1 / (1 + np.exp(np.array(cuts)[:, None] - score)), [np.zeros(len(score))]))
        return -np.log(np.maximum(1e-12, below[grades, np.arange(len(score))] - below[grades + 1, np.arange(len(score))])).mean()
    best = loss(cuts)
    assert cuts[0] < cuts[1] and score[grades == 2].mean() > score[grades == 0].mean()
    assert all(loss(cuts + np.array(d)) > best - 1e-3 for d in [(0.3, 0), (-0.3, 0), (0, 0.3), (0, -0.3)])


def test_pipeline_equals_its_plain_form(spark, duck, texts, word_ids):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "simhash_near_dedup", "decontamination", "packing"]
    docs = table(spark, SF, "documents")
    # quality: the model's own decisions, one row at a time
    graded = quality.ratings(table(spark, SF, "labels"))
    sample, grades = quality.rated_sample(docs, graded, quality.SAMPLE_ROWS)
    weights, cuts = quality.fit(sample, grades)
    by_word = WordWeights(weights, quality.features)
    kept = {}
    for d, t in texts.items():
        score = quality.score_texts([t], by_word)[0]
        if 1 / (1 + np.exp(cuts[0] - score)) >= 0.6:
            kept[d] = t
    assert 0 < len(kept) < len(texts)
    # exact copies: the largest id of equal texts
    last = {}
    for d in sorted(kept):
        last[kept[d].translate(LOWER)] = d
    kept = {d: texts[d] for d in last.values()}
    # near copies: the smallest id of a component
    found = components({d: fingerprint(t) for d, t in kept.items()})
    kept = {d: t for d, t in kept.items() if found[d] == d}
    # benchmark items
    leaked = {d for d, _ in contained(kept, duck.execute("SELECT item_id, text FROM benchmark").fetchall())}
    kept = {d: t for d, t in kept.items() if d not in leaked}
    check_pieces(corpus_pipeline.run(spark, SF).collect(), word_ids, kept)


def test_stages_return_the_columns_of_documents(spark):
    docs = table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()


def test_every_operator_is_registered():
    import __spark_entry__ as entry
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in names if k.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("keep_rows", [True, False], ids=["edge", "empty"])
def test_pipeline_on_edge_rows_and_on_none(spark, tmp_path, edge_docs, no_docs, keep_rows):
    """Null and repeated ids, null, empty and long texts, clashing names: every stage keeps the columns, the last packs whole texts."""
    docs = (edge_docs if keep_rows else no_docs).repartition(3)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    rows = table(spark, str(tmp_path), "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, str(tmp_path))
        assert out.columns == rows.columns, name
        out.count()
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library, whole = Tokenizer.from_file(path("word_bpe_49k.json")), {r["doc_id"]: r["text"] or "" for r in rows.collect()}
    for r in pieces:
        assert r["doc_tokens"] == len(library.encode(whole[r["doc_id"]], add_special_tokens=False).ids) + 1 or r["doc_id"] is None
    assert bool(pieces) == keep_rows
