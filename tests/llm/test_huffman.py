import heapq
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from tidemark.llm.huffman import CHECKPOINT, Code, canonical_codes, code_lengths, read_file, read_ids, write_ids
from tidemark.llm.tokens import word_tokenizer
from tidemark.session import scratch_path

TOKENIZER = path("word_bpe_49k.json")


def huffman_cost(counts):
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 1000), min_size=2, max_size=60))
def test_lengths_are_optimal_and_prefix_free(counts):
    counts = np.array(counts)
    lengths = code_lengths(counts, 40).astype(int)
    if (counts > 0).sum() > 1:
        assert (lengths * counts).sum() == huffman_cost(counts)
    limited = code_lengths(counts, 6).astype(int)
    assert limited.max(initial=0) <= 6 and ((limited > 0) == (counts > 0)).all()
    assert (2.0 ** -limited[limited > 0]).sum() <= 1
    codes = canonical_codes(limited.astype(np.uint8))
    words = [format(int(c), f"0{n}b") for c, n in zip(codes, limited) if n]
    assert not any(a != b and b.startswith(a) for a in words for b in words)


def test_too_many_ids_for_the_limit():
    with pytest.raises(ValueError):
        code_lengths(np.ones(5), 2)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 700), min_size=1, max_size=8), st.integers(1, 300), st.integers(0, 1000))
def test_blocks_decode_on_their_own(sizes, vocab, seed):
    at = np.cumsum([0, *sizes])
    ids = np.minimum(np.random.default_rng(seed).exponential(20, at[-1]).astype(np.int64), vocab - 1)
    code = Code(code_lengths(np.bincount(ids, minlength=vocab), 12))
    words, words_at, marks, marks_at = code.encode(ids, at)
    for d, n in enumerate(sizes):
        own = marks[marks_at[d]:marks_at[d + 1]].astype(np.int64)
        for k, bit in enumerate(own):      # any checkpoint alone
            count = min(CHECKPOINT, n - k * CHECKPOINT)
            got = code.decode(words, np.array([words_at[d] * 32 + bit]), np.array([count]))
            assert got.tolist() == ids[at[d] + k * CHECKPOINT:][:count].tolist()


@pytest.mark.parametrize("roll", [1, 1 << 20])
def test_files_round_trip(spark, edge_docs, roll):
    out = scratch_path(spark, "test-ids")
    manifest = write_ids(edge_docs, out, TOKENIZER, end_id=1, files=3, roll_bytes=roll)
    rows = edge_docs.select("doc_id", "text").collect()
    assert manifest.agg({"n_docs": "sum"}).first()[0] == len(rows)
    assert manifest.count() == (len(rows) if roll == 1 else manifest.select("part").distinct().count())
    library = word_tokenizer(TOKENIZER).library
    expected = sorted((-1 if r["doc_id"] is None else r["doc_id"], library.encode(r["text"] or "", add_special_tokens=False).ids + [1]) for r in rows)
    got = read_ids(spark, out).orderBy("start").collect()
    ids = [(-1 if r["doc_id"] is None else r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got]
    assert [i for i, _ in ids] == [i for i, _ in expected] and sorted(ids) == expected
    start = 0
    for r in got:
        assert r["start"] == start and r["n_tokens"] * 4 == len(r["ids"])
        start += r["n_tokens"]


def test_empty_table(spark, no_docs):
    out = scratch_path(spark, "test-ids")
    assert write_ids(no_docs, out, TOKENIZER).count() == 0 and read_ids(spark, out).count() == 0


def test_a_cut_file_is_refused(spark, edge_docs, tmp_path):
    out = f"{tmp_path}/ids"
    file = write_ids(edge_docs, out, TOKENIZER, files=1).first()["path"]
    whole = open(file, "rb").read()
    cut = tmp_path / "cut.ids"
    cut.write_bytes(whole[:-5])
    with pytest.raises(ValueError):
        list(read_file(str(cut)))
    assert zlib.crc32(whole) == zlib.crc32(open(write_ids(edge_docs, f"{tmp_path}/again", TOKENIZER, files=1).first()["path"], "rb").read())


def test_null_and_repeated_ids_are_cut_like_others(spark):
    rows = [(None if k % 3 == 0 else 7 if k % 3 == 1 else -k, "same text" if k % 2 else f"text {k}") for k in range(240)]
    out = scratch_path(spark, "test-ids")
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sizes = sorted(r["n_docs"] for r in write_ids(frame, out, TOKENIZER, files=8).collect())
    assert len(sizes) == 8 and sizes[0] == sizes[-1] == 30
    got = [r["doc_id"] for r in read_ids(spark, out).orderBy("start").collect()]
    assert got == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
