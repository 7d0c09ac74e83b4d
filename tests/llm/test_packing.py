from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from tidemark.llm.packing import SumOfSquares, pack
from tidemark.llm.tokens import word_tokenizer

TOKENIZER = path("word_bpe_49k.json")


def squares(level, capacity):
    return sum(int(n) ** 2 for h, n in enumerate(level) if 0 < h < capacity)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 15), max_size=60))
def test_the_level_of_least_squares_is_chosen(sizes):
    packer = SumOfSquares(16, 1000)
    for k, size in enumerate(sizes):
        choice = {}
        for h in range(0, 16 - size + 1):
            if h == 0 or packer.level[h]:
                level = packer.level.copy()
                level[h] -= h > 0
                level[h + size] += 1
                choice[h] = squares(level, 16)
        h = packer.best(size)
        assert choice[h] == min(choice.values())
        packer.put((k,), 0, size)
        assert {h: len(w) for h, w in packer.windows.items() if w} == {h: int(n) for h, n in enumerate(packer.level) if n}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 70), max_size=80), st.integers(1, 12))
def test_every_id_lies_in_one_piece_and_nothing_is_padded(sizes, max_open):
    packer, done = SumOfSquares(16, max_open), []
    for k, size in enumerate(sizes):
        done += packer.put(k, 0, size)
        assert packer.n_open <= max_open
    done += packer.drain(True)
    pieces = defaultdict(list)
    for window in done:
        total = sum(n for _, _, n in window)
        assert 0 < total <= 16 and total & (total - 1) == 0
        for k, start, n in window:
            pieces[k].append((start, n))
    for k, size in enumerate(sizes):
        at = 0
        for start, n in sorted(pieces[k]):
            assert start == at
            at += n
        assert at == size


@pytest.mark.parametrize("capacity,max_open", [(4096, 2048), (64, 3)])
def test_pieces_rebuild_the_documents(spark, edge_docs, capacity, max_open):
    library = word_tokenizer(TOKENIZER).library
    expected = sorted((str(r["doc_id"]), library.encode(r["text"] or "", add_special_tokens=False).ids + [2]) for r in edge_docs.collect())
    got = pack(edge_docs.repartition(3), TOKENIZER, 2, capacity, max_open).collect()
    windows = defaultdict(int)
    for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == windows[r["sequence_id"]] and len(r["ids"]) == 4 * r["length"]
        windows[r["sequence_id"]] += r["length"]
    assert all(n <= capacity and (n == capacity or n & (n - 1) == 0) for n in windows.values())
    ids = defaultdict(list)
    for r in got:
        ids[str(r["doc_id"]), r["doc_tokens"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    total = sum(len(p) for own in ids.values() for _, p in own)
    assert total == sum(len(i) for _, i in expected)
    for doc, whole in expected:
        own = [p for p in sorted(ids[doc, len(whole)])]
        assert [x for s, p in dict(own).items() for x in p] == whole or len(own) > len(dict(own))     # equal rows lie twice


def test_without_end_id_an_empty_text_has_no_piece(spark):
    docs = spark.createDataFrame([(1, ""), (2, "a b")], "doc_id long, text string")
    assert [r["doc_id"] for r in pack(docs, TOKENIZER, None).collect()] == [2]


def test_empty_table(no_docs):
    assert pack(no_docs, TOKENIZER).count() == 0
