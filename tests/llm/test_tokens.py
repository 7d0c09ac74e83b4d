from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from tidemark.llm.token_counts import TokenCounter, merge_counts
from tidemark.llm.tokens import WordTokenizer, pieces

WORDS = WordTokenizer(path("word_bpe_49k.json"), cache_words=50)      # a small cache: it fills up and stays right
BYTES = WordTokenizer(path("byte_bpe_50k.json"))
COUNTER = TokenCounter(path("byte_bpe_50k.json"), cache_chunks=50)
TEXT = st.lists(st.one_of(st.text(max_size=8), st.sampled_from(
    [" ", "  ", "\n", " \n", "it's", "we'LL", "<|endoftext|>", "É", "ß", "½", "aaaa", "=====", "\x1c", "\x85", " ", "́", "中", "İ", "Σ", "the", "ing"])),
    max_size=20).map("".join)


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_word_tokenizer_equals_the_library(texts):
    ids, at = WORDS.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [WORDS.library.encode(t, add_special_tokens=False).ids for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, max_size=6))
def test_counts_equal_the_library(texts):
    assert COUNTER.count(texts).tolist() == [len(BYTES.library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_other_tokenizers_go_through_the_library():
    assert WORDS.by_word and not BYTES.by_word
    ids, at = BYTES.encode(["a b", ""])
    assert ids.tolist() == BYTES.library.encode("a b", add_special_tokens=False).ids and at.tolist() == [0, len(ids), len(ids)]


@given(st.text(alphabet="ab \n", max_size=200), st.integers(1, 20))
def test_pieces_join_to_the_text(text, limit):
    cut = list(pieces(text, limit))
    assert "".join(cut) == text
    for a, b in zip(cut, cut[1:]):
        assert not a[-1].isspace() and b[0] == " " and not b[1].isspace()


def test_long_texts_cut_in_pieces_give_the_same_ids():
    text = "Alpha, beta's gamma! " * 120_000
    ids, _ = WORDS.encode([text])
    assert ids.tolist() == WORDS.library.encode(text, add_special_tokens=False).ids
    assert COUNTER.count([text])[0] == len(BYTES.library.encode(text, add_special_tokens=False).ids)


def test_merging_overlapping_pairs_from_the_left():
    import numpy as np

    from tidemark.llm.token_counts import PairRanks
    ranks = PairRanks(np.array([1, 2, 2]), np.array([1, 2, 1]), np.array([2, 3, 4]))      # aa, (aa)(aa), (aa)a
    symbols = np.ones(1 + 2 + 3 + 4 + 5 + 7)
    assert merge_counts(symbols, np.cumsum([0, 1, 2, 3, 4, 5, 7]), ranks).tolist() == [1, 1, 1, 1, 2, 2]


def test_hash_index_finds_what_was_added_and_nothing_else():
    import numpy as np

    from tidemark.llm.hashing import HashIndex
    rng = np.random.default_rng(1)
    first = rng.integers(0, 1 << 63, 30_000).astype(np.uint64)
    first[1::2] = first[::2]                                  # pairs that share the first hash
    second = np.arange(30_000, dtype=np.uint64)
    index = HashIndex()
    for a in range(0, 30_000, 7000):
        index.add(first[a:a + 7000], second[a:a + 7000])
    assert index.find(first, second).tolist() == list(range(30_000))
    assert (index.find(first, second + np.uint64(30_000)) == -1).all() and len(index.find(first[:0], second[:0])) == 0


def test_words_that_share_a_hash_keep_their_ids(monkeypatch):
    import numpy as np

    tokenizer = WordTokenizer(path("word_bpe_49k.json"))
    monkeypatch.setattr(tokenizer.hasher, "hashes", lambda data, starts, ends: [np.zeros(len(starts), np.uint64), np.array([hash(data[a:b].tobytes()) & (1 << 63) - 1 for a, b in zip(starts, ends)], np.uint64)])
    for text in ("one two three one", "two four"):
        assert tokenizer.encode([text])[0].tolist() == tokenizer.library.encode(text, add_special_tokens=False).ids
