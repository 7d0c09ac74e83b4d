"""Token ids of whole texts by the tokenizers library, with a cache over pre-tokens."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np

from tidemark.llm.common import batches_of, ragged_gather, runs
from tidemark.llm.hashing import HashIndex, RunHasher

# The normalizer and pre-tokenizer settings for which words may
# be encoded one by one (white space is dropped, no pre-token crosses it).
WORD_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# Latin-1 characters lowered, and their classes in that pattern: white space, letter, digit, other.
_LOWERED = np.arange(256, dtype=np.uint8)
_LOWERED[[*range(65, 91), *range(0xC0, 0xD7), *range(0xD8, 0xDF)]] += 32
_SPACE, _LETTER, _DIGIT, _OTHER = range(4)
_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[*range(9, 14), 32, 0x85, 0xA0]] = _SPACE
_CLASS[[*range(97, 123), 0xAA, 0xB5, 0xBA, *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = _LETTER
_CLASS[[*range(48, 58), 0xB2, 0xB3, 0xB9, 0xBC, 0xBD, 0xBE]] = _DIGIT

_SEPARATORS = re.compile("[\x1c-\x1f]")      # white space to some, not to the library
PIECE_CHARS = 1 << 20   # long texts are encoded piece by piece, cut at single spaces
BATCH_CHARS = 1 << 22


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """Cut a text before single spaces that stand between two other characters
    that are no white space; the pieces joined give the text again."""
    start = 0
    while len(text) - start > limit:
        cut = text.find(" ", start + limit)
        while cut >= 0 and (cut + 1 >= len(text) or text[cut + 1].isspace() or text[cut - 1].isspace()):
            cut = text.find(" ", cut + 1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:] if start else text


def pre_tokens(low: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the pre-tokens of lowered Latin-1 text: runs of letters,
    single digits, runs of other characters; an apostrophe that stands alone takes
    s, t, m, d, re, ve or ll after it."""
    kind = _CLASS[low]
    change = np.ones(len(low), bool)
    change[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
    quote = np.flatnonzero((low[:-1] == 39) & change[:-1] & (kind[1:] == _LETTER))
    if len(quote):
        ahead = np.concatenate((low, np.zeros(3, np.uint8)))
        a, b = ahead[quote + 1], ahead[quote + 2]
        pair = ((a == 114) | (a == 118)) & (b == 101) | (a == 108) & (b == 108)          # re, ve, ll
        taken = np.where(np.isin(a, (115, 116, 109, 100)), 1, np.where(pair, 2, 0))
        quote, taken = quote[taken > 0], taken[taken > 0]
        change[quote + 1] = False
        after = quote + 1 + taken
        after = after[after < len(low)]
        change[after[kind[after] == _LETTER]] = True                                      # what is left of the word
    at = np.flatnonzero(change)
    ends = np.append(at[1:], len(low))
    word = kind[at] != _SPACE
    return at[word], ends[word]


class WordTokenizer:
    """``encode(texts)`` → (ids, offsets), equal to ``Tokenizer.encode(text,
    add_special_tokens=False).ids`` of every whole text.

    For a tokenizer that drops white space, ids of a pre-token do not depend on
    its neighbours. All pre-tokens of a batch are cut and hashed over the bytes at
    once and looked up in a cache of arrays (``hashing.HashIndex``, 128 bits a
    pre-token); the library's BPE model encodes those that are new, each once. The
    cache takes at most ``cache_words`` pre-tokens, about 50 bytes each. Texts
    beyond Latin-1, with separator control characters or with special strings go
    through the library whole. A tokenizer of any other make always does.
    """

    def __init__(self, path: str, cache_words: int = 1_000_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.vocab_size = self.library.get_vocab_size(with_added_tokens=True)
        pre = (config.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        suffix = config["model"].get("end_of_word_suffix")
        self.by_word = bool(
            (config.get("normalizer") or {}).get("normalizers") == WORD_NORMALIZERS and suffix
            and pre[0].get("pattern") == {"Regex": WORD_PATTERN} and len(pre) == 2
            and not pre[1].get("add_prefix_space") and config.get("post_processor") is None)
        if self.by_word:
            self.special = [t["content"] for t in config["added_tokens"]]
            self.bpe = Tokenizer(self.library.model)
            self.bpe.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            vocab = self.library.get_vocab()
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            for token, i in vocab.items():
                self.ends[i] = token.endswith(suffix)
            self.byte_chars = {b: c for b, c in byte_alphabet().items() if b != 32}      # spaces stay between pre-tokens
            self.cache_words, self.hasher, self.index = cache_words, RunHasher(), HashIndex()
            self.at, self.flat = np.zeros(1, np.int64), np.zeros(0, np.uint32)

    def _library_ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all pre-tokens and the count of each."""
        lines = [" ".join(words[i:i + 256]).encode().decode("latin-1").translate(self.byte_chars) for i in range(0, len(words), 256)]
        coded = self.bpe.encode_batch_fast(lines, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(c.ids for c in coded), np.uint32)
        counts = np.diff(np.concatenate(([-1], np.flatnonzero(self.ends[ids]))))
        if len(counts) != len(words):
            raise ValueError("pre-tokens and their last ids do not agree")
        return ids, counts

    def _plain_ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of Latin-1 texts and their count by text."""
        text_at = runs(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        low = _LOWERED[np.frombuffer(" ".join(texts).encode("latin-1"), np.uint8)]
        starts, ends = pre_tokens(low) if len(low) else (np.zeros(0, np.int64),) * 2
        first, second = self.hasher.hashes(low, starts, ends)
        entry = self.index.find(first, second)
        missing = np.flatnonzero(entry < 0)
        flat, at = self.flat, self.at
        if len(missing):
            _, new, which = np.unique(first[missing], return_index=True, return_inverse=True)
            if (second[missing] != second[missing[new]][which]).any():       # words that share their first hash
                _, new, which = np.unique(np.stack((first[missing], second[missing]), 1), axis=0, return_index=True, return_inverse=True)
            new = missing[new]
            ids, counts = self._encode_words([low[a:b].tobytes().decode("latin-1") for a, b in zip(starts[new].tolist(), ends[new].tolist())])
            entry[missing] = self.index.size + which
            flat, at = np.concatenate((flat, ids)), np.concatenate((at, at[-1] + np.cumsum(counts)))
            room = min(len(new), self.cache_words - self.index.size)
            if room > 0:
                self.index.add(first[new[:room]], second[new[:room]])
                self.at = at[:self.index.size + 1]
                self.flat = flat[:self.at[-1]]
        n = at[entry + 1] - at[entry]
        per = runs(n)
        return ragged_gather(flat, at[entry], n), np.diff(per[np.searchsorted(starts, text_at)])

    def _by_library(self, text: str) -> bool:
        if any(s in text for s in self.special):
            return True
        if text.isascii():
            return False
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return True
        return False

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts in order and the offsets of each text in them."""
        if not self.by_word:
            each = [self._library_ids(t) for t in texts]
            return (np.concatenate(each) if each else np.zeros(0, np.uint32)), runs(np.array([len(e) for e in each], np.int64))
        out, counts = [np.zeros(0, np.uint32)], np.zeros(len(texts), np.int64)
        cut = [(i, p) for i, text in enumerate(texts) for p in pieces(text)]
        parts = [p for _, p in cut]
        for a, b in batches_of(parts, BATCH_CHARS):
            whole = np.fromiter((self._by_library(p) or _SEPARATORS.search(p) is not None for p in parts[a:b]), bool, b - a)
            ids, n = self._plain_ids([("" if w else p) for p, w in zip(parts[a:b], whole.tolist())])
            if whole.any():
                at = runs(n)
                each = [self._library_ids(parts[a + k]) if w else ids[at[k]:at[k + 1]] for k, w in enumerate(whole)]
                ids, n = np.concatenate(each), np.array([len(e) for e in each], np.int64)
            out.append(ids)
            np.add.at(counts, [i for i, _ in cut[a:b]], n)
        return np.concatenate(out), runs(counts)


def byte_alphabet() -> dict[int, str]:
    """Byte → printable character, as byte-level tokenizers write bytes:
    printable Latin-1 bytes stand for themselves, the others follow from 256 on."""
    same = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = (b for b in range(256) if b not in same)
    return {b: chr(b) for b in same} | {b: chr(256 + k) for k, b in enumerate(other)}


_TOKENIZERS: dict[tuple, WordTokenizer] = {}


def word_tokenizer(path: str, cache_words: int = 1_000_000) -> WordTokenizer:
    """One tokenizer and cache for each path and Python worker."""
    key = (path, cache_words)
    if key not in _TOKENIZERS:
        _TOKENIZERS[key] = WordTokenizer(path, cache_words)
    return _TOKENIZERS[key]
