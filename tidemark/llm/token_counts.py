"""Token counts by rank-synchronous merging.

Distinct pre-tokens of a batch lie in ragged numpy arrays of symbols. In each
round every sequence finds the lowest rank among its neighbouring pairs, and
all sequences merge that pair at once (all its places, left to right); the
symbols that survive when no pair has a rank are the tokens.

Texts are cut where the pre-tokenizer can never join (in front of white space
that follows another character), equal chunks are merged once per batch and a
bounded cache keeps their counts. The tokenizer's own pre-tokenizer cuts a
chunk; strings of added tokens count one each, as the library takes them.

Defined results: a null text counts as empty (0 bytes, 0 tokens); null ids and
repeated rows are kept; an empty table gives no rows; further columns are
ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, id_text, runs, text_batches
from tidemark.llm.tokens import byte_alphabet, pieces

# White space as the pre-tokenizer sees it: without the separator controls.
_SPACE = r"[^\S\x1c-\x1f]"
_CHUNK = re.compile(rf"{_SPACE}*[\S\x1c-\x1f]+|{_SPACE}+")
NO_RANK = np.iinfo(np.int64).max
BATCH_CHARS = 1 << 22


class PairRanks:
    """Rank and merged symbol of symbol pairs: an open-addressing table in numpy arrays."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        keys = self._key(left, right)
        _, keep = np.unique(keys, return_index=True)      # the first rank of a pair counts
        slot, todo = self._slot(keys), np.sort(keep)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, NO_RANK, np.int64)
        self.merged = np.zeros(1 << bits, np.int64)
        self.probes = 0
        while len(todo):
            at = (slot[todo] + self.probes) & self.mask
            free = self.keys[at] < 0
            _, one = np.unique(at, return_index=True)
            placed = np.zeros(len(todo), bool)
            placed[one] = True
            placed &= free
            where = at[placed]
            self.keys[where], self.ranks[where], self.merged[where] = keys[todo[placed]], todo[placed], merged[todo[placed]]
            todo = todo[~placed]
            self.probes += 1

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return left.astype(np.int64) << 32 | right.astype(np.int64)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank or NO_RANK, merged symbol) of each pair."""
        keys = self._key(left, right)
        at = self._slot(keys)
        hit = self.keys[at]
        rank, merged = np.where(hit == keys, self.ranks[at], NO_RANK), self.merged[at]
        open_ = np.flatnonzero((hit != keys) & (hit >= 0))
        for k in range(1, self.probes):
            if not len(open_):
                break
            at_k = (at[open_] + k) & self.mask
            hit = self.keys[at_k]
            same = hit == keys[open_]
            rank[open_[same]], merged[open_[same]] = self.ranks[at_k[same]], self.merged[at_k[same]]
            open_ = open_[~same & (hit >= 0)]
        return rank, merged


def merge_counts(symbols: np.ndarray, offsets: np.ndarray, ranks: PairRanks) -> np.ndarray:
    """Surviving symbols of every sequence ``symbols[offsets[i]:offsets[i+1]]``."""
    out = np.diff(offsets)
    owner = np.repeat(np.arange(len(out)), out)
    symbols = symbols.astype(np.int64)
    while len(symbols):
        inside = owner[1:] == owner[:-1]
        rank, merged = ranks.find(symbols[:-1], symbols[1:])
        rank[~inside] = NO_RANK
        starts = np.concatenate(([0], np.flatnonzero(~inside) + 1))
        lowest = np.minimum.reduceat(np.append(rank, NO_RANK), starts)     # of each sequence
        go = lowest < NO_RANK
        lengths = np.diff(np.append(starts, len(symbols)))
        out[owner[starts[~go]]] = lengths[~go]
        # all places of the lowest pair; of overlapping ones (a a a) every other, from the left
        here = np.append((rank == np.repeat(lowest, lengths)[:-1]) & (rank < NO_RANK), False)
        at = np.flatnonzero(here)
        if not len(at):
            break
        new_run = np.concatenate(([True], np.diff(at) > 1))
        run_start = at[np.flatnonzero(new_run)][np.cumsum(new_run) - 1]
        at = at[(at - run_start) % 2 == 0]
        symbols[at] = merged[at]
        keep = np.repeat(go, lengths)
        keep[at + 1] = False
        symbols, owner = symbols[keep], owner[keep]
    return out


class TokenCounter:
    """Token counts of whole texts for a byte-level BPE tokenizer file."""

    def __init__(self, path: str, cache_chunks: int = 300_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        model, pre = config["model"], config["pre_tokenizer"] or {}
        if (model["type"], pre.get("type"), pre.get("add_prefix_space"), config["normalizer"], config["post_processor"]) != ("BPE", "ByteLevel", False, None, None) \
                or model.get("ignore_merges") or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
            raise ValueError("a byte-level BPE tokenizer without normalizer is needed")
        vocab = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = PairRanks(*(np.array(x, np.int64) for x in zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in merges))))
        self.symbol = np.zeros(512, np.int64)   # by character of the byte alphabet
        for char in byte_alphabet().values():
            self.symbol[ord(char)] = vocab[char]
        self.cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        added = [t["content"] for t in config["added_tokens"]]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.cache_chunks, self.cache = cache_chunks, {}

    def _chunk_counts(self, chunks: list[str]) -> np.ndarray:
        """Tokens of each chunk: its pre-tokens merged in one go."""
        cut = [[p for p, _ in self.cut(c)] for c in chunks]
        own = runs(np.fromiter(map(len, cut), np.int64, len(cut)))
        distinct: dict[str, int] = {}
        which = np.fromiter((distinct.setdefault(p, len(distinct)) for ps in cut for p in ps), np.int64)
        lengths = np.fromiter(map(len, distinct), np.int64, len(distinct))
        symbols = self.symbol[np.frombuffer("".join(distinct).encode("utf-16-le"), "<u2")]
        total = runs(merge_counts(symbols, runs(lengths), self.ranks)[which])
        return total[own[1:]] - total[own[:-1]]

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text."""
        out = np.zeros(len(texts), np.int64)
        parts, owner = [], []
        for i, text in enumerate(texts):
            segments = [text]
            if self.added:
                segments = self.added.split(text)
                out[i] = len(segments) - 1
            for segment in segments:
                for piece in pieces(segment):
                    parts.append(piece)
                    owner.append(i)
        for a, b in batches_of(parts, BATCH_CHARS):
            cut = [_CHUNK.findall(p) for p in parts[a:b]]
            n = np.fromiter(map(len, cut), np.int64, len(cut))
            chunks = [c for cs in cut for c in cs]
            known = np.fromiter(map(self.cache.get, chunks, repeat(-1)), np.int64, len(chunks))
            missing = np.flatnonzero(known < 0)
            if len(missing):
                new = list(dict.fromkeys(chunks[k] for k in missing.tolist()))
                found = dict(zip(new, self._chunk_counts(new).tolist()))
                known[missing] = [found[chunks[k]] for k in missing.tolist()]
                for chunk in new[:max(0, self.cache_chunks - len(self.cache))]:
                    if len(chunk) <= 64:
                        self.cache[chunk] = found[chunk]
            at, total = runs(n), runs(known)
            np.add.at(out, owner[a:b], total[at[1:]] - total[at[:-1]])
        return out


_COUNTERS: dict[tuple, TokenCounter] = {}


def token_counter(path: str, cache_chunks: int = 300_000) -> TokenCounter:
    """One counter and cache for each path and Python worker."""
    key = (path, cache_chunks)
    if key not in _COUNTERS:
        _COUNTERS[key] = TokenCounter(path, cache_chunks)
    return _COUNTERS[key]


def token_counts(docs: DataFrame, tokenizer_path: str, limit: int = 1024) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = token_counter(tokenizer_path)
        for batch in text_batches(batches):
            n = counter.count(batch["text"].to_pylist())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["n_bytes"], pa.array(n), pa.array(n > limit)],
                                             ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return (id_text(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
            .mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean"))
