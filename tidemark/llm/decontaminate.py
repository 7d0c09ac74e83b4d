"""Benchmark decontamination: BM25 with block-max WAND, then overlap.

Test items form an inverted index; its weights are BM25 contributions divided
by the score of the item's own text, so a passage scores 1 where it holds all
terms of an item. Every document is cut into overlapping passages of two blocks
of words, a block somewhat longer than the longest item of the whole benchmark.
Every passage is a query: all items that score ``threshold`` or more are
retrieved. Upper bounds of blocks of items, summed for all passages of a batch at
once, skip most; the rest run block-max WAND, cursor by cursor. A retrieved item is
verified in the passage and a block before and behind it, so an occurrence that
inserted words stretch over two passages is counted whole.

The rule: an item leaks if ``overlap`` of the word shingles of its question and of
its answer, taken together, occur. Both parts' own shares are reported; one part
alone suffices only if it holds so many of the shingles.

Items of equal text are one item until they are reported. An index holds at most
``index_bytes`` of item text and is broadcast; a larger test set is split into
several, each queried with all passages, with the document frequencies, lengths
and passages of the whole set, so the number of indexes changes no result.

Defined results: a null or empty item never matches; a null or empty document
has no passages; null ids are kept as they are; repeated documents are each
reported; of items with equal text each is reported; an empty table gives no
rows; further columns are ignored by ``leaks`` and kept by ``keep_clean_rows``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches_of, filter_texts, id_text, ragged_gather, runs, stored, text_batches, text_or_empty

K1, B = 1.2, 0.75
ITEM_BLOCK = 2          # items under one upper bound, more if there are over MAX_BLOCKS of them
MAX_BLOCKS = 128
INDEX_BYTES = 4 << 20
LEAST_WORDS = 32
BATCH_CHARS = 1 << 22
BOUND_CELLS = 1 << 22
_WORD = re.compile(r"[^\W_]+")
_SENTENCE = re.compile(r"(?<=[.!?])\s+")
LEAKS = "doc_id long, item_id long, score double, question_overlap double, answer_overlap double, overlap double, first_word long"


def words_of(text: str) -> list[str]:
    return _WORD.findall(pc.utf8_lower(pa.scalar(text)).as_py())


def question_answer(text: str) -> tuple[str, str]:
    """An item's question and answer: the answer follows a line ``Answer:`` or is the last sentence."""
    marked = re.split(r"\n\s*(?:answer|a)\s*:", text, maxsplit=1, flags=re.IGNORECASE)
    if len(marked) == 2:
        return marked[0], marked[1]
    sentences = _SENTENCE.split(text.strip())
    return " ".join(sentences[:-1]), sentences[-1]


def shingles(words: list, n: int) -> set[tuple]:
    """Word n-grams; fewer words count as one, none as none."""
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


class ItemIndex:
    """Inverted index over items (id, text) with weights in [0, 1] and block maxima."""

    def __init__(self, items: list[tuple], n_items: int, mean_words: float, frequency: dict[str, int], shingle: int):
        parsed = [(i, words_of(t), [words_of(p) for p in question_answer(t)]) for i, t in items]
        parsed = sorted((p for p in parsed if p[1]), key=lambda p: len(p[1]))     # items of a block are of like length
        self.ids = [p[0] for p in parsed]
        self.longest = max((len(p[1]) for p in parsed), default=0)
        self.vocab = {w: k + 1 for k, w in enumerate(sorted({w for p in parsed for w in p[1]}))}
        term_ids = lambda words: [self.vocab[w] for w in words]
        self.parts = [(shingles(term_ids(q), shingle), shingles(term_ids(a), shingle)) for _, _, (q, a) in parsed]
        idf = np.zeros(len(self.vocab) + 1)
        for word, k in self.vocab.items():
            idf[k] = np.log1p((n_items - frequency[word] + 0.5) / (frequency[word] + 0.5))
        rows = []
        for d, (_, words, _) in enumerate(parsed):
            terms, tf = np.unique(term_ids(words), return_counts=True)
            weight = idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(words) / mean_words))
            rows.append((terms, np.full(len(terms), d), weight / weight.sum()))
        terms, docs, weights = (np.concatenate(x) if rows else np.zeros(0) for x in (zip(*rows) if rows else ((), (), ())))
        order = np.lexsort((docs, terms))
        terms, self.docs, self.weights = terms[order].astype(np.int64), docs[order].astype(np.int64), weights[order]
        self.at = np.searchsorted(terms, np.arange(len(self.vocab) + 2))
        self.block = max(ITEM_BLOCK, -(-len(parsed) // MAX_BLOCKS))
        n_blocks = max(1, -(-len(parsed) // self.block))
        bound = np.zeros((len(self.vocab) + 1, n_blocks), np.float64)
        np.maximum.at(bound, (terms, self.docs // self.block), self.weights)
        self.bound = (bound * (1 + 1e-6)).astype(np.float32)         # never below the true maximum
        self.top = self.bound.max(axis=1, initial=0).astype(np.float64)

    def wand(self, terms: list[int], threshold: float) -> list[tuple[int, float]]:
        """(item, score) of all items that score ``threshold`` or more for distinct ``terms``, by block-max WAND."""
        docs, weights, found = self.docs, self.weights, []
        cursors = [[int(self.at[t]), int(self.at[t + 1]), t] for t in terms if self.at[t] < self.at[t + 1]]
        while True:
            cursors = sorted((c for c in cursors if c[0] < c[1]), key=lambda c: docs[c[0]])
            total, pivot = 0.0, None
            for k, c in enumerate(cursors):
                total += self.top[c[2]]
                if total >= threshold:
                    pivot = k
                    break
            if pivot is None:
                return found
            item = int(docs[cursors[pivot][0]])
            while pivot + 1 < len(cursors) and docs[cursors[pivot + 1][0]] == item:
                pivot += 1
            block = item // self.block
            if sum(float(self.bound[c[2], block]) for c in cursors[:pivot + 1]) < threshold:
                # no item up to the block's end, or to the next cursor, can reach it
                skip = (block + 1) * self.block
                if pivot + 1 < len(cursors):
                    skip = min(skip, int(docs[cursors[pivot + 1][0]]))
                target = max(skip, item + 1)
            elif int(docs[cursors[0][0]]) == item:
                score = sum(weights[c[0]] for c in cursors[:pivot + 1])
                if score >= threshold:
                    found.append((item, float(score)))
                target = item + 1
            else:
                target = item
            for c in cursors[:pivot + 1]:
                if docs[c[0]] < target:
                    c[0] += int(np.searchsorted(docs[c[0]:c[1]], target))

    def candidates(self, terms: np.ndarray, offsets: np.ndarray, size: int, threshold: float) -> Iterator[tuple[int, int, list[int]]]:
        """(document, first word, distinct terms) of passages whose bounds reach the
        threshold for some block of items. A passage is two neighbouring blocks of ``size`` words."""
        lengths = np.diff(offsets)
        first = runs(-(-lengths // size))                       # passages of a document: one from each block on
        owner = np.repeat(np.arange(len(lengths)), lengths)
        passage = first[owner] + (np.arange(len(terms)) - offsets[owner]) // size
        known = terms > 0
        passage, term, opens = passage[known], terms[known], first[owner[known]]
        before = passage > opens                                # a word also ends the passage of the block before
        width = len(self.vocab) + 1
        keys = np.unique(np.concatenate((passage * width + term, (passage[before] - 1) * width + term[before])))
        passage, term = keys // width, keys % width
        starts = np.flatnonzero(np.diff(passage, prepend=-1))
        ends = np.append(starts[1:], len(term))
        doc = np.searchsorted(first, passage[starts], "right") - 1
        step = max(1, BOUND_CELLS // self.bound.shape[1])
        k = 0
        while k < len(starts):
            m = max(k + 1, int(np.searchsorted(starts, starts[k] + step)))
            bounds = np.add.reduceat(self.bound[term[starts[k]:ends[m - 1]]], starts[k:m] - starts[k], axis=0)
            for w in (k + np.flatnonzero(bounds.max(axis=1) >= threshold * (1 - 1e-4))).tolist():
                yield int(doc[w]), int(passage[starts[w]] - first[doc[w]]) * size, term[starts[w]:ends[w]].tolist()
            k = m


class Searcher:
    """Leaks of whole texts against one index of a benchmark whose longest item has ``longest`` words."""

    def __init__(self, index: ItemIndex, shingle: int, longest: int | None = None):
        self.index, self.shingle = index, shingle
        longest = index.longest if longest is None else longest
        self.size = max(LEAST_WORDS, longest + longest // 8)

    def terms(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term ids (0: not in the index) of all words in order, and offsets by text."""
        split = pc.ascii_split_whitespace(pc.utf8_lower(pa.array(texts, pa.large_string())))
        coded = pc.dictionary_encode(split.flatten())
        cut = [_WORD.findall(w) for w in coded.dictionary.to_pylist()]
        n = np.fromiter(map(len, cut), np.int64, len(cut))
        flat = np.fromiter(map(self.index.vocab.get, (w for ws in cut for w in ws), repeat(0)), np.int64, int(n.sum()))
        which = coded.indices.to_numpy()
        at = split.offsets.to_numpy() - split.offsets[0].as_py()
        ids = ragged_gather(flat, runs(n)[:-1][which], n[which]) if len(which) else np.zeros(0, np.int64)
        return ids, runs(n[which])[at]

    def leaks(self, texts: list[str], threshold: float, overlap: float) -> list[tuple]:
        """(text, item id, score, question, answer and joint overlap, first word): one row for each text and item."""
        out = []
        for a, b in batches_of(texts, BATCH_CHARS):
            ids, at = self.terms(texts[a:b])
            best: dict[tuple, tuple] = {}
            for doc, first, terms in self.index.candidates(ids, at, self.size, threshold):
                hits = self.index.wand(terms, threshold)
                if not hits:
                    continue
                start = at[doc] + first
                words = ids[max(at[doc], start - self.size):min(start + 3 * self.size, at[doc + 1])].tolist()
                grams: dict[int, set] = {}
                for item, score in hits:
                    shared, total, each = 0, 0, []
                    for part in self.index.parts[item]:
                        n = len(next(iter(part))) if part else self.shingle
                        if n not in grams:
                            grams[n] = {tuple(words[k:k + n]) for k in range(len(words) - n + 1)}
                        common = len(part & grams[n])
                        shared, total = shared + common, total + len(part)
                        each.append(common / len(part) if part else None)
                    if shared >= overlap * total and best.get((doc, item), (0,))[0] < shared / total:
                        best[doc, item] = (shared / total, score, *each, first)
            out += [(a + doc, self.index.ids[item], score, q, ans, both, first) for (doc, item), (both, score, q, ans, first) in best.items()]
        return out


@dataclass(frozen=True)
class Benchmark:
    """Distinct item texts (rep, text), the items that have them (item_id, rep), and the whole set's statistics."""
    texts: DataFrame
    owners: DataFrame
    counted: DataFrame
    n_items: int
    mean_words: float
    longest: int
    index_bytes: int
    shingle: int

    def indexes(self) -> Iterator[ItemIndex]:
        """Indexes over the distinct texts, each of about ``index_bytes`` at most."""
        size = self.texts.agg(F.sum(F.octet_length("text"))).first()[0]
        n_indexes = max(1, -(-size // self.index_bytes))
        for k in range(n_indexes):
            part = self.texts.where(F.pmod(F.xxhash64("text"), F.lit(n_indexes)) == k)
            rows = [(r["rep"], r["text"]) for r in part.collect()]     # about index_bytes
            own = part.mapInArrow(_terms, "term string, n long").select("term").distinct()
            yield ItemIndex(rows, self.n_items, self.mean_words, {r["term"]: r["df"] for r in self.counted.join(own, "term", "left_semi").collect()}, self.shingle)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct terms of each item, and a row with the empty term and its number of words."""
    for batch in text_batches(batches):
        for text in batch["text"].to_pylist():
            words = words_of(text)
            yield pa.RecordBatch.from_pydict({"term": sorted(set(words)) + [""], "n": [0] * len(set(words)) + [len(words)]},
                                             pa.schema([("term", pa.string()), ("n", pa.int64())]))


def benchmark(items: DataFrame, shingle: int, index_bytes: int = INDEX_BYTES) -> Benchmark | None:
    """``items`` (item_id, text) prepared; None if they have no words."""
    items = items.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty("text").alias("text"))
    counted = stored(items.mapInArrow(_terms, "term string, n long").groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("n").alias("n"), F.max("n").alias("most")), "op7-terms")
    total = counted.where("term = ''").agg(F.sum("df").alias("df"), F.sum("n").alias("n"), F.max("most").alias("most")).first()
    if not total["n"]:
        return None
    texts = stored(items.select("text").distinct().withColumn("rep", F.monotonically_increasing_id()), "op7-texts")
    owners = items.join(texts, "text").select("item_id", "rep")
    return Benchmark(texts, owners, counted, total["df"], total["n"] / total["df"], total["most"], index_bytes, shingle)


def leaks(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, shingle: int = 5, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """Rows (doc_id, item_id, score, overlaps, first_word) for each document (doc_id,
    text) and item (item_id, text) that it holds, at the passage of most overlap."""
    spark, found, marks = docs.sparkSession, None, benchmark(items, shingle, index_bytes)

    def search(index: ItemIndex, longest: int) -> DataFrame:
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            searcher = Searcher(shared.value, shingle, longest)
            for batch in text_batches(batches):
                ids, rows = batch["doc_id"].to_pylist(), searcher.leaks(batch["text"].to_pylist(), threshold, overlap)
                types = [pa.int64(), pa.int64(), *[pa.float64()] * 4, pa.int64()]
                columns = list(zip(*((ids[r[0]], *r[1:]) for r in rows))) or [[]] * 7
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [f.split()[0] for f in LEAKS.split(", ")])

        return id_text(docs).mapInArrow(run, LEAKS)

    if marks is None:
        return spark.createDataFrame([], LEAKS)
    for index in marks.indexes():
        part = search(index, marks.longest)
        found = part if found is None else found.unionByName(part)
    names = [f.split()[0] for f in LEAKS.split(", ")]
    return found.withColumnRenamed("item_id", "rep").join(marks.owners, "rep").select(*names)


def keep_clean_rows(docs: DataFrame, items: DataFrame, threshold: float = 0.6, overlap: float = 0.8, shingle: int = 5, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns; each row is
    decided by itself. Between the passes of several indexes the rows are stored,
    so a task holds one index."""

    def clean(rows: DataFrame, index: ItemIndex, longest: int) -> DataFrame:
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def judge() -> Callable[[list[str]], np.ndarray]:
            searcher = Searcher(shared.value, shingle, longest)

            def accept(texts: list[str]) -> np.ndarray:
                keep = np.ones(len(texts), bool)
                keep[[r[0] for r in searcher.leaks(texts, threshold, overlap)]] = False
                return keep

            return accept

        return filter_texts(rows, judge)

    marks = benchmark(items, shingle, index_bytes)
    for k, index in enumerate(marks.indexes() if marks else ()):
        docs = clean(stored(docs, "op7-clean", "snappy") if k else docs, index, marks.longest)
    return docs
