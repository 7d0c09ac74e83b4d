"""Packing documents into windows of at most ``capacity`` token ids.

Sum-of-squares online packing: with ``level[h]`` the number of open windows
filled to h, a document goes into the level (or a new window) for which the
sum of ``level[h] ** 2`` over the partly filled levels is least afterwards. The
levels live in one array; a full window leaves it. Parts of a document that
fill whole windows are cut off first, so only its remainder is placed.

Each task packs its own documents as they come and nothing is shuffled. When
more than ``max_open`` windows are open, and at the end, open windows are
emptied: their pieces are put end to end and cut again at ``capacity``, and the
last ids, fewer than a window, are cut at powers of two, lengths that need no
padding. So no window is padded at all, whatever the number of tasks.

Defined results: a null text counts as empty and gives its end id alone (no
piece if there is no end id); a null document id is kept; repeated rows are
packed each on its own; an empty table gives no rows; further columns are
ignored. Window ids are ``task << 33 | number``: stable when a task is repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.common import binary_array, id_text, runs, text_batches
from tidemark.llm.tokens import word_tokenizer

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
OUT_IDS = 1_000_000


class SumOfSquares:
    """The levels and the open windows of one task.

    A piece is (document, start, length); ``put`` returns windows that are done,
    as lists of pieces.
    """

    def __init__(self, capacity: int, max_open: int):
        self.capacity, self.max_open, self.n_open = capacity, max_open, 0
        self.level = np.zeros(capacity + 1, np.int64)
        self.windows: dict[int, list[list[tuple]]] = {}

    def best(self, size: int) -> int:
        """Level whose window takes ``size`` more ids at the least sum of squares; 0: a new window.
        Of equal levels the fullest wins."""
        level, room = self.level, self.capacity - size
        change = 1 - 2 * level[:room + 1]             # a window leaves level h
        change[0] = 0
        change[:room] += 2 * level[size:self.capacity] + 1   # and enters h + size, unless it is full
        change[1:][level[1:room + 1] == 0] = np.iinfo(np.int64).max
        return int(room - np.argmin(change[::-1]))

    def put(self, document: object, start: int, size: int) -> list[list[tuple]]:
        done: list[list[tuple]] = []
        while size >= self.capacity:
            done.append([(document, start, self.capacity)])
            start, size = start + self.capacity, size - self.capacity
        if not size:
            return done
        h = self.best(size)
        if h:
            window = self.windows[h].pop()
            self.level[h] -= 1
            self.n_open -= 1
        else:
            window = []
        window.append((document, start, size))
        if h + size == self.capacity:
            done.append(window)
        else:
            self.windows.setdefault(h + size, []).append(window)
            self.level[h + size] += 1
            self.n_open += 1
        return done + (self.drain(False) if self.n_open > self.max_open else [])

    def drain(self, last: bool) -> list[list[tuple]]:
        """Empty the open windows, fullest first, into full ones; the rest stays
        open, or with ``last`` is cut at powers of two."""
        queue = [p for h in sorted(self.windows, reverse=True) for w in self.windows[h] for p in w]
        self.windows, self.n_open = {}, 0
        self.level[:] = 0
        left = sum(n for _, _, n in queue)
        done, window, room = [], [], min(self.capacity, left)
        if left < self.capacity:
            room = 1 << left.bit_length() - 1 if last and left else left
        for document, start, n in queue:
            while n:
                k = min(n, room)
                window.append((document, start, k))
                start, n, room, left = start + k, n - k, room - k, left - k
                if not room:
                    done.append(window)
                    window = []
                    room = min(self.capacity, left)
                    if left < self.capacity:
                        room = 1 << left.bit_length() - 1 if last and left else left
        if not last and done and sum(n for _, _, n in done[-1]) < self.capacity:
            rest = done.pop()
            fill = sum(n for _, _, n in rest)
            self.windows[fill] = [rest]
            self.level[fill] = self.n_open = 1
        return done


def pack(docs: DataFrame, tokenizer_path: str, end_id: int | None = 2, capacity: int = 4096, max_open: int = 2048) -> DataFrame:
    """Pieces of all documents (doc_id, text): window (sequence_id), place in it
    (offset), place in the document (start, length, doc_tokens) and ids, packed
    as little-endian unsigned 32-bit integers.

    A task holds the ids of its open windows, at most ``max_open`` times
    ``capacity``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        packer = SumOfSquares(capacity, max_open)
        first, number = TaskContext.get().partitionId() << 33, 0
        rows: list[tuple] = []
        held = 0

        def out() -> Iterator[pa.RecordBatch]:
            nonlocal held
            if rows:
                at = runs(np.array([r[2] for r in rows], np.int64))
                ids = np.concatenate([r[6] for r in rows])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], pa.int64()) for k in range(6)] + [binary_array(ids.astype("<u4"), at)],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
                rows.clear()
                held = 0

        def add(windows: list[list[tuple]]) -> None:
            nonlocal number, held
            for window in windows:
                offset = 0
                for (doc_id, ids, base, n_all), start, n in window:
                    rows.append((doc_id, start, n, n_all, first | number, offset, ids[start - base:start - base + n]))
                    offset += n
                held += offset
                number += 1

        for batch in text_batches(batches):
            ids, at = tokenizer.encode(batch["text"].to_pylist())
            if end_id is not None:
                ids, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
            for k, doc_id in enumerate(batch["doc_id"].to_pylist()):
                own = ids[at[k]:at[k + 1]]
                cut = len(own) // capacity * capacity
                for s in range(0, cut, capacity):
                    add([[((doc_id, own, 0, len(own)), s, capacity)]])
                    if held > OUT_IDS:
                        yield from out()
                add(packer.put((doc_id, own[cut:].copy(), cut, len(own)), cut, len(own) - cut))
                if held > OUT_IDS:
                    yield from out()
        add(packer.drain(True))
        yield from out()

    return id_text(docs).mapInArrow(run, SCHEMA)
