"""Token-ID output: canonical length-limited Huffman files.

``write_ids`` tokenizes whole texts, counts every id over all documents, builds
one canonical code with at most ``max_bits`` bits and writes the documents in
ascending id order as files that can be decoded block by block:

* magic, then the code length of every id (one byte each): the canonical code
  follows from these alone;
* payload: for each document its code words, first bit highest, starting on a
  32-bit boundary;
* index: per document its id, number of ids and payload words, then the bit
  offset (from the document's first bit) of every ``CHECKPOINT``-th id;
* position of the index and magic.

Decoding starts at any checkpoint; ``read_ids`` decodes all checkpoints of a
run of documents side by side, one table look-up per id.

Defined results: a null text counts as empty; a null document id is kept and
sorts first; repeated rows are each written; an empty table gives no files and
no rows; further columns are ignored.
"""

from __future__ import annotations

import struct
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import binary_array, id_text, open_fs, runs, shuffle_count, stored, text_batches, write_file
from tidemark.llm.ranks import ranked
from tidemark.llm.tokens import word_tokenizer
from tidemark.session import scratch_path

MAGIC = b"TMHUFF01"
CHECKPOINT = 256          # ids between two bit-offset checkpoints
DECODE_IDS = 4_000_000    # ids decoded side by side
ENCODE_IDS = 2_000_000    # ids coded at once
ROLL_BYTES = 256 << 20    # payload bytes of one file


# ---- the code -------------------------------------------------------------

def code_lengths(counts: np.ndarray, max_bits: int) -> np.ndarray:
    """Optimal code lengths of at most ``max_bits`` (package-merge); ids that
    never occur get length 0, a single occurring id gets 1."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << max_bits:
        raise ValueError(f"{len(used)} ids do not fit codes of {max_bits} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[order].astype(np.float64)
    items, is_leaf = leaves, [np.ones(len(leaves), bool)]
    for _ in range(max_bits - 1):
        pairs = items[0:len(items) // 2 * 2:2] + items[1:len(items) // 2 * 2:2]
        both = np.concatenate((leaves, pairs))
        at = np.argsort(both, kind="stable")
        items = both[at]
        is_leaf.append(at < len(leaves))
    take, n_bits = 2 * len(leaves) - 2, np.zeros(len(leaves), np.int64)
    for flags in reversed(is_leaf):
        n_leaves = int(flags[:take].sum())
        n_bits[:n_leaves] += 1
        take = 2 * (take - n_leaves)
    lengths[order] = n_bits
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Code words by (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    per_length = np.bincount(lengths, minlength=int(lengths.max(initial=0)) + 1)
    first = 0
    for n in range(1, len(per_length)):
        first = (first + (int(per_length[n - 1]) if n > 1 else 0)) << 1
        ids = np.flatnonzero(lengths == n)
        codes[ids] = first + np.arange(len(ids), dtype=np.uint64)
    return codes


class Code:
    """Canonical code of the given lengths, with its look-up table."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths.astype(np.int64)
        self.codes = canonical_codes(lengths)
        self.bits = max(1, int(lengths.max(initial=0)))

    def encode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words as big-endian uint32, word offsets by document, checkpoints, checkpoint offsets by document)."""
        n_docs = len(offsets) - 1
        n_bits = self.lengths[ids]
        before = runs(n_bits)
        doc_bits = before[offsets[1:]] - before[offsets[:-1]]
        words_at = runs((doc_bits + 31) >> 5)
        doc_len = np.diff(offsets)
        start = before[:-1] - np.repeat(before[offsets[:-1]], doc_len)       # bits from the document's first
        within = np.arange(len(ids)) - np.repeat(offsets[:-1], doc_len)
        marks = start[within % CHECKPOINT == 0].astype("<u4" if not len(start) or start.max() < 1 << 32 else "<u8")
        if marks.dtype.itemsize == 8:
            raise ValueError("a document's code is longer than 2**32 bits")
        marks_at = runs((doc_len + CHECKPOINT - 1) // CHECKPOINT)
        position = start + np.repeat(words_at[:-1], doc_len) * 32
        words = np.zeros(int(words_at[n_docs]) + 1, np.uint64)
        if len(ids):
            shifted = self.codes[ids] << (64 - (position & 31) - n_bits).astype(np.uint64)
            word = position >> 5
            first = np.concatenate(([0], np.flatnonzero(np.diff(word)) + 1))
            words[word[first]] = np.bitwise_or.reduceat(shifted >> np.uint64(32), first)
            words[word[first] + 1] |= np.bitwise_or.reduceat(shifted & np.uint64(0xFFFFFFFF), first)
        return words[:-1].astype(">u4"), words_at, marks, marks_at

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(id, code length) of every ``bits``-bit prefix."""
        if not hasattr(self, "_table"):
            ids, n_bits = np.zeros(1 << self.bits, np.uint32), np.ones(1 << self.bits, np.uint8)
            used = np.flatnonzero(self.lengths)
            used = used[np.lexsort((used, self.lengths[used]))]
            spans = 1 << (self.bits - self.lengths[used])
            ids[:spans.sum()] = np.repeat(used, spans)
            n_bits[:spans.sum()] = np.repeat(self.lengths[used], spans)
            self._table = ids, n_bits
        return self._table

    def decode(self, words: np.ndarray, positions: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """ids of all blocks in order; block i has ``counts[i]`` ids from bit ``positions[i]`` on."""
        ids, n_bits = self.table
        out = np.empty(int(counts.sum()), np.uint32)
        order = np.argsort(-counts, kind="stable")
        at, to, left = positions[order].astype(np.int64), runs(counts)[:-1][order], counts[order]
        words = np.concatenate((words, np.zeros(2, words.dtype))).astype(np.uint64)
        pairs = (words[:-1] << np.uint64(32)) | words[1:]
        shift, mask = 64 - self.bits, np.uint64((1 << self.bits) - 1)
        active = len(left)
        for k in range(int(left[0]) if len(left) else 0):
            while left[active - 1] <= k:
                active -= 1
            here = at[:active]
            look = (pairs[here >> 5] >> (shift - (here & 31)).astype(np.uint64)) & mask
            out[to[:active] + k] = ids[look]
            at[:active] += n_bits[look]
        return out


# ---- Spark ----------------------------------------------------------------

def token_ids(docs: DataFrame, tokenizer_path: str, end_id: int | None) -> DataFrame:
    """(doc_id, tie, row, n_ids, ids): ids as packed little-endian integers of 2 bytes
    (4 for a vocabulary over 65,536); tie orders rows of one doc_id, row is a number of its own."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(tokenizer_path)
        width, row = id_type(tokenizer.vocab_size, end_id), TaskContext.get().partitionId() << 40
        for batch in text_batches(batches):
            numbers = row + np.arange(batch.num_rows)
            row += batch.num_rows
            ids, at = tokenizer.encode(batch["text"].to_pylist())
            if end_id is not None:
                ids, at = np.insert(ids, at[1:], end_id), at + np.arange(len(at))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["tie"], pa.array(numbers), pa.array(np.diff(at)), binary_array(ids.astype(width), at)],
                                             ["doc_id", "tie", "row", "n_ids", "ids"])

    return (id_text(docs).withColumn("tie", F.xxhash64("text"))
            .mapInArrow(encode, "doc_id long, tie long, row long, n_ids long, ids binary"))


def part_starts(tokens: DataFrame, parts: int) -> list[tuple]:
    """Keys of the rows at which parts of equal numbers of documents begin, exact places in
    the order (doc_id null first, tie, row); ``parts - 1`` rows at most reach the driver."""
    placed = ranked(tokens.select(F.lit(0).alias("all"), "doc_id", "tie", "row"), "all", ["doc_id", "tie", "row"], "op1-order")
    part = lambda place: F.expr(f"(({place}) * {parts}L) div group_rows")
    cuts = placed.where((F.col("place") > 0) & (part("place") != part("place - 1"))).select("doc_id", "tie", "row").collect()
    return sorted(order_key(*r) for r in cuts)


def order_key(doc_id: int | None, tie: int, row: int) -> tuple:
    return doc_id is not None, doc_id or 0, tie, row


def id_type(vocab_size: int, end_id: int | None) -> str:
    return "<u2" if max(vocab_size, (end_id or 0) + 1) <= 1 << 16 else "<u4"


def id_counts(tokens: DataFrame, size: int, width: str) -> np.ndarray:
    """Occurrences of every id over all documents. At most ``size`` rows (the vocabulary) reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for ids in batch["ids"]:
                total += np.bincount(np.frombuffer(ids.as_buffer(), width), minlength=size)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for row in tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).collect():
        counts[row["id"]] = row["n"]
    return counts


def write_ids(docs: DataFrame, out: str, tokenizer_path: str, end_id: int | None = 1, max_bits: int = 20,
              files: int | None = None, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``docs`` (doc_id, text) under ``out`` in ascending doc_id order; returns
    the manifest (part, piece, path, n_docs, n_ids, n_bytes), also stored there.

    Parts hold equal numbers of documents, cut at exact places of their order, so null
    or repeated ids are cut too; one task writes one part and rolls its files by size.
    Only coded documents are shuffled.
    """
    spark = docs.sparkSession
    parts = files or shuffle_count(spark)
    tokenizer = word_tokenizer(tokenizer_path)
    size, width = max(tokenizer.vocab_size, (end_id or 0) + 1), id_type(tokenizer.vocab_size, end_id)
    tokens = stored(token_ids(docs, tokenizer_path, end_id), "op1-ids")
    lengths = spark.sparkContext.broadcast(code_lengths(id_counts(tokens, size, width), max_bits))  # one byte per vocabulary id
    starts = part_starts(tokens, parts)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Code(lengths.value)
        for batch in batches:
            n_ids = batch["n_ids"].to_numpy()
            edges = np.unique(np.concatenate(([0], np.searchsorted(np.cumsum(n_ids), np.arange(ENCODE_IDS, int(n_ids.sum()), ENCODE_IDS), "right"), [len(n_ids)])))
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                rows = batch.slice(a, b - a)
                ids = np.frombuffer(b"".join(x.as_buffer() for x in rows["ids"]), width)
                words, words_at, marks, marks_at = code.encode(ids, runs(n_ids[a:b]))
                part = [bisect_right(starts, order_key(*key)) for key in zip(*(rows[c].to_pylist() for c in ("doc_id", "tie", "row")))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.int32()), rows["doc_id"], rows["tie"], rows["row"], rows["n_ids"],
                     binary_array(words, words_at), binary_array(marks, marks_at)],
                    ["part", "doc_id", "tie", "row", "n_ids", "code", "marks"])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part, attempt, piece, rows = task.partitionId(), f"{task.taskAttemptId()}", 0, iter_rows(batches)
        row = next(rows, None)
        while row is not None:
            index: list[tuple] = []
            row_box = [row]

            def body() -> Iterator[bytes]:
                size = 0
                yield MAGIC + struct.pack("<I", len(lengths.value)) + lengths.value.tobytes()
                while row_box[0] is not None and size < roll_bytes:
                    doc_id, n_ids, code, marks = row_box[0]
                    index.append((doc_id, n_ids, len(code) // 4, marks))
                    size += len(code)
                    yield code
                    row_box[0] = next(rows, None)
                yield index_bytes(index, size + 12 + len(lengths.value))

            path = f"{out}/part-{part:06d}-{piece:04d}.ids"
            n_bytes = write_file(path, attempt, body())
            row, piece = row_box[0], piece + 1
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in (
                (part, pa.int64()), (piece - 1, pa.int64()), (path, pa.string()), (len(index), pa.int64()),
                (sum(i[1] for i in index), pa.int64()), (n_bytes, pa.int64()))],
                ["part", "piece", "path", "n_docs", "n_ids", "n_bytes"])

    (tokens.mapInArrow(encode, "part int, doc_id long, tie long, row long, n_ids long, code binary, marks binary")
     .repartitionById(len(starts) + 1, F.col("part"))
     .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie", "row")
     .mapInArrow(write, "part long, piece long, path string, n_docs long, n_ids long, n_bytes long")
     .write.parquet(f"{out}/_manifest"))
    return spark.read.parquet(f"{out}/_manifest")


def iter_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch[c].to_pylist() for c in ("doc_id", "n_ids", "code", "marks")))


def index_bytes(index: list[tuple], position: int) -> bytes:
    n = len(index)
    ids = np.array([0 if i[0] is None else i[0] for i in index], "<i8")
    null = np.array([i[0] is None for i in index], "u1")
    sizes = np.array([(i[1], i[2]) for i in index], "<i8").reshape(n, 2)
    return b"".join([struct.pack("<Q", n), ids.tobytes(), null.tobytes(), sizes.tobytes(), *(i[3] for i in index), struct.pack("<Q", position), MAGIC])


@lru_cache(maxsize=2)
def _code_of(lengths: bytes) -> Code:
    return Code(np.frombuffer(lengths, np.uint8))


def read_file(path: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, null flags, ids, offsets) of runs of documents of one file."""
    fs, bare = open_fs(path)
    with fs.open_input_file(bare) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        head = f.read_at(12, 0)
        if head[:8] != MAGIC or tail[8:] != MAGIC:
            raise ValueError(f"{path} is no complete id file")
        vocab = struct.unpack("<I", head[8:])[0]
        code = _code_of(f.read_at(vocab, 12))
        position = struct.unpack("<Q", tail[:8])[0]
        raw = f.read_at(size - 16 - position, position)
        n = struct.unpack_from("<Q", raw)[0]
        doc_ids = np.frombuffer(raw, "<i8", n, 8)
        null = np.frombuffer(raw, "u1", n, 8 + 8 * n)
        n_ids, n_words = np.frombuffer(raw, "<i8", 2 * n, 8 + 9 * n).reshape(n, 2).T
        n_marks = (n_ids + CHECKPOINT - 1) // CHECKPOINT
        marks = np.frombuffer(raw, "<u4", int(n_marks.sum()), 8 + 25 * n).astype(np.int64)
        words_at, marks_at, before = runs(n_words), runs(n_marks), runs(n_ids)
        a = 0
        while a < n:
            b = max(a + 1, int(np.searchsorted(before, before[a] + DECODE_IDS, "right")) - 1)
            words = np.frombuffer(f.read_at(int(words_at[b] - words_at[a]) * 4, 12 + vocab + int(words_at[a]) * 4), ">u4")
            own = n_marks[a:b]
            first = np.repeat((words_at[a:b] - words_at[a]) * 32, own)
            nth = np.arange(int(own.sum())) - np.repeat(runs(own)[:-1], own)
            counts = np.minimum(CHECKPOINT, np.repeat(n_ids[a:b], own) - nth * CHECKPOINT)
            yield doc_ids[a:b], null[a:b], code.decode(words, first + marks[marks_at[a]:marks_at[b]], counts), runs(n_ids[a:b])
            a = b


def read_ids(spark: SparkSession, out: str) -> DataFrame:
    """Documents of the files of a manifest: (doc_id, start, n_tokens, ids), ids as
    little-endian unsigned 32-bit integers, start the ids of all documents before."""
    manifest = spark.read.parquet(f"{out}/_manifest")
    order = Window.orderBy("part", "piece")   # a row per file
    files = manifest.select("path", (F.sum("n_ids").over(order) - F.col("n_ids")).alias("first"),
                            (F.row_number().over(order) - 1).cast("int").alias("file"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch["path"].to_pylist(), batch["first"].to_pylist()):
                for doc_ids, null, ids, at in read_file(path):
                    edges = np.unique(np.concatenate((np.searchsorted(at, np.arange(0, at[-1], ENCODE_IDS)), [0, len(doc_ids)])))
                    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(doc_ids[a:b], mask=null[a:b].astype(bool)), pa.array(first + at[a:b]), pa.array(np.diff(at[a:b + 1])),
                             binary_array(ids[at[a]:at[b]], at[a:b + 1] - at[a])], ["doc_id", "start", "n_tokens", "ids"])
                    first += int(at[-1])

    return (files.repartitionById(max(1, manifest.count()), F.col("file"))
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary"))


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int | None = 1, max_bits: int = 20) -> DataFrame:
    """Write ``docs`` to a fresh folder of the shared scratch space and read the files back."""
    out = scratch_path(docs.sparkSession, "op1-files")
    write_ids(docs, out, tokenizer_path, end_id, max_bits)
    return read_ids(docs.sparkSession, out)
