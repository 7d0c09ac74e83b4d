"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint has 64 bits; bit j is 1 if it is set in over half of the XXH64
hashes of the document's word shingles. Two fingerprints within ``max_bits``
share a variant: one within ``max_bits // 2`` of the first and within the other
half of the second. Every distinct fingerprint goes to each shuffle bucket (a
value of the leading bits) that its ball touches; there its variants are
generated and sorted, and equal variants meet.

All fingerprints that meet at a variant are tied to one of them that lies
within the smaller half, after the distance is verified: each is within
``max_bits`` of it, so no pairs of a group are multiplied, and links of a bucket
are thinned to a spanning forest before they leave the task. No link between
components of the full link graph is lost by that.

Defined results: a null or wordless text has fingerprint zero and links like
any other; fewer words than a shingle hash as one sequence; a null doc_id is
kept (its component is that of its links, null if they have no id); repeated
rows each have their group; an empty table gives no rows; further columns are
ignored by ``simhash_groups`` and kept by ``keep_first``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_text, stored, text_batches
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import digest

HASHES = 1 << 18        # shingle hashes counted at once
VARIANTS = 1 << 22      # variants sorted at once
BUCKET_ROWS = 1 << 17   # fingerprints that a shuffle bucket is made for


def fingerprint(text: str, shingle: int) -> int:
    """64-bit SimHash of a text: A-Z lowered, words between ASCII white space."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line, digest = b" ".join(words), xxhash.xxh64_intdigest
    n = max(1, len(words) - shingle + 1)
    ends = (np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    last = ends[shingle - 1:] if len(words) >= shingle else [len(line)]
    ones = np.zeros(64, np.int64)
    for k in range(0, n, HASHES):
        h = np.array([digest(line[a:b], 42) for a, b in zip(starts[k:min(n, k + HASHES)], last[k:k + HASHES])], "<u8")
        ones += bit_counts(h)
    return int((ones * 2 > n).astype(np.uint64) @ (np.uint64(1) << np.arange(64, dtype=np.uint64)))


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit (lowest first)."""
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)


def fingerprints(docs: DataFrame, shingle: int = 4) -> DataFrame:
    """(doc_id, fp) of ``docs`` (doc_id, text), fp the 64 bits as a signed long."""
    return with_fingerprints(id_text(docs), shingle)


def with_fingerprints(rows: DataFrame, shingle: int) -> DataFrame:
    """``rows`` with the fingerprint fp instead of their text."""
    others = [f for f in rows.schema if f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch["text"].to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*(batch[f.name] for f in others), pa.array(fps.view(np.int64))], [*(f.name for f in others), "fp"])

    return rows.mapInArrow(run, ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in others), "fp long"]))


def flips(first: int, last: int, radius: int) -> np.ndarray:
    """All masks with at most ``radius`` of the bits first..last-1 set, fewest first."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(first, last), r)], np.uint64)


def bucket_links(fps: np.ndarray, bucket: int, lead: int, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among distinct fingerprints whose balls touch a bucket: (index, index), a spanning forest.

    The bucket's variants all start with its ``lead`` bits, so a fingerprint
    whose lead differs in d bits spends d flips on it and has the rest of its
    radius for the other bits. Variants are made for one value of the following
    bits at a time, so memory stays bounded.
    """
    wide, narrow = max_bits - max_bits // 2, max_bits // 2
    tail = np.uint64((1 << (64 - lead)) - 1)
    away = np.bitwise_count((fps >> np.uint64(64 - lead)) ^ np.uint64(bucket)).astype(np.int64)
    parent = np.arange(len(fps))
    # slices by the next bits: as many as keep the variants of one slice near VARIANTS
    per = sum(int((away == d).sum()) * len(flips(0, 64 - lead, wide - d)) for d in range(wide + 1))
    more = 0
    while per >> more > VARIANTS and more < 12:
        more += 1
    for piece in range(1 << more):
        low = 64 - lead - more
        next_away = np.bitwise_count(((fps & tail) >> np.uint64(low)) ^ np.uint64(piece)).astype(np.int64) if more else np.zeros(len(fps), np.int64)
        spent = away + next_away
        variants, index, dist = [], [], []
        rest = fps & np.uint64((1 << low) - 1)
        for d in range(wide + 1):
            at = np.flatnonzero(spent == d)
            if len(at):
                masks = flips(0, low, wide - d)
                variants.append((rest[at][:, None] ^ masks[None, :]).ravel())
                index.append(np.repeat(at, len(masks)))
                dist.append(np.tile(d + np.bitwise_count(masks), len(at)))
        if not variants:
            continue
        v, i, r = np.concatenate(variants), np.concatenate(index), np.concatenate(dist)
        order = np.argsort(v)
        v = v[order]
        same = v[1:] == v[:-1]
        meet = np.flatnonzero(np.append(same, False) | np.insert(same, 0, False))
        if not len(meet):
            continue
        v, i, r = v[meet], i[order[meet]], r[order[meet]]
        by = np.lexsort((i, r, v))                       # nearest member first in each group
        v, i, r = v[by], i[by], r[by]
        group = np.cumsum(np.insert(v[1:] != v[:-1], 0, False))
        head = np.flatnonzero(np.insert(np.diff(group) > 0, 0, True))
        centre = i[head][group]
        ok = (r[head] <= narrow)[group] & (centre != i) & (np.bitwise_count(fps[centre] ^ fps[i]) <= max_bits)
        union(parent, centre[ok], i[ok])
    child = np.flatnonzero(parent != np.arange(len(fps)))
    return child, parent[child]


def union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of a[k] and b[k] in ``parent`` (every node points to its root):
    roots hook onto smaller roots, then paths are shortened, until nothing changes."""
    while len(a):
        ra, rb = parent[a], parent[b]
        open_ = ra != rb
        if not open_.any():
            return
        a, b, ra, rb = a[open_], b[open_], ra[open_], rb[open_]
        np.minimum.at(parent, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent[:] = up


def lead_bits(n: int, max_bits: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Leading bits that make a bucket: enough for about ``bucket_rows`` of n fingerprints in each."""
    wide, lead = max_bits - max_bits // 2, 10
    while lead < 28 and n * len(flips(0, lead, wide)) >> lead > bucket_rows:
        lead += 1
    return lead


def links(distinct: DataFrame, max_bits: int = 4, lead: int | None = None) -> DataFrame:
    """(a, b) links between fingerprints (column fp, distinct) that keep every
    component. Buckets follow the number of fingerprints, results do not."""
    if not 0 <= max_bits <= 8:
        raise ValueError("max_bits of 0 to 8 are supported")
    lead = lead or lead_bits(distinct.count(), max_bits)
    wide = max_bits - max_bits // 2
    touch = flips(0, lead, wide).astype(np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch["fp"].to_numpy().view(np.uint64)
            for a in range(0, len(fps), 1 << 14):
                part = fps[a:a + (1 << 14)]
                buckets = ((part >> np.uint64(64 - lead)).astype(np.int64)[:, None] ^ touch[None, :]).ravel()
                yield pa.RecordBatch.from_arrays([pa.array(buckets.astype(np.int32)), pa.array(np.repeat(part, len(touch)).view(np.int64))], ["bucket", "fp"])

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        fps = table["fp"].to_numpy().view(np.uint64)
        child, root = bucket_links(fps, key[0].as_py(), lead, max_bits)
        return pa.table({"a": fps[child].view(np.int64), "b": fps[root].view(np.int64)})

    return (distinct.select("fp").mapInArrow(deal, "bucket int, fp long")
            .groupBy("bucket").applyInArrow(meet, "a long, b long").distinct())


def least_by_component(rows: DataFrame, value: Column, max_bits: int) -> DataFrame:
    """(fp, least): the least ``value`` of all ``rows`` (fp, ...) in the component of each fingerprint."""
    classes = stored(rows.groupBy("fp").agg(F.min(value).alias("first")), "op6-classes", "snappy")
    found = components(links(classes, max_bits))
    linked = classes.join(found.select(F.col("node").alias("fp"), "root"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = linked.groupBy("root").agg(F.min("first").alias("least"))
    return stored(linked.join(least, "root").select("fp", "least"), "op6-components", "snappy")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable
    over links of at most ``max_bits`` differing bits."""
    rows = stored(fingerprints(docs, shingle), "op6-fingerprints", "snappy")
    named = least_by_component(rows, F.col("doc_id"), max_bits)
    return rows.join(named.hint("merge"), "fp").select("doc_id", "fp", F.col("least").alias("component_id"))


def keep_first(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one of the
    smallest doc_id (null last), then of the smallest digest of the text. Rows that
    leave are named by doc_id and digest (they are few, so Spark may broadcast them
    below its size limit instead of shuffling the texts)."""
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    rows = stored(with_fingerprints(id_text(docs).withColumn("digest", digest()), shingle), "op6-fingerprints", "snappy")
    named = least_by_component(rows, key, max_bits)
    stays = F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("digest") == F.col("least.digest"))
    judged = stored(rows.join(named.hint("merge"), "fp").groupBy("doc_id", "digest", stays.alias("stays")).count(), "op6-judged", "snappy")
    gone = judged.where("not stays").select(F.col("doc_id").alias("__gone_id"), F.col("digest").alias("__gone_digest"))
    gone = stored(gone, "op6-gone", "snappy")
    out = docs.withColumn("__digest", digest()).join(
        gone, (F.col("__digest") == F.col("__gone_digest")) & F.col("doc_id").cast("long").eqNullSafe(F.col("__gone_id")), "left_anti")
    if not judged.where("stays and count > 1").isEmpty():            # exact copies under one id
        out = out.dropDuplicates(["doc_id", "__digest"])
    return out.drop("__digest")
