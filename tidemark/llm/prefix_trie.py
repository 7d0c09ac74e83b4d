"""Prefix trie of conversations in a minimal-perfect-hash node table.

A node is a distinct sequence of first turns. Its digest is the exclusive or of
position-keyed SHA-256 parts of its turns (120 bits), so digests of all prefixes
are running aggregates: within bands of ``BAND`` turns, with the totals of the
bands before, and a conversation of any length is never in one task.

A shard is a bounded stretch of rows (conversation, depth, prefix digest). Its
distinct digests get slots from a minimal perfect hash, each slot verified
against the digest it holds; counts are scattered into flat arrays over the
slots and accumulated through the array of parent slots, deepest level first.
Sums are linear, so any cut into shards is right: what a conversation has in
later bands enters at the last row of a band, and the shards' sums of a node (a
row for each shard that has it, however hot the node) are added by its digest.

The first accumulation counts members, the second sums over subtrees what each
node has by itself; it is placed on the path of the node's smallest member.

Defined results: turns come by (turn, null first; digest of role and text); null
role and text are empty; rows with a null conv_id are one conversation, which
counts as a member but has no id to show; an empty table has no nodes; repeated
rows are turns of their own; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_count, stored, text_or_empty
from tidemark.llm.ranks import ranked

BAND = 4096             # turns of a conversation that one shard holds together
SHARD_ROWS = 1 << 18
RUN_IDS = 4096          # conversation ids in one piece of text
WORDS = r"[^\x20\x09-\x0D]+"
NO_ID = (1 << 63) - 1
_GOLDEN, _MIX = 0x9E3779B97F4A7C15, np.uint64(0xBF58476D1CE4E5B9)


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, place, turn_hash, words, group_rows): the turns of each conversation in order."""
    role, text = text_or_empty("role"), text_or_empty("text")
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.encode(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), "UTF-8"), 256).alias("turn_hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"))
    return ranked(stored(rows, "op11-turns", "snappy"), "conv_id", ["turn", "turn_hash"], "op11-order").drop("turn")


def rebuilt(turns: DataFrame, block: int = 20, most: int = 4) -> tuple[DataFrame, DataFrame]:
    """Every conversation c with its first h turns taken from conversation
    ``c - c % block`` (all if it has fewer, none if it is absent), h = crc32 of the
    decimal c, modulo ``most``: turns (conv_id, place, turn_hash, words) and
    conversations (conv_id, n_turns). A null id borrows nothing."""
    turns = stored(turns, "op11-placed", "snappy")
    conv = F.col("conv_id")
    convs = turns.where("place = 0").select("conv_id", F.col("group_rows").alias("own"), (conv - conv % block).alias("base"),
                                            F.coalesce(F.crc32(conv.cast("string")) % most, F.lit(0)).alias("h"))
    sizes = convs.where("conv_id = base").select(F.col("conv_id").alias("b"), F.col("own").alias("b_rows"))
    convs = stored(convs.join(sizes, F.col("base") == F.col("b"), "left")
                   .select("conv_id", "base", "h", "own", F.least("h", F.coalesce("b_rows", F.lit(0))).alias("borrowed")), "op11-convs", "snappy")
    heads = turns.where((F.col("place") < most - 1) & (conv % block == 0)).select(F.col("conv_id").alias("b"), "place", "turn_hash", "words")   # a few rows of each base
    lent = convs.join(heads, F.col("base") == F.col("b")).where("place < h").select("conv_id", "place", "turn_hash", "words")
    facts = convs.select(conv.alias("c"), "h", "borrowed")
    kept = (turns.join(facts, conv.eqNullSafe(F.col("c"))).where("place >= h")
            .select("conv_id", (F.col("place") - F.col("h") + F.col("borrowed")).alias("place"), "turn_hash", "words"))
    return kept.unionByName(lent), convs.select("conv_id", (F.col("borrowed") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("n_turns"))


def _part(start: int) -> Column:
    """60 bits of the position-keyed digest of a turn."""
    keyed = F.sha2(F.encode(F.concat(F.col("place").cast("string"), F.lit(":"), F.col("turn_hash")), "UTF-8"), 256)
    return F.conv(F.substring(keyed, start, 15), 16, 10).cast("long")


def prefixes(turns: DataFrame, convs: DataFrame, band: int = BAND) -> DataFrame:
    """A row for each conversation and prefix of one turn or more: (conv_id, band,
    depth, hi, lo, p_hi, p_lo, words, ends: the whole conversation, closes: the last row of its band)."""
    rows = stored(turns.select("conv_id", F.floor(F.col("place") / band).alias("band"), "place", "words", _part(1).alias("a"), _part(16).alias("b")), "op11-parts", "snappy")
    totals = rows.groupBy("conv_id", "band").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    before = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, -1)        # a row for each band
    carried = (totals.select(F.col("conv_id").alias("c"), F.col("band").alias("c_band"), F.bit_xor("a").over(before).alias("c_a"), F.bit_xor("b").over(before).alias("c_b"))
               .where("c_band > 0"))
    own = Window.partitionBy("conv_id", "band").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    lengths = convs.select(F.col("conv_id").alias("l"), "n_turns")
    run = rows.select("*", F.bit_xor("a").over(own).alias("r_a"), F.bit_xor("b").over(own).alias("r_b"))
    met = (run.join(carried, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("band") == F.col("c_band")), "left")
           .join(lengths, F.col("conv_id").eqNullSafe(F.col("l"))))
    hi, lo = (F.col(f"r_{x}").bitwiseXOR(F.coalesce(f"c_{x}", F.lit(0))) for x in "ab")
    ends = F.col("place") == F.col("n_turns") - 1
    return met.select("conv_id", "band", (F.col("place") + 1).alias("depth"), hi.alias("hi"), lo.alias("lo"), hi.bitwiseXOR(F.col("a")).alias("p_hi"),
                      lo.bitwiseXOR(F.col("b")).alias("p_lo"), "words", ends.alias("ends"), (ends | (F.col("place") % band == band - 1)).alias("closes"))


class SlotTable:
    """Minimal perfect hash over distinct 120-bit keys: a level places the keys
    that are alone at their position, the others go on to the next level."""

    def __init__(self, hi: np.ndarray, lo: np.ndarray):
        self.levels: list[tuple[int, np.ndarray]] = []
        self.size, placed, left = len(hi), 0, np.arange(len(hi))
        slots = np.empty(len(hi), np.int64)
        while len(left):
            seed, width = len(self.levels) + 1, len(left) + len(left) // 2 + 1
            at = self._at(hi[left], lo[left], seed, width)
            alone = np.bincount(at, minlength=width) == 1
            rank = np.where(alone, placed + np.cumsum(alone) - 1, -1)
            hit = alone[at]
            slots[left[hit]] = rank[at[hit]]
            self.levels.append((seed, rank))
            placed, left = placed + int(alone.sum()), left[~hit]
        self.hi, self.lo = np.empty(self.size, np.int64), np.empty(self.size, np.int64)
        self.hi[slots], self.lo[slots] = hi, lo

    @staticmethod
    def _at(hi: np.ndarray, lo: np.ndarray, seed: int, width: int) -> np.ndarray:
        x = (hi.astype(np.uint64) + np.uint64(seed * _GOLDEN & NO_ID)) * _MIX
        x = (x ^ (x >> np.uint64(29)) ^ lo.astype(np.uint64)) * np.uint64(_GOLDEN)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(width)).astype(np.int64)

    def slots(self, hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for keys that the table does not hold."""
        out, todo = np.full(len(hi), -1, np.int64), np.arange(len(hi))
        for seed, rank in self.levels:
            got = rank[self._at(hi[todo], lo[todo], seed, len(rank))]
            out[todo] = got
            todo = todo[got < 0]
        known = out >= 0
        known[known] = (self.hi[out[known]] == hi[known]) & (self.lo[out[known]] == lo[known])     # verified against the slot's digest
        return np.where(known, out, -1)


class Shard:
    """Node table over rows of prefixes; ``add`` scatters, ``upwards`` accumulates."""

    def __init__(self, depth: np.ndarray, hi: np.ndarray, lo: np.ndarray, p_hi: np.ndarray, p_lo: np.ndarray, words: np.ndarray, band: int):
        root = (depth == 1).any()                         # the root has no row of its own
        hi, lo = (np.append(x, np.zeros(int(root), np.int64)) for x in (hi, lo))
        order = np.lexsort((lo, hi))
        first = np.ones(len(order), bool)
        first[1:] = (np.diff(hi[order]) != 0) | (np.diff(lo[order]) != 0)
        distinct = order[first]
        self.table = SlotTable(hi[distinct], lo[distinct])
        self.row_slot = self.table.slots(hi, lo)[:len(depth)]
        if (self.row_slot < 0).any():
            raise ValueError("a prefix has no slot")
        n = self.table.size
        self.depth, self.p_hi, self.p_lo, self.words = (np.zeros(n, np.int64) for _ in range(4))
        for own, values in ((self.depth, depth), (self.p_hi, p_hi), (self.p_lo, p_lo), (self.words, words)):
            own[self.row_slot] = values
        self.parent = self.table.slots(self.p_hi, self.p_lo)
        # the root has no parent; the first level of a later band gets to the band before through ``closes``
        self.parent[(self.depth != 1) & ((self.depth - 1) % band == 0) | (self.depth == 0)] = -1
        by_depth = np.argsort(-self.depth, kind="stable")
        cuts = np.flatnonzero(np.diff(self.depth[by_depth])) + 1
        self.levels = [x[self.parent[x] >= 0] for x in np.split(by_depth, cuts)]

    def add(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.table.size, np.int64)
        np.add.at(out, self.row_slot[rows], values)
        for slots in self.levels:
            np.add.at(out, self.parent[slots], out[slots])
        return out

    def least(self, rows: np.ndarray, values: np.ndarray) -> np.ndarray:
        out = np.full(self.table.size, NO_ID, np.int64)
        np.minimum.at(out, self.row_slot[rows], values)
        for slots in self.levels:
            np.minimum.at(out, self.parent[slots], out[slots])
        return out


def _shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.Table]:
    """Rows sorted by (conversation, band, depth), cut into tables of about ``limit`` rows at the ends of bands."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= limit:
            whole = pa.Table.from_batches(held)
            closes = np.flatnonzero(whole["closes"].to_numpy())
            cut = int(closes[-1]) + 1 if len(closes) else 0
            if cut:
                yield whole.slice(0, cut)
                held = whole.slice(cut).to_batches()
                n = whole.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def _by_band(rows: DataFrame) -> DataFrame:
    """Bands of conversations dealt over all tasks, each whole and in order."""
    return rows.repartition(shuffle_count(rows.sparkSession), "conv_id", "band").sortWithinPartitions("conv_id", "band", "depth")


def _shard_of(part: pa.Table, band: int) -> Shard:
    return Shard(*(part[c].to_numpy() for c in ("depth", "hi", "lo", "p_hi", "p_lo", "words")), band)


KEY = "depth long, hi long, lo long"


def members(rows: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """(depth, hi, lo, p_hi, p_lo, words, n_convs, n_known, conv_id) of all nodes with a turn, and of the root if a conversation has one."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, shard_rows):
            shard = _shard_of(part, band)
            last = np.flatnonzero(part["closes"].to_numpy())           # one row for each band of a conversation
            ids = part["conv_id"].combine_chunks().take(pa.array(last))
            known = ids.is_valid().to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (shard.depth, shard.table.hi, shard.table.lo, shard.p_hi, shard.p_lo, shard.words, shard.add(last, np.ones(len(last), np.int64)),
                                       shard.add(last, known.astype(np.int64)), shard.least(last, ids.fill_null(NO_ID).to_numpy()))],
                ["depth", "hi", "lo", "p_hi", "p_lo", "words", "n_convs", "n_known", "conv_id"])

    schema = f"{KEY}, p_hi long, p_lo long, words long, n_convs long, n_known long, conv_id long"
    return (_by_band(rows).mapInArrow(count, schema).groupBy("depth", "hi", "lo")
            .agg(F.min("p_hi").alias("p_hi"), F.min("p_lo").alias("p_lo"), F.min("words").alias("words"), F.sum("n_convs").alias("n_convs"),
                 F.sum("n_known").alias("n_known"), F.min("conv_id").alias("conv_id")))


def subtree_sums(rows: DataFrame, own: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """(depth, hi, lo, leaves, saved) summed over the subtrees of all nodes with a
    turn and of the root; ``own`` (c, c_depth, leaf, save) has what a node has by
    itself, at the row of its smallest member."""
    rows = stored(rows.join(own, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("depth") == F.col("c_depth")), "left")
                  .select(*rows.columns, F.coalesce("leaf", F.lit(0)).cast("long").alias("leaf"), F.coalesce("save", F.lit(0)).cast("long").alias("save")), "op11-own", "snappy")
    # what a conversation has in later bands, for its earlier ones
    totals = rows.groupBy("conv_id", "band").agg(F.sum("leaf").alias("leaf"), F.sum("save").alias("save"))
    later = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, -1)      # a row for each band
    below = totals.select(F.col("conv_id").alias("c"), F.col("band").alias("c_band"), F.sum("leaf").over(later).alias("b_leaf"), F.sum("save").over(later).alias("b_save")).where("b_leaf + b_save > 0")
    rows = rows.join(below, F.col("closes") & F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("band") == F.col("c_band")), "left").select(
        "conv_id", "band", "depth", "hi", "lo", "p_hi", "p_lo", "words", "closes",
        (F.col("leaf") + F.coalesce("b_leaf", F.lit(0))).alias("leaf"), (F.col("save") + F.coalesce("b_save", F.lit(0))).alias("save"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _shards(batches, shard_rows):
            shard = _shard_of(part, band)
            every = np.arange(part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shard.depth, shard.table.hi, shard.table.lo, shard.add(every, part["leaf"].to_numpy()),
                                                                    shard.add(every, part["save"].to_numpy()))], ["depth", "hi", "lo", "leaves", "saved"])

    return _by_band(rows).mapInArrow(add, f"{KEY}, leaves long, saved long").groupBy("depth", "hi", "lo").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, hi, lo, ends_sha256) of nodes at which conversations end, from rows
    (depth, hi, lo, conv_id): ranges of (node, id) join their ids to pieces of
    text, so ids of a hot node are joined in many tasks; the digest of a node then
    reads its pieces in order, one held at a time."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, current, ids = [], None, []

        def close() -> None:
            if ids:
                rows.append((*current, ids[0], ",".join(map(str, ids))))

        for batch in batches:
            for *node, conv_id in zip(*(batch[c].to_pylist() for c in ("depth", "hi", "lo", "conv_id"))):
                if node != current or len(ids) == RUN_IDS:
                    close()
                    current, ids = node, []
                ids.append(conv_id)
            yield from flush(rows, [pa.int64()] * 4 + [pa.string()], ["depth", "hi", "lo", "first", "ids"])
            rows = []
        close()
        yield from flush(rows, [pa.int64()] * 4 + [pa.string()], ["depth", "hi", "lo", "first", "ids"])

    def flush(rows: list[tuple], types: list, names: list[str]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, current, sha = [], None, None
        names, types = ["depth", "hi", "lo", "ends_sha256"], [pa.int64()] * 3 + [pa.string()]
        for batch in batches:
            for *node, ids in zip(*(batch[c].to_pylist() for c in ("depth", "hi", "lo", "ids"))):
                if node != current:
                    if sha:
                        rows.append((*current, sha.hexdigest()))
                    current, sha = node, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            yield from flush(rows, types, names)
            rows = []
        if sha:
            yield from flush([(*current, sha.hexdigest())], types, names)

    n = shuffle_count(ends.sparkSession)
    pieces = (ends.where("conv_id is not null").repartitionByRange(n, "depth", "hi", "lo", "conv_id").sortWithinPartitions("depth", "hi", "lo", "conv_id")
              .mapInArrow(join, f"{KEY}, first long, ids string"))
    return pieces.repartition(n, "depth", "hi", "lo").sortWithinPartitions("depth", "hi", "lo", "first").mapInArrow(digest, f"{KEY}, ends_sha256 string")


def trie(turns: DataFrame, convs: DataFrame, shard_rows: int = SHARD_ROWS, band: int = BAND) -> DataFrame:
    """Nodes of the trie of conversations ``convs`` (conv_id, n_turns; also those
    without turns) with ``turns`` (conv_id, place, turn_hash, words): conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    convs = stored(convs, "op11-lengths", "snappy")
    rows = stored(prefixes(turns, convs, band), "op11-prefixes", "snappy")
    zero = F.lit(0).cast("long")
    silent = convs.where("n_turns = 0").select("conv_id")
    root = silent.groupBy().agg(F.count(F.lit(1)).alias("n_convs"), F.count("conv_id").alias("n_known"), F.coalesce(F.min("conv_id"), F.lit(NO_ID)).alias("conv_id")).where("n_convs > 0")
    root = root.select(*[zero.alias(c) for c in ("depth", "hi", "lo", "p_hi", "p_lo", "words")], "n_convs", "n_known", "conv_id")
    merged = (members(rows, shard_rows, band).unionByName(root).groupBy("depth", "hi", "lo")
              .agg(*[F.min(c).alias(c) for c in ("p_hi", "p_lo", "words")], F.sum("n_convs").alias("n_convs"), F.sum("n_known").alias("n_known"), F.min("conv_id").alias("conv_id")))
    nodes = stored(merged.withColumn("conv_id", F.when(F.col("n_known") > 0, F.col("conv_id"))).drop("n_known"), "op11-nodes", "snappy")
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("p_hi").alias("hi"), F.col("p_lo").alias("lo")).agg(F.count(F.lit(1)).alias("n_children"))
    key = ["depth", "hi", "lo"]
    nodes = stored(nodes.join(children, key, "left").withColumn("n_children", F.coalesce("n_children", zero)), "op11-children", "snappy")
    own = (nodes.where("depth > 0").select(F.col("conv_id").alias("c"), F.col("depth").alias("c_depth"), (F.col("n_children") == 0).cast("long").alias("leaf"),
                                           ((F.col("n_convs") - 1) * F.col("words")).alias("save")).where("leaf + save > 0"))
    sums = subtree_sums(rows, own, shard_rows, band)
    ends = rows.where("ends").select(*key, "conv_id").unionByName(silent.select(*[zero.alias(c) for c in key], "conv_id"))
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("hi").alias("p_hi"), F.col("lo").alias("p_lo"), F.col("conv_id").alias("parent_conv_id"))
    nothing = hashlib.sha256(b"").hexdigest()
    return (nodes.join(sums, key, "left").join(end_digests(ends), key, "left").join(parents, ["depth", "p_hi", "p_lo"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
                    F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),         # a lone root has no rows below it
                    F.coalesce("saved", zero).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256")))
