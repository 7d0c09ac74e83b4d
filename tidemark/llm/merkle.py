"""Merkle manifest of a dataset, with an inclusion proof for each row.

Every row is a leaf: the SHA-256 of its fields, each with its length. Leaves of
a group (a language) form a binary tree by ascending id whose root is the
group's subroot; the subroots, by group, form the tree of the dataset. A digest
enters the next as lowercase hex text.

The trees are built from blocks of 1,024 neighbours: one shuffle makes ten
levels, and for every node the segment towards its parent (its place in the run
and the run's other digests). Proofs come from pointer jumping over these
segments: a self-join of the nodes with the ancestors they point to appends the
ancestor's segment and doubles the distance, so proofs of depth D take log2 D
joins. After each, only nodes at levels that are multiples of the distance go
on (all that a leaf still needs). At distance d an ancestor has at most 2**d
nodes under it, whatever the size of its group.

Defined results: null fields are written ``-``; null ids come first; rows of one
id are ordered by leaf digest; copies of a row are leaves of their own; null is
a group of its own and comes first; an empty table has no rows and no root;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shuffle_count, stored
from tidemark.llm.ranks import ranked

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
LEVELS = 10             # levels built by one shuffle: blocks of 2**LEVELS nodes
TOP = -1                # group of the nodes above the subroots
_NODES = "kind int, g long, level int, idx long, n long, data binary"
_EDGE, _NODE, _ROOT = 0, 1, 2


def leaf_digest(fields: dict[str, Column]) -> Column:
    """SHA-256 (32 bytes) of all fields: ``-`` for null, else byte count, ``:``, value."""
    parts = []
    for value in fields.values():
        text = value.cast("string")
        parts.append(F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)))
    return F.unhex(F.sha2(F.encode(F.concat(*parts), "UTF-8"), 256))


def height(n: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    return max(0, n - 1).bit_length()


def joined(digests: list[bytes]) -> bytes:
    """Digest of a run of digests, which enter as hex text."""
    return hashlib.sha256(b"".join(digests).hex().encode()).digest()


def fold(leaf: bytes, proof: bytes) -> bytes:
    """The root that a leaf and its proof give."""
    node, at = leaf, 0
    while at < len(proof):
        place, others = proof[at], proof[at + 1]
        at += 2
        split, end = at + 32 * place, at + 32 * others
        node = hashlib.sha256((proof[at:split] + node + proof[split:end]).hex().encode()).digest()
        at = end
    return node


def siblings(proof: bytes) -> bytes:
    """All digests of a proof in order."""
    out, at = [], 0
    while at < len(proof):
        end = at + 2 + 32 * proof[at + 1]
        out.append(proof[at + 2:end])
        at = end
    return b"".join(out)


def _blocks(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[tuple]:
    """(group, level, first index, nodes of the level, digests) of blocks of sorted rows."""
    current, digests = None, []
    for batch in batches:
        for g, level, idx, n, digest in zip(*(batch[c].to_pylist() for c in ("g", "level", "idx", "n", "data"))):
            key = (g, level, idx >> levels << levels, n)
            if key != current:
                if digests:
                    yield *current, digests
                current, digests = key, []
            digests.append(digest)
    if digests:
        yield *current, digests


def _grow(batches: Iterator[pa.RecordBatch], levels: int) -> Iterator[pa.RecordBatch]:
    """Edges of the next ``levels`` levels, and the nodes that stand above them."""
    rows: list[tuple] = []
    for g, level, first, n, digests in _blocks(batches, levels):
        top = level + levels
        while n > 1 and level < top:
            above = []
            for k in range(0, len(digests), 2):
                run = digests[k:k + 2]
                for place in range(len(run)):
                    rows.append((_EDGE, g, level, first + k + place, n, bytes((place, len(run) - 1)) + b"".join(run[:place] + run[place + 1:])))
                above.append(joined(run))
            digests, first, n, level = above, first >> 1, n + 1 >> 1, level + 1
        rows.append((_ROOT if n == 1 else _NODE, g, level, first, n, digests[0]))
        if len(rows) >= 1 << 15:
            yield _batch(rows)
            rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [f.split()[0] for f in _NODES.split(", ")])


def tree(leaves: DataFrame, name: str, levels: int = LEVELS) -> tuple[DataFrame, DataFrame]:
    """``leaves`` (g, idx, n, data: digest; n the leaves of group g) → edges (g,
    level, idx, data: segment towards the parent) and roots (g, data: digest)."""
    nodes, edges, roots = leaves.withColumn("level", F.lit(0)), None, None
    while True:
        made = stored(nodes.select("g", "level", "idx", "n", "data")
                      .repartition(shuffle_count(leaves.sparkSession), "g", F.shiftright("idx", levels))
                      .sortWithinPartitions("g", "idx").mapInArrow(partial(_grow, levels=levels), _NODES), name)
        own_edges, own_roots = made.where(f"kind = {_EDGE}").select("g", "level", "idx", "data"), made.where(f"kind = {_ROOT}").select("g", "data")
        edges = own_edges if edges is None else edges.union(own_edges)
        roots = own_roots if roots is None else roots.union(own_roots)
        nodes = made.where(f"kind = {_NODE}")
        if nodes.isEmpty():
            return edges, roots


def jump(edges: DataFrame, depth: int) -> DataFrame:
    """Pointer jumping over ``edges`` (level, g, idx, to_g, to_idx, seg) of a tree of
    ``depth`` levels → (g, idx, seg) of all nodes of level 0, segments up to the root."""
    distance = 1
    while distance < depth:
        low = edges.where(F.col("level") % F.lit(2 * distance) == 0)
        high = edges.where(F.col("level") % F.lit(2 * distance) == distance).select(
            (F.col("level") - distance).alias("u_level"), F.col("g").alias("u_g"), F.col("idx").alias("u_idx"),
            F.col("to_g").alias("u_to_g"), F.col("to_idx").alias("u_to_idx"), F.col("seg").alias("u_seg"))
        met = low.join(high, (F.col("level") == F.col("u_level")) & (F.col("to_g") == F.col("u_g")) & (F.col("to_idx") == F.col("u_idx")), "left")
        edges = stored(met.select("level", "g", "idx", F.coalesce("u_to_g", "to_g").alias("to_g"), F.coalesce("u_to_idx", "to_idx").alias("to_idx"),
                                  F.when(F.col("u_seg").isNull(), F.col("seg")).otherwise(F.concat("seg", "u_seg")).alias("seg")), "op12-jump")
        distance *= 2
    return edges.where("level = 0").select("g", "idx", "seg")


def manifest(docs: DataFrame, tampered: Callable[[dict[str, Column]], dict[str, Column]] | None = None, fields: tuple[str, ...] = FIELDS,
             id_col: str = "doc_id", group_col: str = "lang", levels: int = LEVELS) -> DataFrame:
    """A row for each row of ``docs``: (doc_id, leaf, other, subroot, root, proof),
    digests of 32 bytes, ``proof`` for ``fold``.

    ``tampered`` maps the field columns to changed ones; ``other`` is then the leaf
    of the changed row, else null.
    """
    spark = docs.sparkSession
    own = {c: F.col(c) for c in fields}
    other = leaf_digest(tampered(own)) if tampered else F.lit(None).cast("binary")
    rows = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(group_col).cast("string").alias("part"),
                              leaf_digest(own).alias("leaf"), other.alias("other")), "op12-leaves", "snappy")
    placed = ranked(rows, "part", ["doc_id", "leaf"], "op12-order")
    sizes = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n")).withColumn("all", F.lit(0))
    groups = stored(ranked(stored(sizes, "op12-sizes", "snappy"), "all", ["part"], "op12-groups")
                    .select(F.col("part").alias("g_part"), F.col("place").alias("g"), "n"), "op12-numbered", "snappy")
    most = groups.agg(F.max("n").alias("rows"), F.count(F.lit(1)).alias("groups")).first()
    if not most["groups"]:
        return spark.createDataFrame([], "doc_id long, leaf binary, other binary, subroot binary, root binary, proof binary")
    leaves = stored(placed.join(groups, F.col("part").eqNullSafe(F.col("g_part"))).select("g", F.col("place").alias("idx"), "n", "doc_id", "leaf", "other"),
                    "op12-placed", "snappy")
    edges, subroots = tree(leaves.select("g", "idx", "n", F.col("leaf").alias("data")), "op12-tree", levels)
    top_edges, top_roots = tree(subroots.select(F.lit(TOP).cast("long").alias("g"), F.col("g").alias("idx"), F.lit(most["groups"]).cast("long").alias("n"), "data"), "op12-top", levels)
    root = bytes(top_roots.first()["data"])                    # one row

    # every subroot stands at the level of the highest tree: lower trees reach it by empty segments
    high = height(most["rows"])
    depth = high + height(most["groups"])
    bits = F.when(F.col("n") < 2, 0).otherwise(F.length(F.bin(F.col("n") - 1))).cast("int")
    empty = F.lit(b"")
    idle = (groups.select("g", bits.alias("top")).where(F.col("top") < high)
            .select("g", F.explode(F.sequence("top", F.lit(high - 1))).alias("level"), F.lit(0).cast("long").alias("idx"), empty.alias("data")))
    within = edges.unionByName(idle)
    last = F.col("level") == high - 1
    links = within.select("level", "g", "idx", F.when(last, TOP).otherwise(F.col("g")).cast("long").alias("to_g"),
                          F.when(last, F.col("g")).otherwise(F.shiftright("idx", 1)).alias("to_idx"), F.col("data").alias("seg"))
    above = top_edges.select((F.col("level") + high).alias("level"), "g", "idx", F.col("g").alias("to_g"), F.shiftright("idx", 1).alias("to_idx"), F.col("data").alias("seg"))
    found = jump(links.unionByName(above), depth).select(F.col("g").alias("p_g"), F.col("idx").alias("p_idx"), "seg")
    at = (F.col("g"), F.col("idx")) if high else (F.lit(TOP).cast("long"), F.col("g"))     # without levels of their own, groups are leaves of the top
    rooted = subroots.select(F.col("g").alias("s_g"), F.col("data").alias("subroot"))
    return (leaves.join(found, (at[0] == F.col("p_g")) & (at[1] == F.col("p_idx")), "left").join(rooted, F.col("g") == F.col("s_g"))
            .select("doc_id", "leaf", "other", "subroot", F.lit(root).alias("root"), F.coalesce("seg", empty).alias("proof")))


def verified(rows: DataFrame) -> DataFrame:
    """Proofs checked: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified),
    digests as hex text. A row with ``other`` is folded from that leaf."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaves, others, roots, proofs = (batch[c].to_pylist() for c in ("leaf", "other", "root", "proof"))
            folded = [fold(leaf if other is None else other, proof) for leaf, other, proof in zip(leaves, others, proofs)]
            text = lambda digests: pa.array([d.hex() for d in digests], pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], text(leaves), text(batch["subroot"].to_pylist()), text(roots),
                 pa.array([hashlib.sha256(siblings(p).hex().encode()).hexdigest() for p in proofs], pa.string()), text(folded),
                 pa.array([f == r for f, r in zip(folded, roots)], pa.bool_())],
                ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])

    return rows.mapInArrow(check, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
