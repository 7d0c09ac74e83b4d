import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import merkle
from tidemark.llm.ranks import ranked

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("n_chars", T.LongType()), T.StructField("text", T.StringType()),
                       # names that the operator uses itself
                       *[T.StructField(c, T.StringType()) for c in ("g", "idx", "leaf", "part", "place", "seg")]])


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(doc_id, source, lang, n_chars, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree_of(nodes):
    """Levels of digests from the leaves to the root."""
    levels = [nodes]
    while len(nodes) > 1:
        nodes = [h("".join(nodes[k:k + 2])) for k in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def path_of(levels, k):
    """(place in its run, the run's other digests) of every level but the root."""
    out = []
    for level in levels[:-1]:
        run = level[k & ~1:(k & ~1) + 2]
        out.append((k & 1, [d for j, d in enumerate(run) if j != k & 1]))
        k >>= 1
    return out


def brute(rows):
    """The contract's rows, one at a time."""
    order = lambda v: (v is not None, 0 if v is None else v)
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    langs = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    for lang in langs:
        groups[lang].sort(key=lambda r: (order(r[0]), leaf_of(*r)))
    trees = [tree_of([leaf_of(*r) for r in groups[lang]]) for lang in langs]
    top = tree_of([t[-1][0] for t in trees])
    out = []
    for g, lang in enumerate(langs):
        for k, r in enumerate(groups[lang]):
            path = path_of(trees[g], k) + path_of(top, g)
            changed = r
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                changed = (*r[:3], r[3] + 1, r[4])
            node = leaf_of(*changed)
            for place, others in path:
                node = h("".join(others[:place] + [node] + others[place:]))
            out.append((r[0], leaf_of(*r), trees[g][-1][0], top[-1][0], h("".join(d for _, others in path for d in others)), node, node == top[-1][0]))
    return sorted(out, key=str)


def found(spark, rows, **how):
    def tampered(fields):
        return {**fields, "n_chars": F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, fields["n_chars"].cast("decimal(20,0)") + 1).otherwise(fields["n_chars"])}
    df = spark.createDataFrame([(*r, *"abcdef") for r in rows], SCHEMA).repartition(5)
    return sorted((tuple(r) for r in merkle.verified(merkle.manifest(df, tampered, **how)).collect()), key=str)


def rows_of(n, langs, seed):
    rnd = random.Random(seed)
    return [(k, rnd.choice(["a", None]), rnd.choice(langs), rnd.choice([None, 5, k]), rnd.choice(["", None, f"text é {k}", "same"])) for k in range(n)]


EDGE = [(1, None, None, None, None), (1, None, None, None, None), (None, "s", "en", 3, ""), (None, "s", "en", 3, "x"), (-7, "ü", "", 2**63 - 1, "l" * 300_000),
        (2, "s", "é", 0, "a"), (3, "s", "z", 1, "a"), (3, "s", "z", 1, "b"), (12, "s", "z", 1, "a")]


@pytest.mark.parametrize("rows", [
    [(5, "s", "en", 4, "text")], [(5, "s", "en", 4, "a"), (6, "s", "en", 4, "b")], [(k, "s", f"l{k}", 4, "a") for k in range(5)], EDGE,
    rows_of(40, ["en"], 1), rows_of(77, ["en", "de", None, "fr"], 2)], ids=["one", "two", "lone leaves", "edge", "one group", "groups"])
def test_equals_brute_force(spark, rows):
    assert found(spark, rows) == brute(rows)


def test_blocks_of_more_than_one_round(spark):
    rows = rows_of(150, ["en"] * 8 + ["de", "xx"], 3)
    assert found(spark, rows, levels=2) == brute(rows)


def test_tampering_is_found_and_only_that(spark):
    rows = [(k, "s", "en", 9, "t") for k in range(60)]
    got = {r[0]: r[-1] for r in found(spark, rows)}
    assert {k for k, ok in got.items() if not ok} == {k for k in range(60) if zlib.crc32(str(k).encode()) % 7 == 0}


def test_empty_table(spark):
    none = merkle.manifest(spark.createDataFrame([], SCHEMA))
    assert merkle.verified(none).count() == 0


def test_ranks_split_a_hot_group_and_copies(spark):
    spark.conf.set("spark.sql.shuffle.partitions", 8)
    rows = [("hot", 1)] * 300 + [("hot", k) for k in range(300)] + [(None, 5), ("b", None), ("b", 2)]
    df = spark.createDataFrame(rows, "grp string, at int").repartition(4)
    got = ranked(df, "grp", ["at"], "test-ranks").withColumn("task", F.col("place")).collect()
    for name in ("hot", None, "b"):
        own = sorted((r["place"], (r["at"] is not None, r["at"] or 0)) for r in got if r["grp"] == name)
        assert [p for p, _ in own] == list(range(len(own))) and [a for _, a in own] == sorted(a for _, a in own)
        assert {r["group_rows"] for r in got if r["grp"] == name} == {len(own)}
