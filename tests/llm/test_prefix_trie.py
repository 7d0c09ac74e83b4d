import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import types as T

from tidemark.llm import prefix_trie as pt

SCHEMA = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
                       # names that the operator uses itself
                       *[T.StructField(c, T.StringType()) for c in ("place", "depth", "hi", "words", "ends")]])


def brute(rows):
    """The contract's nodes, from the rebuilt conversations themselves."""
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))

    def order(t):
        return t[0] is not None, t[0] or 0, hashlib.sha256(f"{len(t[1].encode())}:{t[1]}{t[2]}".encode()).hexdigest()
    turns = {c: [(r, x) for _, r, x in sorted(ts, key=order)] for c, ts in convs.items()}
    whole = {}
    for c, own in turns.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 4
        base = [] if c is None else turns.get(c - int(np.fmod(c, 20)), [])
        whole[c] = tuple(base[:h]) + tuple(own[h:])
    members, ends = {}, {}
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
        ends.setdefault(seq, []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    least = {n: min((c for c in cs if c is not None), default=None) for n, cs in members.items()}
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(members[node]) - 1) * words
    return sorted(((least[n], len(n), least[n[:-1]] if n else None, len(cs), len(children.get(n, [])), leaves[n], saved[n],
                    hashlib.sha256(",".join(str(c) for c in sorted(c for c in ends.get(n, []) if c is not None)).encode()).hexdigest()) for n, cs in members.items()), key=str)


def nodes(spark, rows, **cut):
    df = spark.createDataFrame([(*r, *"abcde") for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in pt.trie(*pt.rebuilt(pt.turns_of(df)), **cut).collect()), key=str)


def random_rows(n, seed):
    rnd = random.Random(seed)
    return [(c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["hi", "hi there", "", None, "a b c"])) for c in range(n) for t in range(rnd.randint(1, 6))]


EDGE = [(0, None, None, None), (0, 1, "user", "x y"), (0, 1, "user", "x y"), (1, 5, "user", ""), (2, 0, "", None), (25, 0, "user", "z"), (25, None, "user", "q"),
        (None, 3, "user", "x y"), (None, None, None, None), (-7, 0, "user", "neg"), (-20, 0, "user", "base"), (60, 0, "user", "long " * 100_000), (61, 0, "é", "许 可"), (2**40, 0, "user", "far")]


@pytest.mark.parametrize("rows", [EDGE, random_rows(45, 1), [(3, 0, "user", "only")], [(None, 1, "user", "n")], [(c, 0, "user", "same") for c in range(40)]],
                         ids=["edge", "random", "one", "null id", "equal"])
def test_equals_brute_force(spark, rows):
    assert nodes(spark, rows) == brute(rows)


def test_any_cut_into_bands_and_shards_gives_the_same_nodes(spark, monkeypatch):
    monkeypatch.setattr(pt, "RUN_IDS", 2)
    rows = random_rows(40, 2) + [(100, t, "user", f"w{t % 4} w") for t in range(50)] + [(120, t, "user", f"w{t % 4} w") for t in range(41)]
    assert nodes(spark, rows, shard_rows=8, band=3) == brute(rows)


def test_turnless_conversations_are_members_of_the_root(spark):
    # conversation 21 borrows from 20, which is absent, and has no turn of its own left
    quiet = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 4 > 0 and c % 20][:5]
    rows = [(c, 0, "user", "gone") for c in quiet]
    want = brute(rows)
    assert len(want) == 1 and want[0][3] == 5 and want[0][5] == 1
    assert nodes(spark, rows) == want


def test_empty_table(spark):
    assert nodes(spark, []) == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 20_000])
def test_slots_are_minimal_distinct_and_verified(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 60, n + 5))[:n]
    lo = rng.integers(0, 1 << 60, n)
    table = pt.SlotTable(keys, lo)
    assert sorted(table.slots(keys, lo).tolist()) == list(range(n))
    assert (table.slots(keys, lo ^ 1) == -1).all() and (table.slots(keys + 1, lo) == -1).all()
