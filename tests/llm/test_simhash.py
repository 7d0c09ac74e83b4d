import random
import re

import pytest
import xxhash

from tidemark.llm.components import components
from tidemark.llm.simhash import fingerprint, keep_first, lead_bits, links, simhash_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text, shingle=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    grams = [" ".join(words[k:k + shingle]) for k in range(len(words) - shingle + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("text", ["", " \n", "one", "one two three", "a b c d", "a b c d e f a b c d e", "É é\x85x\x1cy z\x0bw v", "to " * 500])
def test_fingerprint_by_definition(text):
    assert fingerprint(text, 4) == plain_fingerprint(text)


def clustered(seed, n):
    rnd, out = random.Random(seed), set()
    while len(out) < n:
        x = rnd.getrandbits(64)
        out.add(x)
        for _ in range(rnd.choice([0, 0, 1, 3, 12])):
            for b in rnd.sample(range(64), rnd.randint(0, 6)):
                x ^= 1 << b
            out.add(x)
    return [x - (1 << 64) if x >> 63 else x for x in out]


@pytest.mark.parametrize("max_bits,lead", [(0, 10), (1, 10), (2, 11), (3, 10), (4, 10), (4, 14), (5, 10)])
def test_links_keep_all_components(spark, max_bits, lead):
    fps = clustered(max_bits, 300)
    mask = (1 << 64) - 1
    edges = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if ((a ^ b) & mask).bit_count() <= max_bits]
    got = [(r["a"], r["b"]) for r in links(spark.createDataFrame([(x,) for x in fps], "fp long"), max_bits, lead).collect()]
    assert all(((a ^ b) & mask).bit_count() <= 64 for a, b in got) and roots(fps, got) == roots(fps, edges)


def test_a_large_ball_gives_few_links(spark):
    base = 0x1234_5678_9ABC_DEF0
    fps = [base ^ (1 << i) ^ (1 << j) for i in range(24) for j in range(i)]
    got = links(spark.createDataFrame([(x,) for x in fps], "fp long"), 4, 10)
    assert got.count() <= 60 * len(fps) and len(set(roots(fps, [(r["a"], r["b"]) for r in got.collect()]).values())) == 1


def test_buckets_follow_the_number_of_fingerprints():
    assert lead_bits(1000, 4) == 10 and lead_bits(30_000_000_000, 4) > 20


@pytest.mark.parametrize("seed", range(3))
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(k, k + 1) for k in range(1000, 1060)] + [(5000, k) for k in range(5001, 5100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {n for a, b in edges if a != b for n in (a, b)}
    assert got == roots(linked, edges)


def test_groups_of_edge_documents(edge_docs):
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in edge_docs.collect()]
    got = simhash_groups(edge_docs).collect()
    assert sorted((str(r["doc_id"]), r["fp"] & (1 << 64) - 1) for r in got) == sorted((str(i), f) for i, f in rows)
    fps = sorted({f for _, f in rows})
    root = roots(fps, [(a, b) for a in fps for b in fps if a < b and (a ^ b).bit_count() <= 4])
    for r in got:
        own = [i for i, f in rows if root[f] == root[r["fp"] & (1 << 64) - 1] and i is not None]
        assert r["component_id"] == min(own, default=None)


def test_one_document_of_a_group_stays(edge_docs, no_docs):
    out = keep_first(edge_docs)
    assert out.columns == edge_docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert 1 in ids and 2 not in ids and 3 in ids and 4 not in ids and 5 not in ids
    assert keep_first(no_docs).count() == 0 and simhash_groups(no_docs).count() == 0


def test_each_row_is_decided_by_itself(spark):
    near = "one two three four five six seven eight"
    other = "quite another text about ships and the sea in winter"
    rows = [(None, near), (None, near.upper()), (None, other), (1, other), (1, near + " "), (2, "a third text on its own here"), (2, other), (3, None), (3, None)]
    got = sorted(map(str, ((r["doc_id"], (r["text"] or "").lower().strip()) for r in keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect())))
    assert got == sorted(map(str, [(1, other), (1, near), (2, "a third text on its own here"), (3, "")]))
    alone = keep_first(spark.createDataFrame([(None, near), (None, near.upper()), (None, near + "\n"), (None, other)], "doc_id long, text string")).collect()
    assert sorted(r["text"].lower().strip() for r in alone) == sorted([near, other])
