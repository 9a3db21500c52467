import random
import re

import xxhash

from rillmark.llm import simhash
from rillmark.llm.components import connected_components
from rillmark.llm.store import Scratch


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(prints):
    """Smallest id reachable, by comparing all pairs."""
    root = list(range(len(prints)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 3:
                root[top(i)] = top(j)
    groups = {}
    for i, (d, _) in enumerate(prints):
        groups.setdefault(top(i), []).append(d)
    return [min((d for d in groups[top(i)] if d is not None), default=None) for i in range(len(prints))]


def check(frame, **options):
    prints = [(r["doc_id"], fingerprint(r["text"])) for r in frame.collect()]
    want = sorted((str(d), f"{f:016x}", str(c)) for (d, f), c in zip(prints, components(prints)))
    got = simhash.near_duplicates(frame, **options).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_against_all_pairs(docs, odd_docs):
    check(docs)
    check(odd_docs)


def test_shards_that_are_dealt_anew(spark):
    draw = random.Random(3)
    base = [draw.getrandbits(64) for _ in range(6)]
    values = {b ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(5))}) for b in base for _ in range(60)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    frame = spark.createDataFrame(signed, "fp long")
    scratch = Scratch(spark, "test")
    want = components([(v, v & 0xFFFFFFFFFFFFFFFF) for (v,) in signed])
    for most in (2, 5, 4096):
        links = simhash.links_within(frame, scratch, shard_most=most)
        found = {r["node"]: r["root"] for r in connected_components(links, scratch).collect()}
        got = [found.get(v, v) for (v,) in signed]
        assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_tree_finds_all_within_radius():
    draw = random.Random(5)
    values = [draw.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for v in values[:40]:
        assert set(tree.within(v, 3)) == {u for u in values if (u ^ v).bit_count() <= 3}


def test_near_links_are_near_and_join_all_that_is():
    draw = random.Random(7)
    base = [draw.getrandbits(64) for _ in range(5)]
    values = [b ^ sum({1 << draw.randrange(64) for _ in range(draw.randrange(16))}) for b in base for _ in range(20)] + base
    draw.shuffle(values)
    for radius in (0, 3, 20):
        links = simhash.near_links(values, radius)
        assert all(i > j and (values[i] ^ values[j]).bit_count() <= radius for i, j in links)
        root = list(range(len(values)))
        for i, j in links:
            root = [root[j] if r == root[i] else r for r in root]
        near = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values[:i]) if (a ^ b).bit_count() <= radius}
        assert near and all(root[i] == root[j] for i, j in near) and len(links) == len(values) - len(set(root))


def test_links_in_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 200)]
    found = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "u long, v long"), Scratch(spark, "test")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160)) and found[300] == 200 and 7 in found


def test_drop_and_empty(odd_docs, no_docs):
    found = {r["component_id"] for r in simhash.near_duplicates(odd_docs).collect()}
    kept = simhash.drop_near_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, found))
    assert simhash.near_duplicates(no_docs).count() == simhash.drop_near_duplicates(no_docs).count() == 0
