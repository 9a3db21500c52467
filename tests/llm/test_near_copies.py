import random
import re

import numpy as np
import xxhash

import corpus_pipeline
from rillmark.llm import near_copies
from rillmark.llm.store import Scratch


def shingles(text, words=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    parts = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))} if parts else set()


def components(rows):
    """Smallest id reachable, by comparing all pairs."""
    sets, root = [shingles(t) for _, t in rows], list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                root[top(i)] = top(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(top(i), []).append(d)
    return [min((d for d in groups[top(i)] if d is not None), default=None) for i in range(len(rows))]


def check(frame):
    rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
    want = components(rows)
    got = near_copies.near_copies(frame).collect()
    assert sorted((str(r["doc_id"]), str(r["component_id"])) for r in got) == sorted((str(d), str(c)) for (d, _), c in zip(rows, want))
    return want


def test_against_all_pairs(docs, odd_docs):
    assert len(set(check(docs))) < docs.select("text").distinct().count()
    check(odd_docs)


def test_chains_clusters_and_the_edge(spark):
    draw = random.Random(4)
    texts = []
    for _ in range(8):
        base = [f"w{draw.randrange(5000)}" for _ in range(draw.randrange(6, 120))]
        for _ in range(12):
            base = list(base)
            for _ in range(draw.randrange(3)):
                base[draw.randrange(len(base))] = f"x{draw.randrange(5000)}"
            texts.append(" ".join(base))
    edge = [f"e{i}" for i in range(13)]  # 9 shingles; less one word at the end 8, of 10 with another
    texts += [" ".join(edge), " ".join(edge[:-1]), " ".join(edge[:-1] + ["other"])]
    head = " ".join(f"h{i}" for i in range(30))  # a passage that many unlike documents share
    texts += [f"{head} " + " ".join(f"t{k}_{i}" for i in range(10)) for k in range(40)]
    draw.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert 40 < len(set(check(frame))) < len(texts)


def test_a_cluster_around_the_edge_in_many_buckets(spark, monkeypatch):
    """Copies of one text on both sides of 0.8, copies of copies, and texts made of common passages alone."""
    draw = random.Random(8)
    base = [f"b{i}" for i in range(60)]
    texts = [" ".join(base)]
    for i in range(150):
        copy = (texts[draw.randrange(len(texts))].split() if i % 5 == 0 else list(base))[:]
        for _ in range(draw.randrange(1, 5)):
            at = draw.randrange(len(copy))
            copy[at : at + 1] = [[f"c{draw.randrange(30)}"], [], [copy[at], f"d{draw.randrange(9)}"]][draw.randrange(3)]
        texts.append(" ".join(copy))
    passages = [" ".join(f"p{k}_{i}" for i in range(12)) for k in range(12)]
    texts += [" ".join(draw.sample(passages, 4)) for _ in range(120)]
    draw.shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    want = check(frame)
    assert 20 < len(set(want)) < 250
    for name, value in (("BUCKET_SHINGLES", 100), ("DEAL_BITS", 3), ("USUAL_DOCS", 12)):
        monkeypatch.setattr(near_copies, name, value)
    check(frame)


def majority(text):
    """The fingerprint of a text's set of five-word shingles, bit by bit."""
    h = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles(text)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_stage_takes_its_pairs_from_trees_of_fingerprints(spark, docs, small, monkeypatch):
    proposed, plain = [], near_copies.tree_pairs

    def recorded(rows, scratch):
        fps = {r["node"]: r["fp"] & (1 << 64) - 1 for r in rows.select("node", "fp").distinct().collect()}
        proposed.append((fps, {(r["u"], r["v"]) for r in plain(rows, scratch).collect()}))
        return plain(rows, scratch)

    monkeypatch.setattr(near_copies, "tree_pairs", recorded)
    corpus_pipeline.dedup_near(spark, docs, small)
    [(fps, pairs)] = proposed
    texts = {near_copies.node_of(near_copies.shingle_set((r["text"] or "").encode(), 5)): r["text"] for r in docs.collect()}
    assert fps and all(fps[node] == majority(texts[node]) for node in fps)
    sets = {node: shingles(texts[node]) for node in fps}
    similar = {(u, v) for u in sets for v in sets if u < v and 5 * len(sets[u] & sets[v]) >= 4 * len(sets[u] | sets[v])}
    assert similar and all((u, v) in pairs or (v, u) in pairs for u, v in similar)
    assert max((fps[u] ^ fps[v]).bit_count() for u, v in similar) > 3  # out of reach of three bits


def test_trees_of_any_radius_and_size_lose_nothing(spark, monkeypatch):
    draw = random.Random(12)
    base = [f"b{i}" for i in range(40)]
    texts = [" ".join(base)]
    for i in range(60):
        copy = (texts[draw.randrange(len(texts))].split() if i % 4 == 0 else list(base))[:]
        for _ in range(draw.randrange(1, 4)):
            copy[draw.randrange(len(copy))] = f"c{draw.randrange(20)}"
        texts.append(" ".join(copy))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for radius, most in ((0, 256), (20, 4)):
        monkeypatch.setattr(near_copies, "TREE_RADIUS", radius)
        monkeypatch.setattr(near_copies, "TREE_MOST", most)
        assert 1 < len(set(check(frame))) < len(set(texts))


def test_proposals_of_whole_and_large_shards(spark):
    """Shard 1 is one tree; shard 2 is over the bound: trees over blocks of bits and each set with the star."""
    star = 0x0123456789ABCDEF
    fps = {1: star, 2: star ^ 0xFF, 3: ~star & (1 << 63) - 1, 4: ~star & (1 << 63) - 1 ^ 0x3F, 5: star ^ 0b111, 6: star, 7: star ^ 0xF}
    rows = [(node, fps[node], 10, node - 1, 1) for node in (1, 2, 3, 4)] + [(node, fps[node], 10, node - 1, 2) for node in (1, 3, 5, 6, 7)]
    rows += [(3, fps[3], 10, 2, 3)]  # alone in its shard
    frame = spark.createDataFrame(rows, "node long, fp long, n long, alone long, token long")
    found = {(r["u"], r["v"]): r["starred"] for r in near_copies.tree_pairs(frame, Scratch(spark, "test"), 20, 4).collect()}
    assert {(2, 1), (3, 1), (4, 1), (5, 1), (6, 1), (7, 1)} == {p for p, starred in found.items() if starred}
    assert (4, 3) in found and any({7, 5} == {*p} for p in found)  # far from the star; four bits from it


def test_packing_keeps_each_shingle_and_its_node():
    draw = np.random.default_rng(1)
    tokens, nodes = draw.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2), np.sort(draw.integers(-9, 9, 500))
    for bits in (0, 1, 6):
        rows = near_copies.packed(near_copies.first_bits(tokens, bits), nodes, tokens=tokens)
        found = near_copies.numbers(rows.column("tokens"), np.uint64)
        assert sorted(zip(found, near_copies.nodes_of(rows))) == sorted(zip(tokens, nodes)) and len(rows) <= 1 << bits
        assert rows.column("bucket").to_pylist() == sorted(set(near_copies.first_bits(tokens, bits).tolist()))
    assert len(near_copies.packed(tokens[:0], nodes[:0], tokens=tokens[:0])) == 0


def test_stage_drops_copies_far_apart_in_bits(spark, docs, small):
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.dedup_near(spark, docs, small).collect()}
    assert {1, 6} <= kept and not {145, 177} & kept
    assert kept == set(components(sorted(rows.items())))


def test_drop_and_empty(odd_docs, no_docs):
    found = {r["component_id"] for r in near_copies.near_copies(odd_docs).collect()}
    kept = near_copies.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, found))
    assert near_copies.near_copies(no_docs).count() == near_copies.drop_near_copies(no_docs).count() == 0
