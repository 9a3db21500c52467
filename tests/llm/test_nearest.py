import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import nearest


def exact(rows, k=20, step=20):
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], float)
    out = {}
    for i, q in zip(ids, vectors):
        if i % step == 0:
            scores = vectors @ q
            order = [j for j in np.lexsort((ids, -np.round(scores, 12))) if ids[j] != i][:k]
            out[int(i)] = [(int(ids[j]), scores[j]) for j in order]
    return out


def search(frame, **options):
    found = {}
    for r in nearest.nearest(frame, F.col("vec_id") % 20 == 0, **options).orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(found[r["query_id"]])
    return found


def test_recall(spark):
    frame = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    want = exact([(r["vec_id"], r["embedding"]) for r in frame.collect()])
    for options in ({}, {"shard_rows": 400}):
        got = search(frame, **options)
        assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
        hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
        assert hits >= 0.95 * 20 * len(want)


def test_lengths_ties_and_unusable(spark):
    draw = np.random.default_rng(0)
    rows = [(i, (draw.normal(size=6) * draw.uniform(0.1, 5)).tolist(), i) for i in range(200)]
    same = [20 * x for x in rows[7][1]]
    rows += [(i, same, 0) for i in range(300, 340)]
    usable = [(i, v) for i, v, _ in rows]
    rows += [(400, None, 1), (420, [0.0] * 6, 1), (440, [float("nan")] + [1.0] * 5, 1), (460, [float("inf")] + [1.0] * 5, 1), (480, [None] + [1.0] * 5, 1), (500, [1.0, 2.0], 1), (None, same, 1)]
    rows += rows[:2]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got, want = search(frame), exact(usable)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    for found in got.values():
        assert found == sorted(found, key=lambda x: (-x[1], x[0]))
    #: Forty equal vectors: a query among them finds the smallest ids but its own.
    assert [i for i, _ in got[300]] == [i for i, _ in want[300]] == [*range(301, 321)]
    small = search(frame, shard_rows=16)
    assert small.keys() == want.keys() and [i for i, _ in small[320]] == [*range(300, 320)]


def clustered(rows, dims=64, centres=160, spread=0.08):
    draw = np.random.default_rng(5)
    around = draw.normal(size=(centres, dims))
    vectors = around[draw.integers(0, centres, rows)] + spread * draw.normal(size=(rows, dims))
    return vectors / np.linalg.norm(vectors, axis=1)[:, None]


def test_the_search_stops_on_clustered_vectors():
    """Within a shard few leaves are opened and few vectors verified, and few cells are left open."""
    vectors, ids = clustered(16_384), np.arange(16_384)
    space = nearest.Space(64, 1.0)
    points = space.points(vectors)
    tree = nearest.ProjectedTree(space, ids, vectors, points)
    cells = nearest.Cells(points[::4], 32)
    place = cells.of(points)
    assert cells.count == 32 and np.bincount(place, minlength=32).min() > 200
    low, high = (np.array([f(points[place == c], axis=0) for c in range(32)]) for f in (np.min, np.max))
    hits, queries, visited = 0, range(0, 16_384, 128), []
    for i in queries:
        at = space.queries(vectors[i : i + 1])[0]
        found, scores = tree.search(vectors[i], at, 21)
        hits += len(set(found) & set(np.lexsort((ids, -(vectors @ vectors[i])))[:21]))
        visited.append((nearest.gaps(low, high, at) <= space.reach(vectors[i], scores[-1])).mean())
    assert hits >= 0.9 * 21 * len(queries)
    assert tree.verified < 0.3 * len(ids) * len(queries) and tree.opened < 0.3 * len(tree.leaves) * len(queries)
    assert np.mean(visited) < 0.3


def test_a_third_of_all_rows_share_a_vector(spark):
    vectors = clustered(3000, dims=16, centres=10).astype(np.float32)
    vectors[::3] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got, want = search(frame, shard_rows=100), exact(rows)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    assert sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * 20 * len(want)
    assert got[60] == [(i, got[60][0][1]) for i in range(0, 60, 3)]


def test_few_and_none(spark):
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert search(few) == {0: [(1, 0.5), (2, 0.0)]}
    assert search(few.limit(0)) == {} and search(few.where("vec_id = 0")) == {}


def test_chi_square():
    assert nearest.chi_square(nearest.stop_ratio(0.9)) == pytest.approx(0.9)
    draw = np.random.default_rng(0).chisquare(nearest.DIMS, 200_000)
    for p in (0.5, 0.9, 0.97):
        assert np.mean(draw <= nearest.stop_ratio(p)) == pytest.approx(p, abs=0.01)
