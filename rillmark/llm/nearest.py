"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stopping test.

Vectors are projected to ``DIMS`` dimensions with a seeded Gaussian matrix. For
two vectors at distance d, the squared distance of their projections over d
squared follows a chi-square law with ``DIMS`` degrees of freedom. A kd-tree over
the projections yields its leaves in the order of their distance from a query's
projection. Vectors in them are verified on the original vectors, and the search
stops when a vector as near as the worst of the best found so far would have
turned up by now with probability ``SURE``.

The largest inner product becomes the smallest distance by one more component,
which gives all vectors the same length.

The tree has two levels. Its top, cells of about ``SHARD_ROWS`` vectors, is split
on a sample of about ``SAMPLE_ROWS`` projections; every vector is then put into
its cell, and a cell that holds more is dealt into several shards by a hash of
the id. A task builds the lower tree of a shard once and streams queries through
it. Queries first search their own cell; the distances found there tell which
other cells the stopping test still leaves open, and only those are visited.

Equal vectors are one class. Of a class only the ``k + 1`` smallest ids can be
among a query's best, so only those are indexed, and a class is searched once
for all its queries: a vector that a third of all rows share costs as much as
any other.

Cases: vectors that are null, zero, or hold null or non-finite components take
no part, neither do those whose length is not the most frequent one; equal
scores go to the smaller id; rows that repeat an id are one vector, the least of
theirs; with fewer than ``k`` candidates all are returned;
an empty table gives an empty result. Columns besides id and vector are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .components import join_splittable
from .store import Scratch

DIMS, LEAF, SURE, SEED = 16, 64, 0.87, 7
SHARD_ROWS, SHARD_BYTES, CELLS_MOST, SAMPLE_ROWS, ROUTED_ROWS = 16_384, 32 << 20, 4_096, 65_536, 64


def chi_square(x: np.ndarray | float, dims: int = DIMS) -> np.ndarray:
    """Distribution function of the chi-square law with an even number of degrees of freedom."""
    half = np.asarray(x, float) / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, dims // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def stop_ratio(sure: float = SURE, dims: int = DIMS) -> float:
    """The ratio of squared distances beyond which the test holds."""
    low, high = 0.0, 1e3
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, dims) < sure else (low, middle)
    return high


class Space:
    """The projection, and the distance within which the stopping test leaves a search open."""

    def __init__(self, length: int, square: float):
        self.square, self.ratio = square, stop_ratio()
        self.matrix = np.random.default_rng(SEED).standard_normal((length + 1, DIMS))

    def points(self, vectors: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.square - np.einsum("ij,ij->i", vectors, vectors), 0))
        return vectors @ self.matrix[:-1] + rest[:, None] * self.matrix[-1]

    def queries(self, vectors: np.ndarray) -> np.ndarray:
        return vectors @ self.matrix[:-1]

    def reach(self, query: np.ndarray, worst: np.ndarray | float) -> np.ndarray | float:
        """Squared projected distance beyond which nothing better than the score ``worst`` is likely; its floor keeps copies in reach of rounding."""
        return self.ratio * np.maximum((query * query).sum(axis=-1) + self.square - 2 * worst, 1e-6 * self.square)


def gaps(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Squared distance of a point from each box."""
    gap = np.maximum(np.maximum(low - at, at - high), 0)
    return np.einsum("ij,ij->i", gap, gap)


class Cells:
    """The top of the tree: a split by one dimension a node, children after their parents; a node without is a cell."""

    def __init__(self, sample: np.ndarray, cells: int):
        #: Dimension of each split, or -1; its value; the first child, or the cell's number.
        along, value, below = [], [], []
        nodes, self.count, parts = [np.arange(len(sample))], 0, 1
        for rows in nodes:  # grows; by breadth, so that cells stay alike in size
            axis = int(np.ptp(sample[rows], axis=0).argmax()) if parts < cells and len(rows) > 1 else 0
            values = sample[rows, axis]
            cut = np.median(values) if parts < cells and len(rows) > 1 else np.inf
            if not (values < cut).any():
                cut = values[values > cut].min(initial=np.inf)
            if np.isfinite(cut):
                along.append(axis)
                value.append(float(cut))
                below.append(len(nodes))
                nodes += [rows[values < cut], rows[values >= cut]]
                parts += 1
            else:
                along.append(-1)
                value.append(0.0)
                below.append(self.count)
                self.count += 1
        self.along, self.value, self.below = np.array(along), np.array(value), np.array(below)

    def of(self, points: np.ndarray) -> np.ndarray:
        """The cell of each point."""
        node = np.zeros(len(points), np.int64)
        while (open_ := np.flatnonzero(self.along[node] >= 0)).size:
            here = node[open_]
            node[open_] = self.below[here] + (points[open_, self.along[here]] >= self.value[here])
        return self.below[node]


class ProjectedTree:
    """A shard's vectors with a kd-tree over their projections."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray, points: np.ndarray):
        self.space, self.verified, self.opened = space, 0, 0
        todo, leaves = [np.arange(len(ids))], []
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                leaves.append(rows)
                continue
            along = int(np.ptp(points[rows], axis=0).argmax())
            half = len(rows) // 2
            order = np.argpartition(points[rows, along], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        order, ends = np.concatenate(leaves), np.cumsum([len(r) for r in leaves])
        self.ids, self.vectors, self.points = ids[order], vectors[order], points[order]
        self.leaves = [np.arange(e - len(r), e) for e, r in zip(ends, leaves)]
        self.low, self.high = (np.array([f(self.points[r], axis=0) for r in self.leaves]) for f in (np.min, np.max))

    def search(self, query: np.ndarray, at: np.ndarray, k: int, worst: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the best ``k`` found, best first; ``worst`` is the least score that the query still needs."""
        bound = gaps(self.low, self.high, at)
        order = np.argsort(bound, kind="stable")
        bound = bound[order]
        ids, scores, reach = np.zeros(0, np.int64), np.zeros(0), self.space.reach(query, worst)
        first, step = 0, 2
        while first < len(order) and bound[first] <= reach:
            last = min(first + step, int(np.searchsorted(bound, reach, side="right")))
            rows = np.concatenate([self.leaves[leaf] for leaf in order[first:last]])
            if np.isfinite(reach):
                off = self.points[rows] - at
                rows = rows[np.einsum("ij,ij->i", off, off) <= reach]
            self.verified, self.opened = self.verified + len(rows), self.opened + last - first
            ids = np.concatenate([ids, self.ids[rows]])
            scores = np.concatenate([scores, np.einsum("ij,j->i", self.vectors[rows], query)])
            best = np.lexsort((ids, -scores))[:k]
            ids, scores = ids[best], scores[best]
            if len(ids) == k:
                reach = self.space.reach(query, max(worst, scores[-1]))
            first, step = last, min(2 * step, 64)
        return ids, scores


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def projected(rows: DataFrame, space: Space, queries: bool) -> DataFrame:
    """``rows(id, vector)`` with their projections."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _matrix(batch.column("vector"))
            points = space.queries(vectors) if queries else space.points(vectors)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(points) + 1, dtype=np.int32) * DIMS), pa.array(points.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("vector"), lists], names=["id", "vector", "p"])

    return rows.mapInArrow(run, f"id long, vector {rows.schema['vector'].dataType.simpleString()}, p array<double>")


def with_cell(rows: DataFrame, cells: Cells) -> DataFrame:
    """``rows(id, vector, p)`` with the cell of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells.of(_matrix(batch.column("p"))).astype(np.int32))], names=[*batch.schema.names, "cell"])

    return rows.mapInArrow(run, f"id long, vector {rows.schema['vector'].dataType.simpleString()}, p array<double>, cell int")


def search_shards(points: DataFrame, queries: DataFrame, space: Space, k: int) -> DataFrame:
    """``(query, vec_id, score)``: the best of each shard for the queries sent to it, ``(shard, id, vector, p)`` and for queries ``worst``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, held, tree = None, [], None
        for batch in batches:
            marks = batch.column("shard").to_numpy().astype(np.int64) * 2 + batch.column("asks").to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.r_[True, marks[1:] != marks[:-1]]) if len(marks) else []
            out: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
            for start, end in zip(starts, [*starts[1:], len(marks)]):
                if marks[start] // 2 != shard:
                    shard, held, tree = marks[start] // 2, [], None
                part = batch.slice(start, end - start)
                ids, vectors, at = part.column("id").to_numpy(), _matrix(part.column("vector")), _matrix(part.column("p"))
                if not marks[start] % 2:
                    held.append((ids, vectors, at))
                    continue
                if tree is None and held:
                    tree, held = ProjectedTree(space, *map(np.concatenate, zip(*held))), []
                for i, q, p, worst in zip(ids, vectors, at, part.column("worst").to_numpy()) if tree else ():
                    found, scores = tree.search(q, p, k, worst)
                    out.append((np.full(len(found), i), found, scores))
            columns = [np.concatenate(c) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["query", "vec_id", "score"])

    both = points.select("shard", F.lit(False).alias("asks"), "id", "vector", "p", F.lit(0.0).alias("worst")).unionByName(queries.select("shard", F.lit(True).alias("asks"), "id", "vector", "p", "worst"))
    return both.repartition("shard").sortWithinPartitions("shard", "asks").mapInArrow(run, "query long, vec_id long, score double")


def nearest(table: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score`` for the rows where ``is_query`` holds, against all rows but the query's own."""
    spark, scratch = table.sparkSession, Scratch(table.sparkSession, "nearest")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"), is_query.alias("asks")).where(usable(F.col("vector")) & F.col("id").isNotNull())
    size = F.size("vector")
    square = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    lengths = rows.groupBy(size.alias("length")).agg(F.count("*").alias("n"), F.max(square).alias("square")).orderBy(F.col("n").desc(), "length").first()
    if lengths is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    space = Space(lengths["length"], lengths["square"])
    rows = scratch.keep("rows", rows.where(size == lengths["length"]).groupBy("id").agg(F.min("vector").alias("vector"), F.bool_or("asks").alias("asks")))
    of_class = Window.partitionBy("vector").orderBy("id")
    firsts = rows.withColumn("place", F.row_number().over(of_class)).where(F.col("place") <= k + 1).select("id", "vector")
    points = scratch.keep("points", projected(firsts, space, False))
    asked = scratch.keep("asked", projected(rows.where("asks").groupBy("vector").agg(F.min("id").alias("id")), space, True))

    n = points.count()
    drawn = F.pmod(F.xxhash64("id", F.lit("cells")), F.lit(1 << 20)) < int(min(1.0, SAMPLE_ROWS / max(1, n)) * (1 << 20) + 0.5)
    sample = np.array([r["p"] for r in points.where(drawn).select("p").collect()]).reshape(-1, DIMS)
    shard_rows = max(1, min(shard_rows, SHARD_BYTES // (8 * lengths["length"])))
    cells = Cells(sample, min(CELLS_MOST, -(-n // shard_rows)))
    placed = with_cell(points, cells)
    edges = [f(F.col("p")[i]).alias(f"{name}{i}") for name, f in (("low", F.min), ("high", F.max)) for i in range(DIMS)]
    boxes = sorted(placed.groupBy("cell").agg(F.count("*").alias("n"), *edges).collect(), key=lambda r: r["cell"])
    number = np.array([r["cell"] for r in boxes])
    low, high = (np.array([[r[f"{name}{i}"] for i in range(DIMS)] for r in boxes]) for name in ("low", "high"))
    shards, first = np.zeros(cells.count, np.int64), np.zeros(cells.count + 1, np.int64)
    shards[number] = [-(-r["n"] // shard_rows) for r in boxes]
    first[1:] = np.cumsum(shards)
    #: A row for each cell, ``CELLS_MOST`` at most.
    places = spark.createDataFrame([(c, int(first[c]), int(shards[c])) for c in range(cells.count)], "cell int, first int, shards int")
    dealt = placed.join(F.broadcast(places), "cell").withColumn("shard", F.col("first") + F.pmod(F.xxhash64("id"), F.col("shards")).cast("int"))

    home = with_cell(asked, cells).join(F.broadcast(places), "cell").where("shards > 0")
    home = home.withColumn("shard", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("shards") - 1))).withColumn("worst", F.lit(float("-inf")))
    near = scratch.keep("near", search_shards(dealt, home, space, k + 1))
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    best = near.withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k + 1)
    known = best.groupBy("query").agg(F.min("score").alias("score"), F.count("*").alias("n"))
    worst = F.when(F.col("n") > k, F.col("score")).otherwise(float("-inf"))
    started = asked.join(known.select(F.col("query").alias("id"), worst.alias("worst")), "id", "left").withColumn("worst", F.coalesce("worst", F.lit(float("-inf"))))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, ROUTED_ROWS) for b in batches for i in range(0, len(b), ROUTED_ROWS)):
            vectors, at = _matrix(batch.column("vector")), _matrix(batch.column("p"))
            reach, own = space.reach(vectors, batch.column("worst").to_numpy()), cells.of(at)
            open_ = [number[gaps(low, high, p) <= r] for p, r in zip(at, reach)]
            targets = [np.concatenate([np.zeros(0, np.int64), *(np.arange(first[c], first[c + 1]) for c in found if c != o)]) for found, o in zip(open_, own)]
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, targets)]), pa.int32()), pa.array(np.concatenate(targets).astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "shards"])

    kind = asked.schema["vector"].dataType.simpleString()
    routed = started.select("id", "vector", "p", "worst").mapInArrow(route, f"id long, vector {kind}, p array<double>, worst double, shards array<int>")
    far = search_shards(dealt, routed.withColumn("shard", F.explode("shards")), space, k + 1)
    found = near.unionByName(far).withColumn("place", F.row_number().over(ranked)).where(F.col("place") <= k + 1)
    lists = found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("place", "vec_id", "score"))).alias("best"))
    classes = asked.select(F.col("id").alias("query"), "vector").join(lists, "query").select("vector", "best")
    asking = join_splittable(rows.where("asks").select(F.col("id").alias("query_id"), "vector"), classes, "vector")
    others = F.slice(F.filter("best", lambda x: x.getField("vec_id") != F.col("query_id")), 1, k)
    out = asking.select("query_id", F.posexplode(others).alias("at", "b"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), F.col("b.score").alias("score"))
