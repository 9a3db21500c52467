"""Connected components over links that may form hubs of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import Scratch


def join_splittable(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """An equi-join whose sides are both dealt out for it, so that Spark may split a hot key of ``left``.

    A right side that was just grouped by ``key`` would else keep its own dealing, which the skew rule leaves alone.
    """
    extra = F.xxhash64(F.col(key))
    return left.withColumn("_deal", extra).join(right.withColumn("_deal", extra), ["_deal", key], how).drop("_deal")


def _lowest(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """``(node, root)`` for every node of ``links(u, v)``; the root is the component's smallest node.

    Rounds of large-star and small-star until the links are stars. Each round
    groups with partial sums and writes its links, so no lineage grows.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = scratch.keep("links0", edges)
    seen, k = _digest(edges), 0
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = join_splittable(both, _lowest(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        large = scratch.keep(f"large{k}", large)
        star = join_splittable(large, _lowest(large), "u")
        small = star.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(star.select("u", F.col("m").alias("v"))).distinct()
        k += 1
        edges = scratch.keep(f"links{k}", small)
        now = _digest(edges)
        scratch.drop(f"links{k - 1}")
        scratch.drop(f"large{k - 1}")
        if now == seen:
            break
        seen = now
    roots = edges.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
