"""SimHash near-duplicates found with BK-trees over shards of fingerprints.

A fingerprint is the majority of each bit over the XXH64 hashes of a text's
word shingles. Two fingerprints that differ in at most three of 64 bits agree in
one of four 16-bit blocks, so every link lies inside a shard of equal block. A
shard with more than ``SHARD_MOST`` fingerprints is dealt anew by the same rule
on its other bits, up to four times; after that 43 bits of a shard are equal and
it has 2**21 fingerprints at most. Each shard is one BK-tree: children hang on the
edge of their integer Hamming distance, and a search follows only the edges
within the radius of its own distance. The trees travel to their searches by the
deal of shards, not by a broadcast, since the number of fingerprints has no bound.

Cases: null and empty texts and texts without words have fingerprint zero and
link like any other; a text of fewer words than a shingle is one shingle; texts
of any length count in full; equal fingerprints are one tree node, so copies
never multiply; a repeated id is one id. An empty table gives an empty result.
Columns besides id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import as_bytes, slices, to_python
from .components import connected_components, join_splittable
from .store import Scratch, fresh

RADIUS, BLOCKS, SHARD_MOST, DEPTH, SEED = 3, 4, 4096, 4, 42
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Row b: the eight bits of byte b, highest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(float)


def shingle_hashes(text: bytes, words: int = 3) -> bytes:
    """XXH64 of each run of ``words`` words, eight bytes each; ASCII capitals lowered.

    ``bytes.split`` knows just the six ASCII white spaces.
    """
    parts = text.translate(LOWER).split()
    if not parts:
        return b""
    joined, digest = b" ".join(parts), xxhash.xxh64_digest
    if len(parts) <= words:
        return digest(joined, SEED)
    starts = list(accumulate(map(len, parts), lambda at, n: at + n + 1, initial=0))
    return b"".join([digest(joined[a : b - 1], SEED) for a, b in zip(starts, starts[words:])])


def majorities(hashes: list[bytes]) -> np.ndarray:
    """For each run of hashes, eight bytes each, the 64 bits that most of them set, as signed longs."""
    lengths = np.array([len(h) // 8 for h in hashes], dtype=np.int64)
    owner = np.repeat(np.arange(len(hashes)) << 8, lengths)
    octets = np.frombuffer(b"".join(hashes), np.uint8).reshape(-1, 8)
    out = np.zeros((len(hashes), 8), np.uint8)
    for k in range(8):
        counts = np.bincount(owner + octets[:, k], minlength=len(hashes) << 8).reshape(-1, 256).astype(float)
        out[:, k] = np.packbits(2 * (counts @ BITS) > lengths[:, None], axis=1)[:, 0]
    return out.view(">u8")[:, 0].astype(np.uint64).view(np.int64)


def fingerprints(texts: list[bytes], words: int = 3) -> np.ndarray:
    """64-bit fingerprints as signed longs."""
    return majorities([shingle_hashes(t, words) for t in texts])


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """``(id, fp)`` of each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(fingerprints(as_bytes(batch.column("text")), words))], names=["id", "fp"])

    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {kind}, fp long")


class BKTree:
    """Integers by Hamming distance; a child hangs on the edge of its distance to its parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.edges: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        """Insert; a value that is there already is not added again."""
        at = 0
        while self.values:
            d = (self.values[at] ^ value).bit_count()
            if d == 0:
                return
            down = self.edges[at].get(d)
            if down is None:
                self.edges[at][d] = len(self.values)
                break
            at = down
        self.values.append(value)
        self.edges.append({})

    def within(self, value: int, radius: int) -> list[int]:
        """All values at most ``radius`` from ``value``."""
        found, todo = [], [0] if self.values else []
        while todo:
            at = todo.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                found.append(self.values[at])
            edges = self.edges[at]
            if len(edges) <= 2 * radius + 1:
                todo += [child for e, child in edges.items() if -radius <= e - d <= radius]
            else:
                todo += [edges[e] for e in range(d - radius, d + radius + 1) if e in edges]
        return found


def shard_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Links that join what lies within ``radius`` of each other: to each value's root, one link a value at most."""
    tree, root = BKTree(), {}

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for v in values:
        near = tree.within(v, radius)
        tree.add(v)
        root[v] = v
        for u in near:
            root[top(u)] = top(v)
    return [(v, t) for v in values if (t := top(v)) != v]


def near_links(values: list[int], radius: int) -> list[tuple[int, int]]:
    """Places ``(later, earlier)`` of values within ``radius`` of each other that join all such places, each link such a pair itself.

    A place links to the earliest place in reach of each component it finds, so mostly to the tree's root.
    """
    tree, first, root, out = BKTree(), {}, list(range(len(values))), []

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for i, v in enumerate(values):
        for j in sorted(first[u] for u in tree.within(v, radius)):
            a, b = top(i), top(j)
            if a != b:
                root[a] = b
                out.append((i, j))
        tree.add(v)
        first.setdefault(v, i)
    return out


def shard_pairs(values: list[int], radius: int) -> list[tuple[int, int]]:
    """As ``shard_links``, by pairs that lie within ``radius`` themselves."""
    return [(values[i], values[j]) for i, j in near_links(values, radius)]


def _deal(rows: DataFrame, bits: int) -> DataFrame:
    """A row for each of four blocks of the ``bits`` bits in ``rest``: the shard gets the block, ``rest`` loses it."""
    width, options = bits // BLOCKS, []
    for k in range(BLOCKS):
        low = width * k
        size = width if k + 1 < BLOCKS else bits - low
        block = F.shiftrightunsigned("rest", low).bitwiseAND(F.lit((1 << size) - 1))
        above = F.shiftleft(F.shiftrightunsigned("rest", low + size), low) if low + size < 64 else F.lit(0).cast("long")
        options.append(F.struct(F.concat_ws(".", "shard", F.lit(str(k)), block.cast("string")).alias("shard"), above.bitwiseOR(F.col("rest").bitwiseAND(F.lit((1 << low) - 1))).alias("rest")))
    return rows.select("fp", F.explode(F.array(*options)).alias("o")).select("fp", "o.shard", "o.rest")


Links = Callable[[list[int], int], list[tuple[int, int]]]


def links_within(prints: DataFrame, scratch: Scratch, shard_most: int = SHARD_MOST, links_of: Links = shard_links) -> DataFrame:
    """``(u, v)`` over distinct ``prints(fp)`` whose components are those of all links of ``RADIUS`` bits at most."""

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, values = None, []
        for batch in batches:
            out: list[tuple[int, int]] = []
            for shard, fp in zip(batch.column("shard").to_pylist(), batch.column("fp").to_pylist()):
                if shard != name:
                    out += links_of(values, RADIUS) if len(values) > 1 else []
                    name, values = shard, []
                values.append(fp & 0xFFFFFFFFFFFFFFFF)
            yield pairs(out)
        yield pairs(links_of(values, RADIUS) if len(values) > 1 else [])

    def pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
        table = np.array(out, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(table[:, 0].copy()), pa.array(table[:, 1].copy())], names=["u", "v"])

    rows, bits, found = prints.select("fp", F.lit("").alias("shard"), F.col("fp").alias("rest")), 64, None
    for depth in range(DEPTH):
        rows = scratch.keep(f"shards{depth}", _deal(rows, bits))
        bits -= bits // BLOCKS
        sizes = rows.groupBy("shard").agg(F.count("*").alias("n"))
        several = scratch.keep(f"several{depth}", sizes.where("n > 1"))
        large = several.where(F.col("n") > shard_most).select("shard")
        last = depth + 1 == DEPTH or large.isEmpty()
        ready = join_splittable(rows, several if last else several.where(F.col("n") <= shard_most), "shard", "left_semi").select("shard", "fp")
        links = ready.repartition("shard").sortWithinPartitions("shard").mapInArrow(trees, "u long, v long")
        found = links if found is None else found.unionByName(links)
        if last:
            break
        rows = join_splittable(rows, large, "shard", "left_semi")
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3, shard_most: int = SHARD_MOST) -> DataFrame:
    """``id, fingerprint, component_id``: the smallest id reachable over links of three bits at most."""
    scratch = Scratch(docs.sparkSession, "simhash")
    prints = scratch.keep("prints", fingerprint_table(docs, id_col, text_col, words))
    classes = scratch.keep("classes", prints.groupBy("fp").agg(F.min("id").alias("first")))
    roots = scratch.keep("roots", connected_components(links_within(classes, scratch, shard_most), scratch))
    rooted = classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    rooted = scratch.keep("rooted", rooted)
    lowest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    members = scratch.keep("members", join_splittable(rooted, lowest, "root").select("fp", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return prints.join(members, "fp").select(F.col("id").alias(id_col), hexed.alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """One document of each component, the one of smallest id, with all its columns.

    Of rows that repeat an id that stays, one stays.
    """
    return keep_smallest(docs, near_duplicates(docs, id_col, text_col, words), id_col)


def keep_smallest(docs: DataFrame, found: DataFrame, id_col: str) -> DataFrame:
    """The rows of ``docs`` whose id is its component's smallest, one for each such id."""
    scratch = Scratch(docs.sparkSession, "simhash_keep")
    [keep_id] = fresh(docs, "keep_id")
    first = found.where(F.col(id_col).eqNullSafe(F.col("component_id"))).groupBy(F.col(id_col).alias(keep_id)).agg(F.count("*").alias("n"))
    keep = scratch.keep("keep", first)
    kept = docs.join(keep.select(keep_id), F.col(id_col).eqNullSafe(F.col(keep_id)), "left_semi")
    return kept if keep.where("n > 1").isEmpty() else kept.dropDuplicates([id_col])
