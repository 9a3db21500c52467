"""SimHash near copies of a wide radius: BK-trees over shards of a shared shingle, and an exact check of all that bits leave open.

Each text has the fingerprint of its set of shingles (the majority of each bit,
as in ``simhash``). Sets of similarity 0.8 were seen up to 20 of 64 bits apart, so
equal blocks of bits, which serve a radius of three, don't bring them together.
The shards here are shingles. Order all shingles in any one way that holds for
all sets: two sets of at least the wanted similarity share one of the first
``n - ceil(similarity * n) + 1`` shingles of both, their prefixes. A shard holds
the sets with one shingle in their prefix, and every similar pair meets in one.

Here rarer shingles come first, by the number of documents that hold them, counted
over all documents. Most documents have a prefix of shingles that nobody else
holds and are done. Shingles of common passages come last, so documents that only
share a passage seldom meet.

* Counting moves each shingle once, packed by buckets of hashes, eight bytes and
  its share of its set's number; a bucket holds about ``BUCKET_SHINGLES``, and
  more buckets than a task can write at once are dealt in two steps.
* Shingles that a bounded sample of documents shows to be in one document of a
  thousand or more are last in order and never counted, so no bucket gets hot.
* Each shard's fingerprints are one BK-tree, searched for all within
  ``TREE_RADIUS`` bits. Its root, the star, is the set with the smallest share of
  shingles of its own, which among copies is the original; a set links to the
  earliest set in reach of each component it finds, so a cluster of copies costs
  about a pair a member.
* The sets of shards with more than ``TREE_MOST`` fingerprints are searched by the
  trees of ``simhash``, over shards of equal blocks and three bits, and each is
  held against its shard's star, so no tree grows with a group of copies.
* What no fingerprint can exclude follows: each set is held against its star at
  any distance, and pairs of one star that still lie in different components are
  compared if what both have against the star, less what each has alone, leaves
  them a chance. So a pair that lies beyond the radius isn't lost.

Every pair proposed is decided by the exact similarity of the whole sets.

Cases: null and empty texts and texts without words are near copies of each
other; a text of fewer words than a shingle is one shingle; texts of any length
count in full; equal sets are one node, so copies never multiply; a repeated id
is one id. An empty table gives an empty result. Columns besides id and text are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .arrow import as_bytes, give_back, slices, to_python
from .components import connected_components, join_splittable
from .simhash import SEED, links_within, majorities, near_links, shard_pairs, shingle_hashes
from .store import Scratch, fresh

WORDS, SIMILARITY = 5, 0.8
#: Bits that a search reaches, and fingerprints of a shard that is one tree.
TREE_RADIUS, TREE_MOST = 20, 256
#: Documents of the sample that shows usual shingles, and in how many of them a shingle is usual.
SAMPLE_DOCS, USUAL_DOCS = 20_000, 20
#: Shingles of a bucket; buckets, as a power of two, that a task writes at once; shingles that it holds for that.
BUCKET_SHINGLES, DEAL_BITS, HELD = 2_000_000, 10, 1_000_000


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Hashes of a text's shingles, each once, ascending."""
    return np.unique(np.frombuffer(shingle_hashes(text, words), ">u8").astype(np.uint64))


def set_prints(sets: list[np.ndarray]) -> np.ndarray:
    """SimHash fingerprints of sets of shingles, as signed longs."""
    return majorities([s.astype(">u8").tobytes() for s in sets])


def node_of(shingles: np.ndarray) -> int:
    """64 bits for a set, as a signed long."""
    h = xxhash.xxh64_intdigest(shingles.tobytes(), SEED)
    return h - (1 << 64) if h >> 63 else h


def places(sorted_values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Index of each wanted value, or -1."""
    if not len(sorted_values):
        return np.full(len(wanted), -1)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return np.where(sorted_values[at] == wanted, at, -1)


def binaries(values: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The stretches of an array that begin at ``starts``, as bytes."""
    offsets = (np.append(starts, len(values)) * values.itemsize).astype(np.int32)
    return pa.BinaryArray.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def run_starts(*keys: np.ndarray) -> np.ndarray:
    """Where a run of equal keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.logical_or.reduce([np.r_[True, k[1:] != k[:-1]] for k in keys]))


def numbers(column: pa.Array | pa.ChunkedArray, kind: type) -> np.ndarray:
    """All values of a column of bytes, one after another."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def usual_shingles(docs: DataFrame, words: int, n: int, sample_docs: int = SAMPLE_DOCS) -> tuple[np.ndarray, np.ndarray]:
    """Shingles, ascending, of ``USUAL_DOCS`` or more documents of a sample, and of how many; ``docs`` has ``n`` rows."""
    share = min(1.0, sample_docs / max(1, n))
    drawn = F.pmod(F.xxhash64("id", "text", F.lit("order")), F.lit(1 << 20)) < int(share * (1 << 20) + 0.5)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            token, n = np.unique(np.concatenate([shingle_set(t, words) for t in as_bytes(batch.column("text"))]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], names=["token", "n"])

    #: At most a twentieth of the sample's shingles.
    rows = to_python(docs).where(drawn).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= USUAL_DOCS).toPandas()
    token = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(token)
    return token[order], rows["n"].to_numpy(np.int64)[order]


def print_table(docs: DataFrame, words: int, usual: np.ndarray) -> DataFrame:
    """``(id, node, n, usual, fp)`` for ``docs(id, text)``: the set, its size, how many of its shingles are usual, its fingerprint."""
    kind, known = docs.schema["id"].dataType.simpleString(), docs.sparkSession.sparkContext.broadcast(usual)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in as_bytes(batch.column("text"))]
            columns = [[node_of(s) for s in sets], [len(s) for s in sets], [int((places(known.value, s) >= 0).sum()) for s in sets]]
            columns.append(set_prints(sets))
            yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, pa.int64()) for c in columns]], names=["id", "node", "n", "usual", "fp"])

    return to_python(docs).mapInArrow(run, f"id {kind}, node long, n long, usual long, fp long")


PACKED = "bucket int, nodes binary, counts binary, tokens binary"


def packed(bucket: np.ndarray, nodes: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
    """A row for each bucket: its nodes in runs with their lengths, and the values of each place, as bytes."""
    order = np.argsort(bucket, kind="stable")
    bucket, nodes = bucket[order], nodes[order]
    first, runs = run_starts(bucket), run_starts(bucket, nodes)
    counts = np.diff(np.append(runs, len(nodes))).astype(np.int32)
    at = np.searchsorted(runs, first)
    columns = {"bucket": pa.array(bucket[first].astype(np.int32)), "nodes": binaries(nodes[runs], at), "counts": binaries(counts, at)}
    return pa.RecordBatch.from_pydict(columns | {k: binaries(v[order], first) for k, v in values.items()})


def nodes_of(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    """The node of each place of packed rows."""
    return np.repeat(numbers(rows.column("nodes"), np.int64), numbers(rows.column("counts"), np.int32))


def first_bits(values: np.ndarray, bits: int) -> np.ndarray:
    return values.view(np.uint64) >> np.uint64(64 - bits) if bits else np.zeros(len(values), np.uint64)


def held_together(parts: Iterator[tuple[np.ndarray, np.ndarray]], bits: int) -> Iterator[pa.RecordBatch]:
    """Packed rows, by the first ``bits`` bits, of several parts' shingles and nodes at once."""

    def together() -> pa.RecordBatch:
        tokens, nodes = map(np.concatenate, zip(*held))
        return packed(first_bits(tokens, bits), nodes, tokens=tokens)

    held, n = [], 0
    for part in parts:
        held.append(part)
        n += len(part[0])
        if n >= HELD:
            yield together()
            held, n = [], 0
    if n:
        yield together()


def shared_shingles(docs: DataFrame, words: int, usual: np.ndarray, total: int, scratch: Scratch) -> DataFrame:
    """``(node, shared, tokens, dfs)``: which of a node's shingles are in several documents, how many they are and in how many documents each; ``total`` shingles in all.

    Shingles meet by their own first bits, and what several documents hold goes
    on by the first bits of its nodes.
    """
    bits = max(0, int(-(-total // BUCKET_SHINGLES) - 1).bit_length())
    known = docs.sparkSession.sparkContext.broadcast(usual)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for batch in slices(batches, "text"):
                for text in as_bytes(batch.column("text")):
                    s = shingle_set(text, words)
                    rare = s[places(known.value, s) < 0]
                    yield rare, np.full(len(rare), node_of(s))

        yield from held_together(parts(), min(bits, DEAL_BITS))
        give_back()

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from held_together(((numbers(b.column("tokens"), np.uint64), nodes_of(b)) for b in batches), bits)

    def count(rows: pa.Table) -> pa.Table:
        tokens, nodes = numbers(rows.column("tokens"), np.uint64), nodes_of(rows)
        order = np.argsort(tokens)
        tokens, nodes = tokens[order], nodes[order]
        df = np.diff(np.append(run_starts(tokens), len(tokens)))
        df = np.repeat(df, df)
        tokens, nodes, df = tokens[df > 1], nodes[df > 1], df[df > 1].astype(np.int32)
        order = np.argsort(nodes.view(np.uint64), kind="stable")
        found = packed(first_bits(nodes[order], bits), nodes[order], tokens=tokens[order], dfs=df[order])
        give_back()
        return pa.Table.from_batches([found])

    def gather(rows: pa.Table) -> pa.Table:
        nodes = nodes_of(rows)
        order = np.argsort(nodes, kind="stable")
        nodes, tokens, df = nodes[order], numbers(rows.column("tokens"), np.uint64)[order], numbers(rows.column("dfs"), np.int32)[order]
        first = run_starts(nodes)
        shared = np.diff(np.append(first, len(nodes)))
        return pa.table([pa.array(nodes[first]), pa.array(shared), binaries(tokens, first), binaries(df, first)], names=["node", "shared", "tokens", "dfs"])

    rows = to_python(docs).mapInArrow(read, PACKED)
    if bits > DEAL_BITS:
        rows = rows.repartition(1 << DEAL_BITS, "bucket").mapInArrow(deal, PACKED)
    counted = scratch.keep("counted", rows.groupBy("bucket").applyInArrow(count, f"{PACKED}, dfs binary"))
    del rows
    scratch.free_shuffles()
    shared = scratch.keep("shared", counted.groupBy("bucket").applyInArrow(gather, "node long, shared long, tokens binary, dfs binary"))
    scratch.drop("counted")
    del counted
    scratch.free_shuffles()
    return shared


def prefix_length(n: Column, similarity: Fraction) -> Column:
    """How many first shingles of ``n`` a similar set must meet."""
    p, q = similarity.numerator, similarity.denominator
    return n - F.floor((n * p + (q - 1)) / q) + 1


def whole_sets(docs: DataFrame, first_ids: DataFrame, words: int) -> DataFrame:
    """``(node, fp, shingles)`` for ``first_ids(node, first, fp)``: eight bytes a shingle, ascending."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = [shingle_set(t, words) for t in as_bytes(batch.column("text"))]
            #: An id may repeat with other texts; the node tells which is meant.
            same = [(w, fp, s.tobytes()) for w, fp, s in zip(batch.column("node").to_pylist(), batch.column("fp").to_pylist(), sets) if node_of(s) == w]
            columns = [pa.array([row[i] for row in same], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "fp", "shingles"])

    texts = docs.join(first_ids, F.col("id").eqNullSafe(F.col("first"))).select("node", "fp", "text")
    return to_python(texts).mapInArrow(read, "node long, fp long, shingles binary").dropDuplicates(["node"])


def prefixes(sets: DataFrame, shared: DataFrame, usual: tuple[np.ndarray, np.ndarray], similarity: Fraction) -> DataFrame:
    """``(node, fp, n, alone, token)``: fingerprint, size, number of shingles that no other set holds, and each shingle of the prefix that another holds."""
    known = sets.sparkSession.sparkContext.broadcast(usual)
    p, q = similarity.numerator, similarity.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        usual, usual_counts = known.value
        for batch in slices(batches, "shingles"):
            out: list[tuple[int, int, int, int, np.ndarray]] = []
            for node, fp, shingles, tokens, dfs in zip(*(batch.column(c).to_pylist() for c in ("node", "fp", "shingles", "tokens", "dfs"))):
                s = np.frombuffer(shingles, np.uint64)
                tokens, at = np.unique(np.frombuffer(tokens or b"", np.uint64), return_index=True)
                df = np.frombuffer(dfs or b"", np.int32)[at]
                counted, common = places(tokens, s), places(usual, s)
                #: Alone first, then by documents; usual shingles last, by documents of the sample.
                kind = np.where(common >= 0, 2, np.where(counted >= 0, 1, 0))
                often = np.zeros(len(s), np.int64)
                often[counted >= 0], often[common >= 0] = df[counted[counted >= 0]], usual_counts[common[common >= 0]]
                order = np.lexsort((s, often, kind))[: len(s) - -(-p * len(s) // q) + 1]
                out.append((node, fp, len(s), int((kind == 0).sum()), s[order][kind[order] > 0]))
            flat = np.concatenate([np.zeros(0, np.uint64), *(o[4] for o in out)]).view(np.int64)
            columns = [np.repeat(np.array([o[i] for o in out], np.int64), [len(o[4]) for o in out]) for i in range(4)]
            yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(flat)], names=["node", "fp", "n", "alone", "token"])

    return sets.join(shared, "node", "left").select("node", "fp", "shingles", "tokens", "dfs").mapInArrow(run, "node long, fp long, n long, alone long, token long")


def shard_tree(nodes: list[int], fps: list[int], radius: int) -> list[tuple[int, int, bool]]:
    """``(u, v, starred)`` of one shard: what its tree links within ``radius``, and each set with the root, marked, at any distance."""
    near = [(nodes[i], nodes[j], False) for i, j in near_links(fps, radius) if j]
    return near + [(node, nodes[0], True) for node in nodes[1:]]


def tree_pairs(rows: DataFrame, scratch: Scratch, radius: int | None = None, most: int | None = None) -> DataFrame:
    """``(u, v, starred)`` that the BK-trees over shards propose, for ``rows(node, fp, n, alone, token)``; ``starred`` where ``v`` is a star of ``u``."""
    radius, most = TREE_RADIUS if radius is None else radius, TREE_MOST if most is None else most

    def trees(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token, nodes, fps = None, [], []
        for batch in batches:
            out: list[tuple[int, int, bool]] = []
            for t, node, fp in zip(*(batch.column(c).to_pylist() for c in ("token", "node", "fp"))):
                if t != token:
                    out += shard_tree(nodes, fps, radius)
                    token, nodes, fps = t, [], []
                nodes.append(node)
                fps.append(fp & 0xFFFFFFFFFFFFFFFF)
            yield pairs(out)
        yield pairs(shard_tree(nodes, fps, radius))

    def pairs(out: list[tuple[int, int, bool]]) -> pa.RecordBatch:
        columns = [pa.array([row[i] for row in out], kind) for i, kind in enumerate((pa.int64(), pa.int64(), pa.bool_()))]
        return pa.RecordBatch.from_arrays(columns, names=["u", "v", "starred"])

    share = (F.col("alone") / F.col("n")).alias("share")
    shards = scratch.keep("shards", rows.groupBy("token").agg(F.min(F.struct(share, "node")).alias("star"), F.count("*").alias("c")).where("c > 1").select("token", F.col("star.node").alias("star"), "c"))
    whole = join_splittable(rows, shards.where(F.col("c") <= most).select("token"), "token").select("token", share, "node", "fp")
    found = to_python(whole.repartition("token").sortWithinPartitions("token", "share", "node")).mapInArrow(trees, "u long, v long, starred boolean")
    large = shards.where(F.col("c") > most).select("token", "star")
    if not large.isEmpty():
        held = scratch.keep("held", join_splittable(rows, large, "token").select("node", "fp", "star").distinct())
        heads = scratch.keep("heads", held.groupBy("fp").agg(F.min("node").alias("head")))
        close = links_within(heads.select("fp"), scratch, links_of=shard_pairs)
        for end in ("u", "v"):
            close = join_splittable(close, heads.select(F.col("fp").alias(end), F.col("head").alias(f"{end}_head")), end)
        equal = join_splittable(held.select("node", "fp").distinct(), heads, "fp").where("node <> head")
        found = found.unionByName(held.where("node <> star").select(F.col("node").alias("u"), F.col("star").alias("v"), F.lit(True).alias("starred")))
        found = found.unionByName(close.select(F.col("u_head").alias("u"), F.col("v_head").alias("v"), F.lit(False).alias("starred")))
        found = found.unionByName(equal.select(F.col("node").alias("u"), F.col("head").alias("v"), F.lit(False).alias("starred")))
    return found.groupBy("u", "v").agg(F.bool_or("starred").alias("starred"))


def with_common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(u, v, starred, nu, nv, common)`` for ``pairs(u, v, starred)``: sizes of both sets and how many shingles they share."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "a"):
            found = []
            for a, b in zip(batch.column("a"), batch.column("b")):
                a, b = np.frombuffer(a.as_buffer(), np.uint64), np.frombuffer(b.as_buffer(), np.uint64)
                found.append((len(a), len(b), len(np.intersect1d(a, b, assume_unique=True))))
            columns = np.array(found, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), batch.column("starred"), *[pa.array(c) for c in columns]], names=["u", "v", "starred", "nu", "nv", "common"])

    left = join_splittable(pairs, sets.select(F.col("node").alias("u"), F.col("shingles").alias("a")), "u")
    both = join_splittable(left, sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")), "v")
    return both.select("u", "v", "starred", "a", "b").mapInArrow(count, "u long, v long, starred boolean, nu long, nv long, common long")


def similar(similarity: Fraction) -> Column:
    p, q = similarity.numerator, similarity.denominator
    return (p + q) * F.col("common") >= p * (F.col("nu") + F.col("nv"))


def open_pairs(members: DataFrame, similarity: Fraction) -> DataFrame:
    """Pairs of one star in different components that may yet be similar, for ``members(star, node, n, ns, alone, common, root, star_root)``.

    Against the star a set lacks ``less`` shingles and has ``more``. What two
    sets share beyond the star's share is bounded by what both lack and by what
    both have more, less what each has alone. The bound is checked for a set
    against the extremes of its star's group first, then for the pair.
    """
    p, q = similarity.numerator, similarity.denominator
    less, more = F.col("ns") - F.col("common"), F.col("n") - F.col("common")
    #: A pair needs ``need`` of either not above ``give`` of the other.
    rows = members.select("star", "node", "root", "n", less.alias("less"), more.alias("more"), F.greatest(more - F.col("alone"), F.lit(0)).alias("extra"), (F.col("root") != F.col("star_root")).alias("out"))
    delta, spare = F.col("less") + F.col("more"), F.col("n") * (q - p)
    rows = rows.withColumn("need", (p + q) * delta - spare).withColumn("give", (p + q) * (2 * (F.col("less") + F.col("extra")) - delta) + spare)
    extremes = rows.groupBy("star").agg(F.max("give").alias("most_give"), F.min(F.when(F.col("out"), F.col("need"))).alias("least_need")).where("least_need is not null")
    some = join_splittable(rows, extremes, "star")
    seekers = some.where("out and need <= most_give").drop("most_give", "least_need")
    others = some.where("give >= least_need").select("star", *[F.col(c).alias(f"o_{c}") for c in ("node", "root", "n", "less", "more", "extra", "out", "give")])
    shared = F.least("less", "o_less") + F.least("extra", "o_extra")
    may = (p + q) * (2 * shared - F.col("less") - F.col("more") - F.col("o_less") - F.col("o_more")) + (q - p) * (F.col("n") + F.col("o_n")) >= 0
    once = ~F.col("o_out") | (F.col("node") < F.col("o_node"))
    met = join_splittable(seekers, others, "star").where((F.col("root") != F.col("o_root")) & (F.col("need") <= F.col("o_give")) & once & may)
    return met.select(F.greatest("node", "o_node").alias("u"), F.least("node", "o_node").alias("v")).distinct()


def similar_links(docs: DataFrame, prints: DataFrame, usual: tuple[np.ndarray, np.ndarray], words: int, similarity: Fraction, scratch: Scratch) -> DataFrame:
    """``(u, v)`` over nodes whose components are those of all pairs similar enough, for ``docs(id, text)`` and their prints."""
    total = prints.agg(F.sum(F.col("n") - F.col("usual"))).first()[0] or 0
    shared = shared_shingles(docs, words, usual[0], total, scratch)
    sizes = prints.where("n > 0").groupBy("node").agg(F.min("id").alias("first"), F.any_value("n").alias("n"), F.any_value("usual").alias("usual"), F.any_value("fp").alias("fp"))
    alone = F.col("n") - F.col("usual") - F.coalesce("shared", F.lit(0))
    tried = scratch.keep("tried", sizes.join(shared.select("node", "shared"), "node", "left").where(alone < prefix_length(F.col("n"), similarity)).select("node", "first", "fp"))
    sets = scratch.keep("sets", whole_sets(docs, tried, words))
    scratch.free_shuffles()
    rows = scratch.keep("prefixes", prefixes(sets, shared, usual, similarity))
    scratch.drop("shared")
    scratch.free_shuffles()

    compared = scratch.keep("compared", with_common(scratch.keep("first", tree_pairs(rows, scratch)), sets))
    links = compared.where(similar(similarity)).select("u", "v")
    roots = scratch.keep("star_roots", connected_components(links, scratch))

    def placed(rows: DataFrame, node: str, root: str) -> DataFrame:
        known = roots.select(F.col("node").alias(node), F.col("root").alias(root))
        return join_splittable(rows, known, node, "left").withColumn(root, F.coalesce(root, node))

    starred = compared.where("starred")
    against = starred.select(F.col("v").alias("star"), F.col("u").alias("node"), F.col("nu").alias("n"), F.col("nv").alias("ns"), "common")
    itself = starred.select(F.col("v").alias("star"), F.col("v").alias("node"), F.col("nv").alias("n"), F.col("nv").alias("ns"), F.col("nv").alias("common")).distinct()
    members = placed(placed(against.unionByName(itself), "node", "root"), "star", "star_root")
    members = scratch.keep("members", join_splittable(members, rows.select("node", "alone").distinct(), "node"))
    known = compared.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    pairs = scratch.keep("pairs", open_pairs(members, similarity).join(known, ["u", "v"], "left_anti").withColumn("starred", F.lit(False)))
    return scratch.keep("links", links.unionByName(with_common(pairs, sets).where(similar(similarity)).select("u", "v")))


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """``id, component_id``: the smallest id reachable over pairs of at least this similarity."""
    at_least = Fraction(str(similarity))
    if not 0 < at_least <= 1:
        raise ValueError(f"similarity must lie above 0 and be 1 at most: {similarity}")
    scratch, found = Scratch(docs.sparkSession, "near_copies_work"), Scratch(docs.sparkSession, "near_copies")
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    scratch.free_shuffles()
    usual = usual_shingles(plain, words, plain.count())
    prints = scratch.keep("prints", print_table(plain, words, usual[0]))
    roots = scratch.keep("roots", connected_components(similar_links(plain, prints, usual, words, at_least, scratch), scratch))
    rooted = join_splittable(prints.select("id", "node"), roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    rooted = scratch.keep("rooted", rooted.select("id", "root"))
    lowest = rooted.groupBy("root").agg(F.min("id").alias("component_id"))
    out = found.keep("found", join_splittable(rooted, lowest, "root").select(F.col("id").alias(id_col), "component_id"))
    scratch.drop()
    return out


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each component, the one of smallest id, with all its columns.

    Of rows that repeat an id that stays, one stays.
    """
    scratch = Scratch(docs.sparkSession, "near_copies_gone")
    [gone_id] = fresh(docs, "gone_id")
    stays = F.bool_or(F.col(id_col).eqNullSafe(F.col("component_id")))
    ids = near_copies(docs, id_col, text_col, words, similarity).groupBy(F.col(id_col).alias(gone_id)).agg(stays.alias("stays"), F.count("*").alias("n"))
    ids = scratch.keep("ids", ids.where("n > 1 or not stays"))
    kept = docs.join(ids.where("not stays").select(gone_id), F.col(id_col).eqNullSafe(F.col(gone_id)), "left_anti")
    return kept if ids.where("n > 1 and stays").isEmpty() else kept.dropDuplicates([id_col])
