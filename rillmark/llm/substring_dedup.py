"""Removal of repeated 20-word passages by De Bruijn compaction.

Runs of 20 words are the edges of a De Bruijn graph over 19-word nodes. Edges
that follow each other in a text and share their minimizer (the 6-word run of
smallest hash among the 15 inside an edge) are one path from the start, about an
eighth as many rows as edges. Equal edges have equal minimizers, so

* a minimizer that occurs once in the corpus holds no repeated edge (dropped by
  the first join);
* equal paths are one kind of path. Where every occurrence of one kind is followed
  by the same other kind, and every occurrence of that preceded by the first, the
  node between does not branch: a join of path ends with path starts counts them,
  and such kinds compact into one path, over any number of nodes. Every occurrence
  of a compacted path but the first goes as a whole;
* only where paths with one minimizer differ does the graph branch inside them;
  there the first occurrence of each kind is opened into its edges again, and
  each edge looks for an earlier one among those.

Paths are proposed by two 64-bit hashes. The occurrences' own words, at their
source coordinates, are then digested with 128-bit BLAKE2 and only equal digests
count as repeats.

Cases: null and empty texts, and texts of under 20 words, lose nothing; runs
within one document count (earlier start first); rows that repeat an id are
coordinates of one document, judged alike; null ids come first. Words keep case
and marks. Whole texts of any length count. An empty table gives an empty
result. Columns besides id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrow import as_bytes, slices, to_python
from .components import join_splittable
from .store import Scratch

WINDOW, MINIMIZER = 20, 6
#: Bytes of text hashed at once; the arrays of hashes take some 40 times as much.
HASHED_BYTES = 1 << 20
#: Odd multipliers of the rolling hashes: bytes in a word, words in a minimizer, words in a path.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Hashes of any stretch of a sequence from prefix sums."""

    def __init__(self, values: np.ndarray, base: int):
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(base, len(values)), dtype=np.uint64)])
        self.undo = _powers(pow(base, -1, 1 << 64), len(values) + 1)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _mixed((self.prefix[end] - self.prefix[start]) * self.undo[start] + (end - start).astype(np.uint64))


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of all texts in order, and the number of words of each text."""
    lengths = np.array([len(t) + 1 for t in texts])
    octets = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    gap = SPACE[octets]
    start = np.flatnonzero(~gap & np.concatenate([[True], gap[:-1]]))
    end = np.flatnonzero(gap & np.concatenate([[False], ~gap[:-1]]))
    hashes = Rolling(octets.astype(np.uint64) + np.uint64(1), BASES[0]).stretch(start, end)
    first = np.searchsorted(start, np.concatenate([[0], np.cumsum(lengths)]))
    return hashes, np.diff(first)


def paths_of(texts: list[bytes], window: int = WINDOW, k: int = MINIMIZER) -> tuple[np.ndarray, ...]:
    """Compacted paths of all texts: index of the text, first word, number of edges, minimizer's hash, path's hash."""
    hashes, counts = words_of(texts)
    none = np.zeros(0, np.int64)
    if len(hashes) < window:
        return none, none, none, none, none
    small, whole = Rolling(hashes, BASES[1]), Rolling(hashes, BASES[2])
    at = np.arange(len(hashes) - k + 1)
    order = small.stretch(at, at + k)
    #: Leftmost place of the smallest hash among 1, 2, 4, 8 and at last all places of an edge.
    least, span, places = at, 1, window - k + 1
    while span < places:
        step = min(span, places - span)
        a, b = least[:-step], least[step:]
        least = np.where(order[a] <= order[b], a, b)
        span += step
    text = np.repeat(np.arange(len(texts)), counts)
    edge = np.flatnonzero(text[: len(least)] == text[window - 1 :])
    if not len(edge):
        return none, none, none, none, none
    place = least[edge]
    new = np.concatenate([[True], (place[1:] != place[:-1]) | (edge[1:] != edge[:-1] + 1)])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(edge)))
    start, place = edge[first], place[first]
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return text[start], start - offsets[text[start]], n, order[place].view(np.int64), whole.stretch(start, start + n + window - 1).view(np.int64)


def path_table(docs: DataFrame, window: int) -> DataFrame:
    """``(id, start, n, m, path)`` for ``docs(id, text)``."""
    kind = docs.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", HASHED_BYTES):
            text, start, n, m, path = paths_of(as_bytes(batch.column("text")), window)
            columns = [batch.column("id").take(pa.array(text)), pa.array(start, pa.int32()), pa.array(n, pa.int16()), pa.array(m), pa.array(path)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n", "m", "path"])

    return to_python(docs).mapInArrow(run, f"id {kind}, start int, n short, m long, path long")


def compacted(occurrences: DataFrame, docs: DataFrame) -> DataFrame:
    """``(id, start, n)`` of the compacted paths' occurrences, for ``occurrences(id, start, n, path, c)`` of kinds that occur ``c`` times."""
    #: Coordinates of an id that repeats may be of different texts, so nothing follows anything there.
    repeated = docs.groupBy(F.col("id").alias("_id")).agg(F.count("*").alias("rows")).where("rows > 1").select("_id")
    known = occurrences if repeated.isEmpty() else occurrences.join(repeated, F.col("id").eqNullSafe(F.col("_id")), "left_anti")
    before = known.select(F.col("id").alias("_id"), (F.col("start") + F.col("n")).alias("_end"), F.col("path").alias("_path"), F.col("c").alias("_c"))
    steps = known.join(before, F.col("id").eqNullSafe(F.col("_id")) & (F.col("start") == F.col("_end"))).groupBy("path", "_path", "c", "_c").agg(F.count("*").alias("k"))
    inner = steps.where("k = c and k = _c and path <> _path").select("path").withColumn("goes_on", F.lit(True))
    rows = join_splittable(occurrences, inner, "path", "left")
    along = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)
    numbered = rows.withColumn("run", F.count_if(F.col("goes_on").isNull()).over(along))
    return numbered.groupBy("id", "run").agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n")).select("id", "start", "n")


def _proved(wanted: DataFrame, kind: str, window: int) -> DataFrame:
    """Digests of the words at the coordinates in ``wanted(id, text, runs)``, of single edges instead where ``open``."""

    def digest(words: list[bytes]) -> bytes:
        return hashlib.blake2b(b" ".join(words), digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            ids, starts, ns, digests, edges = [], [], [], [], []
            for at, (text, runs) in enumerate(zip(as_bytes(batch.column("text")), batch.column("runs").to_pylist())):
                words = text.split()
                for r in runs:
                    s, n = r["start"], r["n"]
                    if s + n + window - 1 > len(words):  # a row that repeats the id with another text
                        continue
                    ids.append(at)
                    starts.append(s)
                    ns.append(n)
                    digests.append(None if r["open"] else digest(words[s : s + n + window - 1]))
                    edges.append([digest(words[i : i + window]) for i in range(s, s + n)] if r["open"] else None)
            columns = [batch.column("id").take(pa.array(ids, pa.int64())), pa.array(starts, pa.int32()), pa.array(ns, pa.int32()), pa.array(digests, pa.binary()), pa.array(edges, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "start", "n", "digest", "edges"])

    return to_python(wanted).mapInArrow(run, f"id {kind}, start int, n int, digest binary, edges array<binary>")


def _later(found: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Rows of ``found(id, start, digest, ...)`` whose digest occurs earlier; shuffle files of each pass go before the next."""
    sources = found.groupBy("digest").agg(F.min(F.struct("id", "start")).alias("source"), F.count("*").alias("c")).where("c > 1").drop("c")
    sources = scratch.keep(f"{name}_sources", sources)
    scratch.free_shuffles()
    later = scratch.keep(name, join_splittable(found, sources, "digest").where(F.struct("id", "start") > F.col("source")).drop("digest", "source"))
    del sources
    scratch.drop(f"{name}_sources")
    scratch.free_shuffles()
    return later


def repeated_spans(docs: DataFrame, scratch: Scratch, window: int = WINDOW) -> DataFrame:
    """``(id, spans)``: stretches ``[start, end)`` of words to remove, for ``docs(id, text)``; only ids that lose words."""
    kind = docs.schema["id"].dataType.simpleString()
    paths = scratch.keep("paths", path_table(docs, window))
    several = scratch.keep("several", paths.groupBy("m").agg(F.count("*").alias("c")).where("c > 1").select("m"))
    scratch.free_shuffles()
    shared = scratch.keep("shared", join_splittable(paths, several, "m", "left_semi"))
    scratch.drop("paths")
    scratch.free_shuffles()
    first = F.min(F.struct("id", "start", "n")).alias("first")
    kinds = scratch.keep("kinds", shared.groupBy("m", "path").agg(first, F.count("*").alias("c")))
    branching = kinds.groupBy("m").agg(F.count("*").alias("k")).where("k > 1").select("m")
    opened = kinds.join(branching, "m", "left_semi").select("first.id", "first.start", F.col("first.n").cast("int").alias("n"), F.lit(True).alias("open"))
    several = kinds.where("c > 1").select("path", "c")
    occurrences = scratch.keep("occurrences", join_splittable(shared, several, "path").select("id", "start", "n", "path", "c").distinct())
    scratch.drop("shared")
    scratch.free_shuffles()
    whole = compacted(occurrences, docs).withColumn("open", F.lit(False))
    runs = whole.unionByName(opened).groupBy(F.col("id").alias("_id")).agg(F.collect_list(F.struct("start", "n", "open")).alias("runs"))
    runs = scratch.keep("runs", runs)
    for name in ("several", "kinds", "occurrences"):
        scratch.drop(name)
    scratch.free_shuffles()
    wanted = docs.join(runs, F.col("id").eqNullSafe(F.col("_id"))).select("id", "text", "runs")
    proved = scratch.keep("proved", _proved(wanted, kind, window))
    del wanted
    scratch.drop("runs")
    scratch.free_shuffles()
    whole = _later(proved.where("digest is not null").select("id", "start", "digest", "n"), scratch, "whole").select("id", "start", (F.col("start") + F.col("n") + F.lit(window - 1)).alias("end"))
    edges = proved.where("edges is not null").select("id", "start", F.posexplode("edges").alias("k", "digest")).select("id", (F.col("start") + F.col("k")).alias("start"), "digest")
    single = _later(edges, scratch, "single").select("id", "start", (F.col("start") + window).alias("end"))
    spans = whole.unionByName(single)
    found = scratch.keep("spans", spans.groupBy("id").agg(F.collect_set(F.struct("start", "end")).alias("spans")))
    for name in ("proved", "whole", "single"):
        scratch.drop(name)
    return found


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, texts: bool = False) -> DataFrame:
    """``id, n_words, n_removed, kept_sha256`` per row; with ``texts`` also ``kept``, the kept words joined by one space."""
    scratch = Scratch(docs.sparkSession, "substring_dedup")
    kind = docs.schema[id_col].dataType.simpleString()
    plain = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    spans = repeated_spans(plain, scratch, window).withColumnRenamed("id", "_id")
    scratch.free_shuffles()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            before, removed, kept = [], [], []
            for text, cuts in zip(as_bytes(batch.column("text")), batch.column("spans").to_pylist()):
                words = text.split()
                before.append(len(words))
                out, at = [], 0
                for start, end in sorted((c["start"], c["end"]) for c in cuts or ()):
                    if start > at:
                        out += words[at:start]
                    at = max(at, end)
                out += words[at:]
                removed.append(len(words) - len(out))
                kept.append(b" ".join(out))
            columns = {"id": batch.column("id"), "n_words": pa.array(before, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
            if texts:
                columns["kept"] = pa.array(kept, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    cut = plain.join(spans, F.col("id").eqNullSafe(F.col("_id")), "left").select("id", "text", "spans")
    return to_python(cut).mapInArrow(run, f"id {kind}, n_words long, n_removed long, kept_sha256 string" + ", kept string" * texts).withColumnRenamed("id", id_col)
