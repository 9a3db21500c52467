"""Language identification with bit-sliced Bloom filters of n-grams.

One table of slots serves all languages: each slot holds one bit per language.
An n-gram's slots, combined with AND, are the bitmask of all languages that
contain it (or seem to). A text's bits are counted per language, the share that
false positives alone would give is taken off, the rest is set against what a
text of that language reaches, and the largest wins.

An n-gram belongs to a language if it comes twice there and its frequency is at
least a third of its largest frequency in any language, so words of another
language quoted in a text don't count. The filters are fitted on about
``FIT_ROWS`` labelled rows of each language, drawn by a hash of id and text, and hold
all n-grams of those that belong. Tasks set the bits of the filters in blocks of
slots; the driver only joins the blocks, ``TABLE_BYTES`` in all at most, whatever
the number of n-grams; what a fuller table confuses, the false-positive rates
take off again.

Cases: a text that is null or has no letter is ``und`` with score 0; a text
without any known n-gram gets the most frequent learned language with score 0;
ties go to the first language in code point order; without labelled rows every
text is ``und``; more than ``LANGS_MOST`` values of lang are no languages and an
error. Rows that repeat are judged alike and teach once. Whole texts of any length count. Columns besides id, text and lang are not read, and lang only of rows
that teach. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow import slices, to_python
from .store import Scratch

SIZES, FIT_ROWS, LANGS_MOST, HASHES = (3, 4), 5_000, 1_024, 2
#: Slots for each n-gram of the largest language, and bounds of the table.
ROOM, LEAST_BITS, BLOCK_BITS, TABLE_BYTES = 10, 16, 12, 64 << 20
#: Bytes of text at once: every character becomes n-grams of 8 bytes, several times over.
SLICE_BYTES = 1 << 19
BASE = np.uint64(0x9E3779B97F4A7C15)
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)
_letters: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Which code points are letters."""
    if not _letters:
        _letters.append(np.array([chr(c).isalpha() for c in range(0x110000)]))
    return _letters[0]


def grams(texts: list[str], sizes: tuple[int, ...] = SIZES) -> tuple[list[np.ndarray], list[np.ndarray], np.ndarray]:
    """For each size the hashes of all n-grams and their texts' indices; and whether each text has a letter.

    Lower case; every run of other characters is one space, and so are a text's ends.
    """
    low = [t.lower() for t in texts]
    points = np.frombuffer((" " + " ".join(low) + " ").encode("utf-32-le", "replace"), np.uint32)
    owner = np.repeat(np.arange(len(texts)), [len(t) + 1 for t in low])
    owner = np.concatenate([owner[:1], owner])
    letter = letters()[points]
    has = np.zeros(len(texts), bool)
    has[owner[letter]] = True
    kept = letter | np.concatenate([[True], letter[:-1]])
    points = np.where(letter, points, np.uint32(32))[kept].astype(np.uint64)
    owner = owner[kept]
    hashes, owners = [], []
    for n in sizes:
        h = np.full(max(len(points) - n + 1, 0), n, np.uint64)
        for k in range(n):
            h = (h ^ points[k : k + len(h)]) * BASE
            h ^= h >> np.uint64(29)
        #: The first may be the space before a text, which belongs to the one before; the others must be of one text.
        mine = owner[1 : 1 + len(h)]
        inside = mine == owner[n - 1 : n - 1 + len(h)]
        hashes.append(h[inside])
        owners.append(mine[inside])
    return hashes, owners, has


def slots_of(hashes: np.ndarray, k: int, bits: int) -> np.ndarray:
    """The ``k``-th slot of each n-gram among ``2**bits``."""
    mixed = (hashes ^ np.uint64(k * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class Filters:
    """Languages in order, slots by group of eight languages, false-positive rate and usual share of each language."""

    langs: list[str]
    table: np.ndarray
    false: np.ndarray
    usual: np.ndarray
    most: int

    @classmethod
    def of(cls, langs: list[str], table: np.ndarray, usual: list[float], rows: list[int]) -> Filters:
        full = np.array([(table[i // 8] >> (i % 8) & 1).mean() for i in range(len(langs))], float)
        return cls(langs, table, full**HASHES, np.array(usual), max(range(len(langs)), key=lambda i: (rows[i], -i), default=0))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Language and score of each text."""
        n = len(texts)
        if not self.langs or not n:
            return ["und"] * n, np.zeros(n)
        hashes, owners, has = grams([t or "" for t in texts])
        h, owner = np.concatenate(hashes), np.concatenate(owners)
        total = np.bincount(owner, minlength=n)
        slots = [slots_of(h, k, self.table.shape[1].bit_length() - 1) for k in range(HASHES)]
        counts = []
        for group in self.table:
            mask = group[slots[0]]
            for s in slots[1:]:
                mask &= group[s]
            counts.append(np.bincount((owner << 8) + mask, minlength=n << 8).reshape(n, 256) @ BITS)
        seen = np.concatenate(counts, axis=1)[:, : len(self.langs)]
        true = np.maximum(seen - total[:, None] * self.false, 0) / (1 - self.false) / self.usual
        best, sums = true.argmax(axis=1), true.sum(axis=1)
        score = np.where(has & (sums > 0), true[np.arange(n), best] / np.where(sums > 0, sums, 1), 0.0)
        best = np.where(sums > 0, best, self.most)
        return [self.langs[b] if ok else "und" for b, ok in zip(best, has)], score


def is_held_out(doc_id: Column) -> Column:
    """Rows that never teach: CRC-32 of the id's text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def slot_bits(largest: int, langs: int) -> int:
    """Slots, as a power of two, for so many n-grams in the largest language."""
    wanted = max(LEAST_BITS, int(ROOM * largest).bit_length())
    return min(wanted, (TABLE_BYTES // max(1, -(-langs // 8))).bit_length() - 1)


def fill_table(members: DataFrame, langs: list[str], bits: int) -> np.ndarray:
    """The table of ``members(lang, gram)``: a row of slots for each eight languages; each task ORs the bits of some blocks of slots."""
    place, groups, block = {x: i for i, x in enumerate(langs)}, -(-len(langs) // 8), 1 << BLOCK_BITS

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int32)
            gram = batch.column("gram").to_numpy().view(np.uint64)
            slot = np.concatenate([slots_of(gram, k, bits) for k in range(HASHES)])
            yield pa.RecordBatch.from_arrays([pa.array((slot >> BLOCK_BITS).astype(np.int32)), pa.array((slot % block).astype(np.int32)), pa.array(np.tile(lang, HASHES))], names=["block", "at", "lang"])

    def merge(part: pa.Table) -> pa.Table:
        table, lang = np.zeros((groups, block), np.uint8), part.column("lang").to_numpy()
        np.bitwise_or.at(table, (lang // 8, part.column("at").to_numpy()), (1 << (lang % 8)).astype(np.uint8))
        return pa.table([part.column("block").slice(0, 1), pa.array([table.tobytes()], pa.binary())], schema=pa.schema([("block", pa.int32()), ("bits", pa.binary())]))

    dealt = members.mapInArrow(deal, "block int, at int, lang int").distinct()
    out = np.zeros((groups, 1 << bits), np.uint8)
    for r in dealt.groupBy("block").applyInArrow(merge, "block int, bits binary").collect():
        out[:, r["block"] * block : (r["block"] + 1) * block] = np.frombuffer(r["bits"], np.uint8).reshape(groups, block)
    return out


def fit_filters(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", fit_rows: int = FIT_ROWS) -> Filters:
    """Filters from the rows that may teach."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "language_id")
    teach = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~is_held_out(F.col(id_col)))
    many = {r["lang"]: r["count"] for r in teach.groupBy(F.col(lang_col).alias("lang")).count().limit(LANGS_MOST + 1).collect()}
    if len(many) > LANGS_MOST:
        raise ValueError(f"more than {LANGS_MOST} languages")
    #: A row for each language, of which there are ``LANGS_MOST`` at most.
    shares = spark.createDataFrame([(x, int(min(1.0, fit_rows / n) * (1 << 20) + 0.5)) for x, n in many.items()], "_lang string, below int")
    drawn = F.pmod(F.xxhash64("id", "text", F.lit("teach")), F.lit(1 << 20)) < F.col("below")
    rows = teach.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    sample = rows.join(F.broadcast(shares), F.col("lang") == F.col("_lang")).where(drawn).select("id", "lang", "text").distinct().select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            langs, texts = batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            for lang in sorted(set(langs)):
                hashes, _, _ = grams([t for x, t in zip(langs, texts) if x == lang])
                gram, n = np.unique(np.concatenate(hashes), return_counts=True)
                columns = [pa.array([lang] * len(gram), pa.string()), pa.array(gram.view(np.int64)), pa.array(n.astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    counts = scratch.keep("counts", sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    sums = counts.groupBy("lang").agg(F.sum("n").alias("total"))
    rated = counts.join(F.broadcast(sums), "lang").withColumn("rate", F.col("n") / F.col("total"))
    own = rated.withColumn("top", F.max("rate").over(Window.partitionBy("gram"))).where("n >= 2 and rate * 3 >= top")
    members = scratch.keep("members", own.select("lang", "gram", "rate"))
    found = members.groupBy("lang").agg(F.count("*").alias("n"), F.sum("rate").alias("usual")).orderBy("lang").collect()
    langs = [r["lang"] for r in found]
    table = fill_table(members, langs, slot_bits(max((r["n"] for r in found), default=0), len(langs)))
    scratch.drop()
    return Filters.of(langs, table, [r["usual"] for r in found], [many[x] for x in langs])


def identify(docs: DataFrame, filters: Filters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, held_out, lang_pred, score`` of each row."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SLICE_BYTES):
            langs, score = shared.value.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("held_out"), pa.array(langs, pa.string()), pa.array(score)], names=["id", "held_out", "lang_pred", "score"])

    plain = docs.select(F.col(id_col).alias("id"), is_held_out(F.col(id_col)).alias("held_out"), F.col(text_col).alias("text"))
    return to_python(plain).mapInArrow(run, f"id {kind}, held_out boolean, lang_pred string, score double").withColumnRenamed("id", id_col)
