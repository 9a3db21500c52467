"""SentencePiece encoding and decoding with a score-ordered agenda.

A merge-type model joins, again and again, the adjacent pair of symbols whose
joined string is the vocabulary piece of highest score, the leftmost of equals.
No piece holds the space mark after another character, nor a line feed, so no
merge crosses the start of a word or a line feed: text is cut there into
segments, each distinct segment is encoded once per worker while it stays in a
bounded cache, and a document's ids are its segments' ids in order. Short
segments go through the agenda together, one merge each per round; long ones one
by one with a heap. Each newly encoded segment is compared with the sentencepiece
library in the same Arrow batch; where they differ, the library's ids hold and
the segment counts in ``n_differing``.

Decoding starts from the ids: each segment's ids become the text of their pieces,
runs of byte pieces their UTF-8, and a document's decoded text is that of its
segments in order, with space marks made spaces. A character is never split
between segments, so neither is a run of its bytes.

Cases: null counts as empty; an empty text has no ids and decodes to itself;
characters without a piece become UTF-8 byte pieces; runs of spaces, a leading
space and the space mark itself in a text take the general cut. Texts of any
length are encoded whole. Rows that repeat are encoded like any other; columns
besides id and text are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import give_back, slices, to_python

MARK = "▁"
SHORT = 40
#: Bytes that a worker's segments take at about 250 an entry; longest segment held; bytes of text read at once.
CACHE_BYTES, ENTRY_BYTES, CACHE_LONGEST, SLICE_BYTES = 96 << 20, 250, 64, 1 << 20
_loaded: dict[str, Agenda] = {}


class Agenda:
    """Encoder and decoder of one merge-type model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.pieces = [sp.id_to_piece(i) for i in range(size)]
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if sp.is_byte(i)}
        if len(self.bytes) != 256 or sp.normalize(" a  ﬁ ") != f"{MARK * 2}a{MARK * 2}ﬁ{MARK}":
            raise ValueError("a model with byte pieces, a leading space mark and unchanged text is needed")
        self.value = {i: b for b, i in self.bytes.items()}
        plain = {p: i for i, p in enumerate(self.pieces) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in plain):
            raise ValueError("a piece crosses the start of a word or a line feed")
        #: Symbols: pieces by id, then single characters that are no piece.
        self.symbols = dict(plain)
        self.text_of = [str(i) for i in range(size)]
        self.decoded_of = list(self.pieces)
        ranks = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in plain.values()}, reverse=True))}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for piece, i in plain.items():
            for cut in range(1, len(piece)):
                left, right = piece[:cut], piece[cut:]
                if (len(left) == 1 or left in plain) and (len(right) == 1 or right in plain):
                    self.pairs[self.symbol(left), self.symbol(right)] = (ranks[sp.get_score(i)], i)
        self._index()
        #: Ids of the segments seen lately and before; where they decode to another text than the segment, that text.
        self.cache: dict[str, str] = {}
        self.older: dict[str, str] = {}
        self.texts: dict[str, str] = {}
        #: Segments where the library's ids hold.
        self.differing: set[str] = set()

    def symbol(self, s: str) -> int:
        """The symbol of a piece or a character; a new character gets one, written as its bytes' ids."""
        if s not in self.symbols:
            self.symbols[s] = len(self.text_of)
            ids = [self.bytes[b] for b in s.encode()]
            self.text_of.append(",".join(map(str, ids)))
            self.decoded_of.append(bytes([self.value[i] for i in ids]).decode())
        return self.symbols[s]

    def _index(self) -> None:
        """Pairs in an open-addressing table that a whole array of pairs can be looked up in."""
        self.slots = 1 << 20
        self.key, self.rank, self.joined = np.full(self.slots, -1, np.int64), np.zeros(self.slots, np.int32), np.zeros(self.slots, np.int32)
        keys = np.array([a << 32 | b for a, b in self.pairs], np.int64)
        at, self.probes = self._slot(keys), 1
        for key, (rank, joined), slot in zip(keys.tolist(), self.pairs.values(), at.tolist()):
            steps = 1
            while self.key[slot] >= 0:
                slot, steps = (slot + 1) % self.slots, steps + 1
            self.key[slot], self.rank[slot], self.joined[slot], self.probes = key, rank, joined, max(self.probes, steps)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(44)).astype(np.int64) % self.slots

    def _lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of each pair, a large number where it joins to no piece, and what it joins to."""
        keys = left << 32 | right
        slot = self._slot(keys)
        rank, joined = np.full(len(keys), 1 << 30, np.int64), np.zeros(len(keys), np.int64)
        todo = np.arange(len(keys))
        for _ in range(self.probes):
            here = self.key[slot[todo]]
            hit = here == keys[todo]
            rank[todo[hit]], joined[todo[hit]] = self.rank[slot[todo[hit]]], self.joined[slot[todo[hit]]]
            todo = todo[(here >= 0) & ~hit]
            if not len(todo):
                break
            slot[todo] = (slot[todo] + 1) % self.slots
        return rank, joined

    def encode_heap(self, segment: str) -> list[int]:
        """Symbols of one segment, its agenda a heap."""
        symbols = [self.symbol(c) for c in segment]
        before, after = list(range(-1, len(symbols) - 1)), [*range(1, len(symbols)), -1]
        agenda: list[tuple[int, int, int, int, int]] = []

        def propose(i: int, j: int) -> None:
            if i >= 0 and j >= 0 and (found := self.pairs.get((symbols[i], symbols[j]))):
                heapq.heappush(agenda, (found[0], i, j, symbols[i], symbols[j]))

        for i in range(len(symbols) - 1):
            propose(i, i + 1)
        while agenda:
            _, i, j, a, b = heapq.heappop(agenda)
            if symbols[i] != a or symbols[j] != b or after[i] != j:
                continue
            symbols[i], symbols[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            propose(before[i], i)
            propose(i, after[i])
        return [s for s in symbols if s >= 0]

    def encode_short(self, segments: list[str]) -> list[list[int]]:
        """Symbols of many segments; each round takes the first entry of every segment's agenda."""
        get, symbol = self.symbols.get, self.symbol
        lengths = np.array([len(s) for s in segments])
        symbols = np.array([x if (x := get(c)) is not None else symbol(c) for c in "".join(segments)], np.int64)
        owner = np.repeat(np.arange(len(segments)), lengths)
        done_owner, done_symbols = [], []
        rank = np.full(len(symbols), 1 << 30, np.int64)
        joined = np.zeros(len(symbols), np.int64)
        same = np.flatnonzero(owner[:-1] == owner[1:])
        rank[same], joined[same] = self._lookup(symbols[same], symbols[same + 1])
        while len(symbols):
            starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            best = np.minimum.reduceat(rank << 32 | np.arange(len(rank)), starts)
            open_ = best >> 32 < 1 << 30
            if not open_.all():
                counts = np.diff(np.r_[starts, len(owner)])
                shut = np.repeat(~open_, counts)
                done_owner.append(owner[shut])
                done_symbols.append(symbols[shut])
                kept = ~shut
                best_at = (np.cumsum(kept) - 1)[(best & 0xFFFFFFFF)[open_]]
                owner, symbols, rank, joined = owner[kept], symbols[kept], rank[kept], joined[kept]
            else:
                best_at = best & 0xFFFFFFFF
            if not len(best_at):
                break
            symbols[best_at] = joined[best_at]
            kept = np.ones(len(symbols), bool)
            kept[best_at + 1] = False
            at = (np.cumsum(kept) - 1)[best_at]
            owner, symbols, rank, joined = owner[kept], symbols[kept], rank[kept], joined[kept]
            for i in (at - 1, at):
                i = i[i >= 0]
                inside = np.zeros(len(i), bool)
                ok = i + 1 < len(owner)
                inside[ok] = owner[i[ok]] == owner[i[ok] + 1]
                rank[i[~inside & ok]] = 1 << 30
                if len(owner):
                    rank[i[~ok]] = 1 << 30
                i = i[inside]
                rank[i], joined[i] = self._lookup(symbols[i], symbols[i + 1])
        owner, symbols = np.concatenate(done_owner or [owner]), np.concatenate(done_symbols or [symbols])
        order = np.argsort(owner, kind="stable")
        ends = np.cumsum(np.bincount(owner, minlength=len(segments))).tolist()
        flat, out, start = symbols[order].tolist(), [], 0
        for end in ends:
            out.append(flat[start:end])
            start = end
        return out

    def learn(self, keys: list[str]) -> None:
        """Encode new segments, hold them against the library and decode their ids.

        A key is a word, whose segment has the space mark before it, or begins
        with a line feed or the mark and is the segment itself.
        """
        segments = [k if k[:1] in ("\n", MARK) else MARK + k for k in keys]
        short = [i for i, s in enumerate(segments) if len(s) <= SHORT]
        found: dict[int, list[int]] = dict(zip(short, self.encode_short([segments[i] for i in short]))) if short else {}
        theirs = self.library.encode([s[1:] if s[:1] == MARK else s for s in segments], num_threads=1)
        text_of, decoded_of = self.text_of.__getitem__, self.decoded_of.__getitem__
        for i, (key, segment, library) in enumerate(zip(keys, segments, theirs)):
            mine = found[i] if i in found else self.encode_heap(segment)
            if segment[0] != MARK:
                library = library[1:]  # the library puts a mark of its own before a line feed
            elif segment == MARK:
                library = [self.symbols[MARK]]
            ids, text = ",".join(map(text_of, mine)), "".join(map(decoded_of, mine))
            if mine != library and ids != (theirs_text := ",".join(map(str, library))):
                ids, text = theirs_text, self.pieces_text(theirs_text)
                self.differing.add(key)
            if text != segment:
                self.texts[key] = text
            self.cache[key] = ids

    def forget(self, most: int = 0) -> None:
        """Where segments take half of ``most`` bytes, begin anew; those stay until as many more have come."""
        if 2 * len(self.cache) * ENTRY_BYTES >= most:
            self.differing.intersection_update(self.cache)
            self.texts = {k: v for k, v in self.texts.items() if k in self.cache}
            self.older = {k: v for k, v in self.cache.items() if len(k) <= CACHE_LONGEST} if most else {}
            self.cache = {}

    def pieces_text(self, ids: str) -> str:
        """The text of ids with its space marks; runs of byte pieces are UTF-8."""
        numbers, pieces, value = list(map(int, ids.split(","))) if ids else [], self.pieces, self.value
        if not any(i in value for i in numbers):
            return "".join([pieces[i] for i in numbers])
        return b"".join([bytes([value[i]]) if i in value else pieces[i].encode() for i in numbers]).decode("utf-8", "replace")

    def decode(self, ids: str) -> str:
        """The text of ids joined by commas."""
        return self.pieces_text(ids).replace(MARK, " ").removeprefix(" ")

    def keys_of(self, text: str) -> list[str]:
        """A text's segments as keys of the cache."""
        if not text:
            return []
        if "  " in text or MARK in text or text[0] == " ":
            return re.findall(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*", MARK + text.replace(" ", MARK))
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """Ids joined by commas, the text decoded from them and the number of differing segments, of each text."""
        keys = [self.keys_of(t) for t in texts]
        self.forget(CACHE_BYTES)
        new = {k for ks in keys for k in ks}
        new.difference_update(self.cache)
        for k in new & self.older.keys():
            self.cache[k] = self.older.pop(k)
        new.difference_update(self.cache)
        if new:
            self.learn(list(new))
        known, differing = self.cache.__getitem__, self.differing
        return [(",".join(map(known, ks)), self.decoded(ks), sum(k in differing for k in ks) if differing else 0) for ks in keys]

    def decoded(self, keys: list[str]) -> str:
        """What the ids of these keys decode to; ``learn`` has decoded each key's."""
        if self.texts:
            texts = [self.texts.get(k) or (k if k[:1] in ("\n", MARK) else MARK + k) for k in keys]
            return "".join(texts).replace(MARK, " ").removeprefix(" ")
        if keys and keys[0][:1] == MARK:
            return "".join(keys).replace(MARK, " ")[1:]
        return " ".join(keys).replace(" \n", "\n")


def agenda(path: str) -> Agenda:
    """The model of this worker."""
    if path not in _loaded:
        _loaded[path] = Agenda(path)
    return _loaded[path]


def encode_texts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", outputs: bool = False) -> DataFrame:
    """``id, n_tokens, ids_sha256, decoded_sha256, n_differing`` per row; with ``outputs`` also ``ids`` (array) and ``decoded``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = agenda(model_path)
        digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
        for batch in slices(batches, "text", SLICE_BYTES):
            found = model.encode([t or "" for t in batch.column("text").to_pylist()])
            columns = {
                "id": batch.column("id"),
                "n_tokens": pa.array([i.count(",") + 1 if i else 0 for i, _, _ in found], pa.int64()),
                "ids_sha256": pa.array([digest(i) for i, _, _ in found], pa.string()),
                "decoded_sha256": pa.array([digest(d) for _, d, _ in found], pa.string()),
                "n_differing": pa.array([n for _, _, n in found], pa.int64()),
            }
            if outputs:
                columns["ids"] = pa.array([list(map(int, i.split(","))) if i else [] for i, _, _ in found], pa.list_(pa.int32()))
                columns["decoded"] = pa.array([d for _, d, _ in found], pa.string())
            yield pa.RecordBatch.from_pydict(columns)
        model.forget()
        give_back()

    schema = f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, n_differing long" + ", ids array<int>, decoded string" * outputs
    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, schema).withColumnRenamed("id", id_col)
