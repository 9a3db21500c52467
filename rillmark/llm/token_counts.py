"""Token counts of sections from one encoding of the whole document.

A document is encoded once. The byte lengths of its tokens give each token's
place; byte places map to character places through the text's UTF-8. Sections
are half-open character spans that together cover the text, and each token meets
the sections that its span touches in an interval join over the two sorted lists.

Rule for a token that crosses a boundary: ``start`` gives it to the section of
its first character (the default), ``end`` to that of its last, and ``split``
shares it by characters. A byte-level token may hold only some bytes of a
character; it then lies where that character lies. So in every rule the counts
of a document's sections sum to its tokens.

Cases: null and empty texts have one empty section without tokens; a text's
sections are its lines, each with its line feed, and a last one without, if
any; texts of any length are encoded whole, long runs of white space apart from
what lies around them, since the library's pattern gives up in them; rows that
repeat are counted like any other; an empty table gives an empty result. Columns
besides id and text are not read. Strings that look like special tokens are text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import slices, to_python

RULES = ("start", "end", "split")
#: White space of Unicode, and the length from which a run of it is encoded apart.
WHITE, LONG_RUN = "\\x09-\\x0D\\x20\\x85\\xA0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000", 50_000
#: How a pattern ends whose white space is cut as ``tokens_of`` says.
RUNS_END = r"|\s+(?!\S)|\s+"
_loaded: dict[str, tuple] = {}


def encoder(path: str, pattern: str) -> tuple:
    """This worker's encoding and the byte length of each token."""
    import tiktoken

    if path not in _loaded:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        lengths = np.zeros(max(ranks.values()) + 1, np.int64)
        for piece, rank in ranks.items():
            lengths[rank] = len(piece)
        _loaded[path] = tiktoken.Encoding(path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths
    return _loaded[path]


def tokens_of(encoding, text: str, pattern: str) -> np.ndarray:
    """Ids of a text.

    The pattern makes one piece of a run of white space, but for its last
    character where a word follows; so the text falls apart there by rule.
    """
    plain = lambda s: encoding.encode_to_numpy(s, allowed_special=set(), disallowed_special=()).astype(np.int64)
    if len(text) < LONG_RUN or not pattern.endswith(RUNS_END):
        return plain(text)
    parts, at = [], 0
    for run in re.finditer(f"[{WHITE}]{{{LONG_RUN},}}", text):
        end = run.end() - (run.end() < len(text))
        parts += [plain(text[at : run.start()]), np.array(encoding._encode_single_piece(text[run.start() : end]), np.int64)]
        at = end
    return np.concatenate([*parts, plain(text[at:])])


def token_spans(text: str, path: str, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First character of each token and the character after its last."""
    encoding, lengths = encoder(path, pattern)
    ends = np.cumsum(lengths[tokens_of(encoding, text, pattern)])
    octets = np.frombuffer(text.encode(), np.uint8)
    #: Which character each byte belongs to.
    character = np.cumsum((octets & 0xC0) != 0x80) - 1
    return character[ends - np.diff(ends, prepend=0)], character[ends - 1] + 1


def line_sections(text: str) -> np.ndarray:
    """Character positions of the section boundaries, 0 and the length included."""
    octets = np.frombuffer(text.encode(), np.uint8)
    starts = np.cumsum((octets & 0xC0) != 0x80)[octets == 10]  # the character after each line feed
    length = len(text)
    inner = starts[starts < length]
    return np.concatenate([[0], inner, [length]])


def attribute(starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str = "start") -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and those of them (first characters) that run over its end."""
    n = len(bounds) - 1
    if not len(starts):
        return np.zeros(n), np.zeros(n, np.int64)
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    crossing = np.bincount(first[last > first], minlength=n)
    if rule != "split":
        return np.bincount(first if rule == "start" else last, minlength=n).astype(float), crossing
    #: A row for each token and section that meet.
    met = last - first + 1
    token = np.repeat(np.arange(len(starts)), met)
    section = first[token] + np.arange(len(token)) - np.repeat(np.cumsum(met) - met, met)
    inside = np.minimum(ends[token], bounds[section + 1]) - np.maximum(starts[token], bounds[section])
    return np.bincount(section, inside / (ends - starts)[token], minlength=n), crossing


def section_tokens(docs: DataFrame, model_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", rule: str = "start") -> DataFrame:
    """``id, section, char_start, char_end, n_tokens, n_crossing, doc_tokens``; ``n_tokens`` is a double under ``split``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    kind = docs.schema[id_col].dataType.simpleString()
    number = pa.float64() if rule == "split" else pa.int64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sizes, columns = [], [[], [], [], [], [], []]
            for text in batch.column("text").to_pylist():
                text = text or ""
                starts, ends = token_spans(text, model_path, pattern) if text else (np.zeros(0, np.int64),) * 2
                bounds = line_sections(text) if text else np.zeros(2, np.int64)
                counts, crossing = attribute(starts, ends, bounds, rule)
                n = len(counts)
                sizes.append(n)
                for column, values in zip(columns, (np.arange(n), bounds[:-1], bounds[1:], counts, crossing, np.full(n, len(starts)))):
                    column.append(values)
            row = np.repeat(np.arange(len(sizes)), sizes)
            kinds = [pa.int64()] * 3 + [number] + [pa.int64()] * 2
            arrays = [pa.array(np.concatenate(c).astype(t.to_pandas_dtype()), t) for c, t in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column("id").take(pa.array(row)), *arrays], names=["id", "section", "char_start", "char_end", "n_tokens", "n_crossing", "doc_tokens"])

    schema = f"id {kind}, section long, char_start long, char_end long, n_tokens {'double' if rule == 'split' else 'long'}, n_crossing long, doc_tokens long"
    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, schema).withColumnRenamed("id", id_col)
