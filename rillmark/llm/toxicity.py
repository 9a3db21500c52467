"""Toxicity grades by cumulative-link ordinal regression on sparse text features.

Features are a word and its first three to six letters, valued log(1 + count).
One weight vector serves all thresholds: P(grade <= j) = sigmoid(cut_j - w.x),
with rising cuts. The output is the expected grade, and a text is rejected where
P(grade >= 1) is at least one half.

The labels say only toxic or not. Grade 0 is "not"; the toxic rows get grades 1
to 3 by the tertiles of how many of their words are marker words, that is, words
whose features are far more frequent in toxic rows of the sample. So severity
tells how much of it a text holds and not which share: a long text with ten such
words ranks above a short one with five. The model is fitted on about
``FIT_ROWS`` labelled documents of each class, drawn by a hash of the id, with
both classes of equal weight, and on every feature of at least ``ROWS_LEAST``
rows whose shares of the two classes lie ``APART`` standard errors apart.

Cases: null text is empty; a text without any of these features has grade 0 and
stays, since nothing speaks against it; labels that are null teach nothing;
an id with several labels is toxic if one that is drawn says so; of rows that
repeat an id the least text teaches and each is judged, all alike; without both
classes in the sample nothing is rejected and every grade is 0. Whole texts of
any length count. Columns besides the named ones are not read. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import log1p

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow import give_back, slices, to_python
from .store import Scratch

FIT_ROWS, ROWS_LEAST, APART, GRADES = 6_000, 3, 3.0, 4
#: Words that a worker remembers, and the longest of them.
SEEN_MOST, SEEN_LONGEST = 60_000, 64
WORD = re.compile(r"\w+")


def features_of(word: str) -> list[str]:
    """The word and its shorter starts, marked by a trailing star."""
    return [word, *(word[:n] + "*" for n in range(3, 7) if n < len(word))]


@dataclass
class Severity:
    """Weights, rising cuts and the feature index; empty without a fit."""

    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    cuts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    _known: dict[str, list[int]] = field(default_factory=dict, repr=False)
    _plain: set[str] = field(default_factory=set, repr=False)

    def counts(self, text: str | None) -> dict[int, int]:
        """How often each selected feature occurs in a text."""
        words = WORD.findall((text or "").lower())
        distinct = set(words)
        if len(self._plain) + len(self._known) > SEEN_MOST:
            self.forget()
        telling: dict[str, list[int]] = {}
        for w in distinct - self._plain:
            if (found := self._known.get(w)) is None:
                found = [self.index[f] for f in features_of(w) if f in self.index]
                if len(w) <= SEEN_LONGEST:
                    if found:
                        self._known[w] = found
                    else:
                        self._plain.add(w)
            if found:
                telling[w] = found
        out: dict[int, int] = {}
        if telling:
            for w, n in Counter(w for w in words if w in telling).items():
                for f in telling[w]:
                    out[f] = out.get(f, 0) + n
        return out

    def forget(self) -> None:
        """Drop the words remembered."""
        self._plain.clear()
        self._known.clear()

    def at_least(self, counts: dict[int, int]) -> np.ndarray:
        """P(grade >= j) for j from 1."""
        if not counts or not len(self.cuts):
            return np.zeros(len(self.cuts) or GRADES - 1)
        weight = self.weights.item
        x = sum(weight(f) * log1p(n) for f, n in counts.items())
        return 1 / (1 + np.exp(np.clip(self.cuts - x, -60, 60)))


def cuts_of(parameters: np.ndarray, n_features: int) -> np.ndarray:
    """Rising cuts: the first, then each the exponential of a parameter above the one before."""
    return np.cumsum(np.concatenate([parameters[n_features : n_features + 1], np.exp(parameters[n_features + 1 :])]))


def penalised_loss(parameters: np.ndarray, owner: np.ndarray, feature: np.ndarray, value: np.ndarray, grades: np.ndarray, weight: np.ndarray, n_features: int, ridge: float) -> tuple[float, np.ndarray]:
    """Weighted negative log-likelihood with a ridge on the weights, and its gradient."""
    row, top = np.arange(len(grades)), len(parameters) - n_features
    w, cuts = parameters[:n_features], cuts_of(parameters, n_features)
    x = np.bincount(owner, w[feature] * value, minlength=len(grades))
    #: Columns 0 to top + 1: P(grade <= j - 1).
    below = np.ones((len(grades), top + 2))
    below[:, 0] = 0
    below[:, 1:-1] = 1 / (1 + np.exp(np.clip(x[:, None] - cuts, -60, 60)))
    p = np.maximum(below[row, grades + 1] - below[row, grades], 1e-12)
    slope = below * (1 - below)
    up, low = slope[row, grades + 1], slope[row, grades]
    by_x = weight * (up - low) / p
    by_cut = np.zeros((len(grades), top + 2))
    by_cut[row, grades + 1] -= weight * up / p
    by_cut[row, grades] += weight * low / p
    after = np.cumsum(by_cut[:, 1:-1].sum(axis=0)[::-1])[::-1]
    gradient = np.concatenate([np.bincount(feature, by_x[owner] * value, minlength=n_features) + ridge * w, after[:1], after[1:] * np.exp(parameters[n_features + 1 :])])
    return float(-(weight * np.log(p)).sum() + ridge / 2 * (w**2).sum()), gradient


def fit_ordinal(owner: np.ndarray, feature: np.ndarray, count: np.ndarray, grades: np.ndarray, weight: np.ndarray, n_features: int, steps: int = 400, ridge: float = 1e-4) -> tuple[np.ndarray, np.ndarray]:
    """Weights and cuts of largest penalised likelihood, by Adam over all rows; row ``owner`` holds ``feature`` so often."""
    value = np.log1p(count.astype(float))
    parameters = np.concatenate([np.zeros(n_features), [1.0], np.zeros(int(grades.max()) - 1)])
    first, second = np.zeros_like(parameters), np.zeros_like(parameters)
    for t in range(1, steps + 1):
        _, gradient = penalised_loss(parameters, owner, feature, value, grades, weight / weight.sum(), n_features, ridge)
        first, second = 0.9 * first + 0.1 * gradient, 0.999 * second + 0.001 * gradient**2
        parameters = parameters - 0.1 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-9)
    return parameters[:n_features], cuts_of(parameters, n_features)


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, fit_rows: int) -> DataFrame:
    """``(text, toxic)`` of about ``fit_rows`` labelled documents of each class, one row an id."""
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), (F.col(label_col).cast("int") > 0).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    bound = lambda y: F.lit(int(min(1.0, fit_rows / max(1, counts.get(y, 0))) * (1 << 20) + 0.5))
    draw = F.pmod(F.xxhash64(F.col("id"), F.lit("severity")), F.lit(1 << 20))
    #: About twice ``fit_rows`` ids by the draw, so this side has a bound.
    chosen = known.where(draw < F.when(F.col("toxic") == 1, bound(1)).otherwise(bound(0))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")
    return found.groupBy("id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")


def fit_severity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", fit_rows: int = FIT_ROWS) -> Severity:
    """A model from the labelled rows of ``docs``."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    sample = scratch.keep("sample", labelled_sample(docs, labels, id_col, text_col, label_col, fit_rows))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            plain, toxic, rows = Counter(), Counter(), [0, 0]
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                (toxic if y else plain).update({f for w in set(WORD.findall((text or "").lower())) for f in features_of(w)})
                rows[bool(y)] += 1
            plain[""], toxic[""] = rows
            names = list(plain | toxic)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([plain[f] for f in names], pa.int64()), pa.array([toxic[f] for f in names], pa.int64())], names=["feature", "plain", "toxic"])

    counted = sample.mapInArrow(count, "feature string, plain long, toxic long").groupBy("feature").agg(F.sum("plain").alias("plain"), F.sum("toxic").alias("toxic"))
    table = scratch.keep("features", counted)
    rows = table.where("feature = ''").first()
    n0, n1 = (rows["plain"], rows["toxic"]) if rows else (0, 0)
    if not n0 or not n1:
        return Severity()
    share = (F.col("plain") + F.col("toxic") + 0.5) / (n0 + n1 + 1)
    apart = F.abs(F.col("toxic") / n1 - F.col("plain") / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    ratio = ((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("plain") + 0.5) / (n0 + 1))
    telling = table.where((F.col("feature") != "") & (F.col("plain") + F.col("toxic") >= ROWS_LEAST) & (apart >= APART))
    #: Features of the sample's documents, of which there are about twice ``fit_rows``.
    best = telling.select("feature", ratio.alias("ratio")).orderBy("feature").collect()
    model = Severity({r["feature"]: i for i, r in enumerate(best)})
    marker = np.array([r["ratio"] >= 20 for r in best], bool)
    shared = spark.sparkContext.broadcast(model.index)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Severity(shared.value)
        for batch in slices(batches, "text"):
            found = [reader.counts(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array([list(c) for c in found], pa.list_(pa.int32())), pa.array([list(c.values()) for c in found], pa.list_(pa.int32()))], names=["toxic", "f", "n"])

    got = sample.mapInArrow(gather, "toxic int, f array<int>, n array<int>").toArrow()
    scratch.drop()
    toxic = got.column("toxic").to_numpy() > 0
    sizes = pc.list_value_length(got.column("f")).to_numpy()
    feature, count = (pc.list_flatten(got.column(c)).to_numpy() for c in ("f", "n"))
    del got
    ends = np.cumsum(sizes)
    evidence = np.bincount(np.repeat(np.arange(len(sizes)), sizes), count * marker[feature], minlength=len(sizes))
    grades = np.zeros(len(sizes), np.int64)
    grades[toxic] = 1 + np.searchsorted(np.quantile(evidence[toxic], np.arange(1, GRADES - 1) / (GRADES - 1)), evidence[toxic], side="left")
    grades = np.unique(grades, return_inverse=True)[1]  # where tertiles coincide there are fewer grades
    #: Task order must not matter.
    digest = [xxhash.xxh64_intdigest(feature[e - n : e].tobytes() + count[e - n : e].tobytes()) for e, n in zip(ends, sizes)]
    order = np.lexsort((np.array(digest, np.uint64), grades))
    places = np.concatenate([np.zeros(0, np.int64), *(np.arange(ends[i] - sizes[i], ends[i]) for i in order)])
    owner, grades = np.repeat(np.arange(len(sizes)), sizes[order]), grades[order]
    weight = np.where(grades > 0, np.sum(grades == 0) / max(1, np.sum(grades > 0)), 1.0)
    model.weights, model.cuts = fit_ordinal(owner, feature[places], count[places], grades, weight, len(best))
    give_back()
    return model


def grade(docs: DataFrame, model: Severity, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, severity, grade, p_toxic, toxic`` of each row: expected grade, most likely grade, P(grade >= 1), decision."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value
        for batch in slices(batches, "text"):
            p = [reader.at_least(reader.counts(t)) for t in batch.column("text").to_pylist()]
            likely = [int(np.argmax(-np.diff(np.concatenate([[1.0], x, [0.0]])))) for x in p]
            first = [float(x[0]) for x in p]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array([float(x.sum()) for x in p]), pa.array(likely, pa.int32()), pa.array(first), pa.array([x >= 0.5 for x in first])], names=["id", "severity", "grade", "p_toxic", "toxic"])
        reader.forget()
        give_back()

    return to_python(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).mapInArrow(run, f"id {kind}, severity double, grade int, p_toxic double, toxic boolean").withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Severity, text_col: str = "text") -> DataFrame:
    """The rows that are not rejected, with all their columns, judged where they lie."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = shared.value
        names = None
        for batch in batches:
            names = names or [f"c{i}" for i in range(batch.num_columns)]
            for part in slices([pa.RecordBatch.from_arrays(batch.columns, names=names)], names[at]):
                yield part.filter(pa.array([reader.at_least(reader.counts(t))[0] < 0.5 for t in part.column(at).to_pylist()], pa.bool_()))
        reader.forget()
        give_back()

    numbered = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    return to_python(numbered).mapInArrow(run, numbered.schema).toDF(*docs.columns)
