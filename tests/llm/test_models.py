"""Operators that learn: toxicity and language."""

import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillmark.llm import language_id, toxicity


def test_ordinal_fit_recovers_order():
    draw = np.random.default_rng(0)
    rows = [{0: int(n)} if n else {} for n in draw.integers(0, 12, 600)]
    strength = np.array([np.log1p(r.get(0, 0)) for r in rows])
    grades = np.searchsorted([0.5, 1.5, 2.2], strength + draw.normal(0, 0.1, 600))
    owner = np.array([i for i, r in enumerate(rows) for _ in r])
    weights, cuts = toxicity.fit_ordinal(owner, np.zeros_like(owner), np.array([n for r in rows for n in r.values()]), grades, np.ones(600), 1)
    model = toxicity.Severity({"a": 0}, weights, cuts)
    expected = [model.at_least({0: n}).sum() for n in range(1, 12)]
    assert np.all(np.diff(cuts) > 0) and np.all(np.diff(expected) > 0)
    guess = np.array([model.at_least(r).sum() for r in rows]).round()
    assert np.mean(np.abs(guess - grades) <= 1) > 0.98


def test_gradient_is_that_of_the_loss():
    draw = np.random.default_rng(3)
    owner, feature = np.repeat(np.arange(30), 4), draw.integers(0, 5, 120)
    value, grades, weight = draw.random(120), draw.integers(0, 4, 30), draw.random(30)
    at = np.concatenate([draw.normal(size=5), [0.3], draw.normal(size=2)])
    loss = lambda x: toxicity.penalised_loss(x, owner, feature, value, grades, weight, 5, 0.1)
    slopes = [(loss(at + e)[0] - loss(at - e)[0]) / 2e-6 for e in np.eye(8) * 1e-6]
    assert loss(at)[1] == pytest.approx(slopes, abs=1e-6)
    #: The loss by hand: P(grade <= j) = sigmoid(cut_j - w.x).
    cuts, total = np.cumsum([at[5], np.exp(at[6]), np.exp(at[7])]), 0.05 * (at[:5] ** 2).sum()
    for i in range(30):
        x = sum(at[f] * v for o, f, v in zip(owner, feature, value) if o == i)
        below = [0, *(1 / (1 + np.exp(x - cuts))), 1]
        total -= weight[i] * np.log(below[grades[i] + 1] - below[grades[i]])
    assert loss(at)[0] == pytest.approx(total)


def by_hand(model, text):
    """Grade probabilities feature by feature."""
    counts = {}
    for word in re.findall(r"\w+", (text or "").lower()):
        for f in [word] + [word[:n] + "*" for n in (3, 4, 5, 6) if n < len(word)]:
            if f in model.index:
                counts[f] = counts.get(f, 0) + 1
    x = sum(model.weights[model.index[f]] * np.log(1 + n) for f, n in counts.items()) if counts else -np.inf
    return [1 / (1 + np.exp(c - x)) for c in model.cuts]


def test_toxicity_on_labelled_rows(spark, small):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    teach = labels.where(F.col("doc_id") % 4 != 1)
    model = toxicity.fit_severity(docs, teach)
    rows = toxicity.grade(docs, model).join(docs.select("doc_id", "text"), "doc_id").join(labels.withColumnRenamed("toxic", "label"), "doc_id").where(F.col("doc_id") % 4 == 1).collect()
    toxic = [r["toxic"] for r in rows if r["label"]]
    assert sum(toxic) >= 0.9 * len(toxic) > 50
    rejected = [bool(r["label"]) for r in rows if r["toxic"]]
    assert sum(rejected) >= 0.9 * len(rejected)
    for r in rows[:200]:
        p = by_hand(model, r["text"])
        assert (r["p_toxic"], r["severity"]) == pytest.approx((p[0], sum(p))) and 0 <= r["severity"] <= toxicity.GRADES - 1


def test_rare_toxic_rows_are_drawn_and_repeats_judged_alike(spark):
    rows = [(i, f"plain words number {i}") for i in range(3000)] + [(i, "you vile wretch go away") for i in range(3000, 3012)]
    docs = spark.createDataFrame(rows + [(5, "plain words number 5")] * 50 + [(9000, "vile wretch")] * 3, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 3000)) for i, _ in rows], "doc_id long, toxic int")
    sample = toxicity.labelled_sample(docs, labels, "doc_id", "text", "toxic", 100)
    drawn = [r["toxic"] for r in sample.collect()]
    assert drawn.count(1) == 12 and 50 < drawn.count(0) < 150
    model = toxicity.fit_severity(docs, labels, fit_rows=100)
    got = toxicity.grade(docs, model).collect()
    assert {r["doc_id"] for r in got if r["toxic"]} == {*range(3000, 3012), 9000}
    assert len({r["severity"] for r in got if r["doc_id"] == 9000}) == 1 and sum(r["doc_id"] == 5 for r in got) == 51


def test_toxicity_cases(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(i, int(i in (14, 5))) for i in range(17)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit_severity(odd_docs, labels)
    assert toxicity.grade(odd_docs, model).count() == odd_docs.count()
    kept = toxicity.drop_toxic(odd_docs, model)
    assert kept.columns == odd_docs.columns and kept.schema == odd_docs.schema
    bare = toxicity.fit_severity(odd_docs, labels.where("toxic = 0"))
    assert toxicity.drop_toxic(odd_docs, bare).count() == odd_docs.count()
    assert toxicity.fit_severity(no_docs, labels).index == {} and toxicity.grade(no_docs, bare).count() == 0


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.identify(docs, language_id.fit_filters(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in found if r["held_out"]]
    assert len(found) == docs.count() and sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in found)


def test_language_cases(spark, odd_docs, no_docs):
    rows = {r["doc_id"]: r for r in language_id.identify(odd_docs, language_id.fit_filters(odd_docs)).collect()}
    assert rows[0]["lang_pred"] == rows[1]["lang_pred"] == rows[3]["lang_pred"] == "und" and rows[0]["score"] == 0
    assert rows[6]["lang_pred"] in ("en", "de")
    empty = language_id.fit_filters(no_docs)
    assert language_id.identify(no_docs, empty).count() == 0
    assert {r["lang_pred"] for r in language_id.identify(odd_docs, empty).collect()} == {"und"}


def test_grams_stay_inside_texts():
    texts = ["Ab c!", "", "--", "éa"]
    hashes, owners, has = language_id.grams(texts)
    alone = [language_id.grams([t]) for t in texts]
    for k in range(len(language_id.SIZES)):
        for i in range(len(texts)):
            assert sorted(hashes[k][owners[k] == i]) == sorted(alone[i][0][k])
    assert has.tolist() == [True, False, False, True]
    assert len(hashes[0]) == len([" ab", "ab ", "b c", " c "]) + len([" éa", "éa "])


def test_more_than_eight_languages(spark):
    draw = np.random.default_rng(2)
    langs = [f"l{i:02d}" for i in range(19)]
    members = {x: draw.integers(0, 1 << 63, 500, dtype=np.uint64) for x in langs}
    frame = spark.createDataFrame([(x, int(g)) for x, grams in members.items() for g in grams], "lang string, gram long")
    bits = language_id.slot_bits(500, 19)
    table = language_id.fill_table(frame, langs, bits)
    want = np.zeros((3, 1 << bits), np.uint8)
    for i, lang in enumerate(langs):
        for k in range(language_id.HASHES):
            want[i // 8, language_id.slots_of(members[lang], k, bits)] |= np.uint8(1 << i % 8)
    assert np.array_equal(table, want)


def test_the_table_has_a_bound():
    assert language_id.slot_bits(10, 4) == language_id.LEAST_BITS
    for grams in (10**3, 10**6, 10**9):
        for langs in (1, 8, 9, 100, language_id.LANGS_MOST):
            bits = language_id.slot_bits(grams, langs)
            assert bits > language_id.BLOCK_BITS and -(-langs // 8) << bits <= language_id.TABLE_BYTES


def test_predictions_against_sets_of_grams(spark, small):
    """With few n-grams in a table of the usual size hardly any is mistaken, so sets of n-grams predict the same."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    filters = language_id.fit_filters(docs)
    taught = docs.where(~language_id.is_held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).collect()
    counts = {}
    for r in taught:
        own = counts.setdefault(r["lang"], Counter())
        for h in language_id.grams([r["text"]])[0]:
            own.update(h.tolist())
    rates = {x: {g: n / sum(c.values()) for g, n in c.items()} for x, c in counts.items()}
    members = {x: {g for g, n in c.items() if n >= 2 and 3 * rates[x][g] >= max(rates[y].get(g, 0) for y in rates)} for x, c in counts.items()}
    usual = {x: sum(rates[x][g] for g in sorted(members[x])) for x in members}
    assert filters.langs == sorted(members) and filters.usual == pytest.approx([usual[x] for x in sorted(members)])
    agree = 0
    rows = docs.collect()
    for r, lang in zip(rows, filters.predict([r["text"] for r in rows])[0]):
        found = [g for h in language_id.grams([r["text"] or ""])[0] for g in h.tolist()]
        best = max(sorted(members), key=lambda x: sum(g in members[x] for g in found) / usual[x])
        agree += lang == best
    assert agree >= 0.98 * len(rows)


def test_a_rare_language_is_learnt_and_repeats_are_judged_alike(spark):
    rows = [(i, f"the usual words of a large language come here number {i}", "big") for i in range(4000)] + [(i, "kvoz truma belik sodran pulte hafim", "rare") for i in range(4000, 4016)]
    rows += [(9001, "belik sodran pulte", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = language_id.fit_filters(docs, fit_rows=50)
    got = [r for r in language_id.identify(docs, filters).collect() if r["doc_id"] >= 3990]
    assert all((r["lang_pred"] == "rare") == (r["doc_id"] >= 4000) for r in got)
    assert len([r for r in got if r["doc_id"] == 9001]) == 3 and len({r["score"] for r in got if r["doc_id"] == 9001}) == 1
