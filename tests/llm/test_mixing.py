import re
from collections import defaultdict

import duckdb
import pytest

from rillmark.llm import mixing, queries


def targets(sizes):
    """Shares by weight, what is above three times a source's size shared anew until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in capped]
        left, weights = total - sum(capped.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / weights > 3 * sizes[s]]
        if not over:
            return capped | {s: left * weight[s] / weights for s in free}
        capped |= {s: 3 * sizes[s] for s in over}


def check(frame):
    rows = {(r["doc_id"], r["source"]): len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in frame.collect()}
    got = mixing.mix_plan(frame).join(frame.select("doc_id", "source").distinct(), "doc_id", "left").collect()
    sizes = defaultdict(int)
    for r in frame.collect():
        sizes[r["source"]] += rows[r["doc_id"], r["source"]]
    want, taken, largest = targets(sizes), defaultdict(int), defaultdict(int)
    for r in got:
        if r["doc_id"] is None:
            continue
        assert r["size"] == rows[r["doc_id"], r["source"]] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"], 3 * r["size"])
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s, n in taken.items():
        assert abs(n - want[s]) <= max(largest[s], 1)
    return got


def test_targets_and_nearness(docs, odd_docs):
    check(docs)
    check(odd_docs)


def test_same_as_sql_and_same_again(docs, small):
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = sorted(sql.sql(queries.op5_sql()).fetchall())
    for frame, few in ((docs, None), (docs.repartition(5), 0)):
        got = mixing.mix_plan(frame, broadcast_sources=few).select("doc_id", "size", "source_size", "target", "taken").collect()
        assert sorted(tuple(r) for r in got) == want


def test_mix_repeats_rows(odd_docs, no_docs, docs):
    plan = {r["doc_id"]: r["copies"] for r in mixing.mix_plan(docs).collect()}
    mixed = [r["doc_id"] for r in mixing.mix(docs).collect()]
    assert len(mixed) == sum(plan.values()) and all(mixed.count(d) == n for d, n in plan.items())
    assert mixing.mix(odd_docs).columns == odd_docs.columns
    assert mixing.mix_plan(no_docs).count() == mixing.mix(no_docs).count() == 0
