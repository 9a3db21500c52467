import hashlib
import re
from collections import Counter

import numpy as np

from rillmark.llm import substring_dedup


def expected(rows, window=20):
    low = lambda i: (i is not None, i or 0)
    words = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (low(d), i)), (low(d), i))
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (low(d), i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((str(d), len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def check(frame):
    got = substring_dedup.remove_repeats(frame).collect()
    want = expected(frame.collect())
    assert sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got) == want
    return want


def test_against_all_windows(spark, docs, odd_docs):
    assert sum(w[2] for w in check(docs)) > 0
    assert sum(w[2] for w in check(odd_docs)) > 0


def test_branches_loops_and_overlaps(spark):
    draw = np.random.default_rng(1)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for d in range(40):
        a, n = draw.integers(0, 40), draw.integers(15, 50)
        own = [f"w{x}" for x in draw.integers(0, 5000, 40)]
        rows.append((d, " ".join(own[:20] + passage[a : a + n] + own[20:] + passage[: draw.integers(0, 30)])))
    rows += [(100, "la " * 200), (101, "la " * 30), (102, "a b " * 60), (103, " ".join(passage * 4))]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    check(frame)
    frame = spark.createDataFrame(rows + rows[3:6], "doc_id long, text string").repartition(3)
    texts = {r["doc_id"]: r["kept"] for r in substring_dedup.remove_repeats(frame, texts=True).collect()}
    assert len(texts) == len(rows)


def test_paths_compact_where_nothing_branches(spark):
    """A, B and C always follow each other; D follows C or stands alone; E follows itself; document 5 is there twice."""
    rows = [(1, 0, 3, "A"), (1, 3, 4, "B"), (1, 7, 2, "C"), (1, 9, 5, "D"), (2, 10, 3, "A"), (2, 13, 4, "B"), (2, 17, 2, "C"), (2, 30, 5, "D"), (3, 0, 1, "E"), (3, 1, 1, "E"), (3, 2, 1, "E")]
    rows += [(None, 4, 6, "F"), (None, 10, 6, "G"), (4, 0, 6, "F"), (4, 6, 6, "G"), (5, 0, 2, "H"), (5, 2, 2, "I"), (6, 0, 2, "H"), (6, 2, 2, "I")]
    count = Counter(r[3] for r in rows)
    occurrences = spark.createDataFrame([(d, s, n, ord(p), count[p]) for d, s, n, p in rows], "id long, start int, n int, path long, c long")
    docs = spark.createDataFrame([(d, "") for d in (1, 2, 3, 4, 5, 5, 6, None)], "id long, text string")
    got = sorted((str(r["id"]), r["start"], r["n"]) for r in substring_dedup.compacted(occurrences, docs).collect())
    assert got == sorted([("1", 0, 9), ("1", 9, 5), ("2", 10, 9), ("2", 30, 5), ("3", 0, 1), ("3", 1, 1), ("3", 2, 1), ("None", 4, 12), ("4", 0, 12), ("5", 0, 2), ("5", 2, 2), ("6", 0, 2), ("6", 2, 2)])


def test_long_passages_in_many_places(spark):
    draw = np.random.default_rng(7)
    long = [f"q{x}" for x in draw.integers(0, 9000, 900)]
    rows = [(d, " ".join([f"v{x}" for x in draw.integers(0, 9000, 30)] + long[a:b] + [f"u{x}" for x in draw.integers(0, 9000, 30)])) for d, (a, b) in enumerate([(0, 900), (0, 900), (100, 900), (0, 450), (440, 900), (0, 900)])]
    want = check(spark.createDataFrame(rows + [(None, " ".join(long[200:500])), (7, " ".join(long[::-1]))], "doc_id long, text string").repartition(3))
    assert sum(w[2] for w in want) == 300 + 900 + 800 + 450 + 460 + 900


def test_empty(no_docs):
    assert substring_dedup.remove_repeats(no_docs).count() == 0
