import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from rillmark.llm import exact_dedup


def expected(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[r["text"] or ""].append(r["doc_id"])
    low = lambda i: (i is not None, i or 0)
    return {(r["doc_id"], r["text"] or ""): (max(groups[r["text"] or ""], key=low), len(groups[r["text"] or ""])) for r in rows}


def check(frame, **options):
    rows = frame.select("doc_id", "text").collect()
    want = expected(rows)
    got = exact_dedup.exact_duplicates(frame, **options).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): t for _, t in want}
    assert sum(g["kept"] for g in got) == len({t for _, t in want})
    for g in got:
        assert (g["keep_id"], g["group_size"]) == want[g["doc_id"], by_digest[g["text_sha256"]]]


def test_against_plain_python(docs, odd_docs):
    check(docs)
    check(odd_docs)


def test_chunks_that_share_an_identifier_are_told_apart(docs, odd_docs):
    for frame in (docs, odd_docs):
        check(frame, identifier=lambda c: F.length(c).cast("long"))


def test_chunks_join_to_the_text(docs, odd_docs):
    for frame in (docs, odd_docs):
        joined = frame.select(F.coalesce("text", F.lit("")).alias("t"), F.array_join(exact_dedup.chunks_of(F.col("text")), "").alias("j"))
        assert joined.where("t <> j").count() == 0


def test_drop_keeps_columns_and_one_row_of_each_text(odd_docs, no_docs):
    kept = exact_dedup.drop_exact_duplicates(odd_docs)
    assert kept.columns == odd_docs.columns
    rows = kept.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    want = expected(odd_docs.collect())
    assert sorted(r["text"] for r in rows) == sorted({t for _, t in want})
    assert all(want[r["doc_id"], r["text"]][0] == r["doc_id"] for r in rows)
    assert exact_dedup.exact_duplicates(no_docs).count() == exact_dedup.drop_exact_duplicates(no_docs).count() == 0
