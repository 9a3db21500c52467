"""The pipeline's stages against plain Python over the smallest tables."""

from collections import Counter

import corpus_pipeline
import sentencepiece
from rillmark.llm import mixing, queries, toxicity

from .test_mixing import targets
from .test_near_copies import components


def test_stages(spark, small):
    docs = queries.table(spark, small, "documents")
    before = {r["doc_id"]: r for r in docs.collect()}
    model = toxicity.fit_severity(docs, queries.table(spark, small, "labels"))
    clean = {i: r for i, r in before.items() if model.at_least(model.counts(r["text"]))[0] < 0.5}
    frames = {}
    for name, stage in corpus_pipeline.STAGES:
        frames[name] = docs = stage(spark, docs, small).cache()
        if name != "sentencepiece":
            assert docs.columns == queries.table(spark, small, "documents").columns
    rows = {name: f.collect() for name, f in frames.items()}
    ids = {name: Counter(r["doc_id"] for r in got) for name, got in rows.items()}
    assert 0 < len(clean) < len(before) and ids["toxicity"] == Counter(clean.keys())
    last = {r["text"]: i for i, r in sorted(clean.items())}
    assert ids["exact_dedup"] == Counter(last.values())
    left = sorted(last.values())
    roots = components([(i, clean[i]["text"]) for i in left])
    assert ids["simhash_near_dedup"] == Counter(set(roots))
    sizes, taken, largest = Counter(), Counter(), Counter()
    for i in set(roots):
        n = len(clean[i]["text"].split())
        sizes[clean[i]["source"]] += n
        taken[clean[i]["source"]] += n * ids["source_mixing"][i]
        largest[clean[i]["source"]] = max(n, largest[clean[i]["source"]])
    want = targets(sizes)
    assert max(ids["source_mixing"].values()) <= 3 and all(abs(taken[s] - want[s]) <= largest[s] for s in sizes)
    assert ids["sentencepiece"] == ids["source_mixing"]
    library = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path("piece_bpe_32k.model"))
    assert all(r["n_tokens"] == len(library.encode(clean[r["doc_id"]]["text"])) for r in rows["sentencepiece"])


def test_run_is_the_stages_in_order(spark, small):
    whole = corpus_pipeline.run(spark, small)
    assert whole.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "n_differing"] and whole.count() > 0
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash_near_dedup", "source_mixing", "sentencepiece"]
    assert mixing.ROUNDS >= 1


def test_odd_and_empty_tables(spark, odd_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(i, int(i == 14), 1) for i in range(15)] + [(None, 1, None), (3, None, 0)], "doc_id long, toxic int, quality int")
    for name, docs, taught in (("odd", odd_docs, labels), ("none", no_docs, labels), ("unlabelled", odd_docs, labels.limit(0))):
        docs.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        taught.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        found = corpus_pipeline.run(spark, f"{tmp_path}/{name}").collect()
        texts = {r["doc_id"]: r["text"] for r in docs.collect()}
        kept = {r["doc_id"] for r in found}
        assert kept <= texts.keys() and bool(kept) == bool(texts)
        assert all((texts[i] or "").split() for i in kept)  # the mix takes words
