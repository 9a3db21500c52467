import hashlib

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from rillmark.llm import sentencepiece_bpe
from rillmark.llm.queries import tokenizer_path

PATH = tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n▁ab the\t"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(text):
    model = sentencepiece_bpe.agenda(PATH)
    want = model.library.encode(text)
    [(ids, decoded, differing)] = model.encode([text])
    assert not differing and ids == ",".join(map(str, want))
    assert decoded == model.library.decode(want) == model.decode(ids)


def test_heap_and_rounds_agree(docs):
    model = sentencepiece_bpe.agenda(PATH)
    words = sorted({w for r in docs.limit(40).collect() for w in r["text"].split()})
    assert model.encode_short(words) == [model.encode_heap(w) for w in words]


def test_whole_table(docs, odd_docs, no_docs, library):
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for frame in (docs, odd_docs):
        want = []
        for r in frame.collect():
            ids = library.encode(r["text"] or "")
            want.append((str(r["doc_id"]), len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids)), 0))
        got = sentencepiece_bpe.encode_texts(frame, PATH).collect()
        assert sorted((str(r["doc_id"]), *tuple(r)[1:]) for r in got) == sorted(want)
    rows = sentencepiece_bpe.encode_texts(odd_docs, PATH, outputs=True).where("doc_id = 12").collect()
    assert rows[0]["decoded"] == "x" * 30_000 and len(rows[0]["ids"]) == rows[0]["n_tokens"]
    assert sentencepiece_bpe.encode_texts(no_docs, PATH).count() == 0


def test_full_cache_changes_nothing(docs, library, monkeypatch):
    monkeypatch.setattr(sentencepiece_bpe, "CACHE_BYTES", 500 * sentencepiece_bpe.ENTRY_BYTES)
    model = sentencepiece_bpe.Agenda(PATH)
    for r in docs.limit(30).collect():
        ids = library.encode(r["text"])
        assert model.encode([r["text"]]) == [(",".join(map(str, ids)), library.decode(ids), 0)]
    model.forget()
    assert not model.cache


def test_where_the_agenda_differs_the_library_holds(library, monkeypatch):
    model = sentencepiece_bpe.Agenda(PATH)
    monkeypatch.setattr(model, "encode_short", lambda segments: [[model.symbol(c) for c in s] for s in segments])
    text = "some words and some others"
    ids = library.encode(text)
    assert model.encode([text]) == [(",".join(map(str, ids)), text, 5)]
