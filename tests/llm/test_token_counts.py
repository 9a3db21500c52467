import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rillmark.llm import token_counts
from rillmark.llm.queries import tokenizer_path

PATH, PATTERN = tokenizer_path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def by_hand(text, rule):
    """Counts per line from each token's bytes, one by one."""
    encoding, _ = token_counts.encoder(PATH, PATTERN)
    line_of, line = [], 0
    for c in text:
        line_of.append(line)
        line += c == "\n"
    n = (line_of[-1] if line_of else 0) + 1
    out, at = [0.0] * n, 0
    owner = [i for i, c in enumerate(text) for _ in c.encode()]
    for token in encoding.encode_ordinary(text):
        size = len(encoding.decode_single_token_bytes(token))
        chars = range(owner[at], owner[at + size - 1] + 1)
        at += size
        if rule == "split":
            for c in chars:
                out[line_of[c]] += 1 / len(chars)
        else:
            out[line_of[chars[0 if rule == "start" else -1]]] += 1
    return out


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_against_bytes(docs, odd_docs, rule):
    for frame in (docs.limit(60), odd_docs):
        texts = {str(r["doc_id"]): r["text"] or "" for r in frame.collect()}
        found = {}
        for r in token_counts.section_tokens(frame.dropDuplicates(["doc_id"]), PATH, PATTERN, rule=rule).collect():
            found.setdefault(str(r["doc_id"]), {})[r["section"]] = r
        assert found.keys() == texts.keys()
        for doc_id, sections in found.items():
            rows = [sections[i] for i in range(len(sections))]
            assert "".join(texts[doc_id][r["char_start"] : r["char_end"]] for r in rows) == texts[doc_id]
            assert [r["n_tokens"] for r in rows] == pytest.approx(by_hand(texts[doc_id], rule))
            assert sum(r["n_tokens"] for r in rows) == pytest.approx(rows[0]["doc_tokens"])


def test_crossing_tokens_are_allocated():
    starts, ends, bounds = np.array([0, 2, 5]), np.array([2, 5, 6]), np.array([0, 3, 4, 6])
    assert token_counts.attribute(starts, ends, bounds)[0].tolist() == [2, 0, 1]
    assert token_counts.attribute(starts, ends, bounds, "end")[0].tolist() == [1, 0, 2]
    counts, crossing = token_counts.attribute(starts, ends, bounds, "split")
    assert counts == pytest.approx([1 + 1 / 3, 1 / 3, 1 + 1 / 3]) and crossing.tolist() == [1, 0, 0]


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from(" \n\t\x85\u3000\x1c'ta1.é日"), max_size=40))
def test_long_white_space_is_cut_where_the_pattern_cuts(text):
    encoding, _ = token_counts.encoder(PATH, PATTERN)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(token_counts, "LONG_RUN", 2)
        assert token_counts.tokens_of(encoding, text, PATTERN).tolist() == encoding.encode_ordinary(text)


@pytest.mark.parametrize("mark, after", [(" ", ""), (" ", "word"), ("\n", "word"), (" \t", ".")])
def test_two_million_white_spaces(mark, after):
    encoding, _ = token_counts.encoder(PATH, PATTERN)
    made = [f"start{mark * (n // len(mark))}{after}" for n in (200_000, 2_000_000)]
    counts = []
    for text in made:
        starts, ends = token_counts.token_spans(text, PATH, PATTERN)
        assert starts[0] == 0 and ends[-1] == len(text) and np.array_equal(starts[1:], ends[:-1])
        counts.append(len(starts))
    assert counts[0] == len(encoding.encode_ordinary(made[0])) and 9 * counts[0] < counts[1] < 11 * counts[0]


def test_empty(no_docs):
    assert token_counts.section_tokens(no_docs, PATH, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_tokens(no_docs, PATH, PATTERN, rule="half")
