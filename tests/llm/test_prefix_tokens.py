import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from hypothesis import given, settings, strategies as st  # noqa: E402

from cellscope.llm import prefix_tokens as pt  # noqa: E402
from tests.llm import cases  # noqa: E402

PATH = str(public_tokenizers.path("word_bpe_49k.json"))
LIBRARY = tokenizers.Tokenizer.from_file(PATH)
with open(PATH, encoding="utf-8") as f:
    COUNTER = pt.PrefixCounter(f.read())


def library(text: str) -> int:
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


def count(text: str) -> int:
    return pt.count_text(COUNTER, pt._Known(COUNTER), text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abcdefgh ABst'.,!?0189éßΣσ\t\n\x85 日本😀"),
                                  st.characters(max_codepoint=0x2FF)), max_size=60))
def test_counts_equal_the_library(text):
    assert count(text) == library(text)


@pytest.mark.parametrize("text", ["<|endoftext|>", "a<|startoftext|>b <|endoftext", "'s 'LL ''s don't", "x" * 3000,
                                  "İstanbul ΑΣΑΣ", "é é", "", "１２３ ½ ①"])
def test_special_cases(text):
    assert count(text) == library(text)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abcdeinorstéßü", min_size=1, max_size=25))
def test_every_prefix_of_a_word(word):
    assert COUNTER.word_prefixes(word) == [library(word[:i]) for i in range(1, len(word) + 1)]


def test_every_token_of_the_vocabulary_encodes_to_itself():
    for raw in list(COUNTER.final)[::17]:
        if raw.isascii() and raw.isalpha() and raw.islower():
            assert COUNTER.count_word(raw) == 1


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="abc dne.'", max_size=80), st.integers(0, 12))
def test_fitting_prefix_is_the_longest(text, budget):
    known = pt._Known(COUNTER)
    n = pt.fitting_chars(COUNTER, known, text, budget)
    assert library(text[:n]) <= budget
    if n < len(text):
        assert library(text[:n + 1]) > budget


def test_query_rows(spark):
    rows = [*cases.edge_texts(), (12, "river " * 2500)]
    got = pt.token_counts(cases.documents(spark, rows), PATH).collect()
    assert sorted((r.n_tokens, r.n_bytes) for r in got) == sorted(
        (library(t or ""), len((t or "").encode())) for _, t in rows)
    for r in got:
        assert r.over_limit == (r.n_tokens > 2048) and (r.fit_chars is not None) == r.over_limit
    assert pt.token_counts(cases.empty(spark), PATH).collect() == []
