import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from quillspark.llm.token_counts import PrefixCounter, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
COUNTER = PrefixCounter(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def library(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


ODD = ["", " ", "  ", "a  b", "a   b", "x \n y", "it's we'll 'r 's", "\n\n a", " a\n", "é ñ 漢字 🙂🙂", "<|endoftext|>", "a <|endoftext|> b", "a  <|endoftext|>", "1234 5678", "a  b c", "\x1c a\x1f b\x85 c", "foo!!! bar's", "...\t...", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "<|endof"]


@pytest.mark.parametrize("text", ODD)
def test_every_prefix_of_odd_texts(text):
    for i in range(len(text) + 1):
        assert COUNTER.count_at(text, i) == library(text[:i]), (text, i)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*"abcdetsTHE'   \n\t.!#19éß漢", "the", " and", "'ll", "ing", " <|endoftext|>", " "]), max_size=30).map("".join))
def test_every_prefix_and_budget_like_the_library(text):
    want = [library(text[:i]) for i in range(len(text) + 1)]
    assert [COUNTER.count_at(text, i) for i in range(len(text) + 1)] == want
    for budget in (0, 1, 3, 7):
        assert COUNTER.longest_within(text, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_rows(spark):
    rows = [(1, "the cat", 5), (None, "x", 1), (2, None, 2), (3, "", 2), (4, "word " * 3000, 1), (1, "the cat", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens long")
    got = token_counts(df, PATH).collect()
    assert len(got) == 6
    for r in got:
        text = next(t for i, t, _ in rows if i == r.doc_id) or ""
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), library(text), library(text) > 1024)
        assert library(text[: r.cut_chars]) <= 1024
    assert token_counts(df.limit(0), PATH).collect() == []
