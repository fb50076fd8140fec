import pytest
from hypothesis import given, settings, strategies as st

from dotledger.llm import bpe
from tests.conftest import rows

tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def encoder():
    try:
        with open(bpe.VOCABULARY, "rb") as f:
            return bpe.Encoder(f.read())
    except FileNotFoundError:
        pytest.skip("no vocabulary here")


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=bpe.PATTERN, mergeable_ranks=encoder.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from(" \n\t 'abcdeABé漢字ก1 2.,-"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_equal_to_reference(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["", "a" * 1000, "漢字" * 600, " " * 300, "x\n \n b", "<|endoftext|>", "don't we'll", "word " * 3000])
def test_long_and_odd(encoder, reference, text):
    assert encoder.encode(text) == reference.encode_ordinary(text)


def test_round_trip_of_a_corpus(spark, encoder):
    texts = [(1, "Über 5 µm\n\n漢字"), (2, ""), (3, None), (3, None), (4, "a b")]
    df = spark.createDataFrame([(k, t, "x") for k, t in texts], "doc_id bigint, text string, ids string")
    got = rows(bpe.encode_corpus(df, "doc_id", "text"))
    back = {v: k for k, v in encoder.ranks.items()}
    assert sorted((k, b"".join(back[i] for i in ids).decode()) for k, ids in got) == sorted((k, t or "") for k, t in texts)
    assert bpe.encode_corpus(df.limit(0), "doc_id", "text").count() == 0
