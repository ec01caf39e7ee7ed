"""Counts against the tokenizers library, with chunks of every size."""

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rolehabit.llm.token_counts import count_in_chunks, count_tokens, encoder

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def expected(text):
    return len(LIBRARY.encode(text, add_special_tokens=False).ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab é.,'s19 \n\t<|endoftext>漢。", max_size=300), st.integers(1, 40), st.integers(1, 20))
def test_chunks_give_the_count_of_the_whole(text, chunk, overlap):
    assert count_in_chunks(text, encoder(), chunk, overlap) == expected(text)


@pytest.mark.parametrize("text", ["x" * 5000, " " * 5000, "漢字" * 3000, "a<|endoftext|>b " * 400, "don't stop. " * 900])
def test_overlap_widens_where_nothing_is_stable(text):
    assert count_in_chunks(text, encoder(), 1000, 4) == expected(text)


def test_white_space_beyond_the_stack_of_the_pattern():
    text = " " * 2_000_000 + "a"
    assert len(encoder().ids(text)) == count_in_chunks(text, encoder()) == expected(text)


def test_table(spark):
    texts = [None, "", "one two", "word " * 20_000, "<|endoftext|>", "one two"]
    rows = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)] + [(None, "x", 1)], "doc_id long, text string, n_tokens int")
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(rows).collect()}
    for i, t in enumerate(texts):
        n = expected(t or "")
        assert got[i] == (len((t or "").encode()), n, n > 1024)
    assert None in got
    assert count_tokens(rows.limit(0)).collect() == []


def test_query_counts_every_document(spark, sf_dir):
    from rolehabit.llm.common import QUERIES

    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op2_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {k: expected(t or "") for k, t in docs.items()}
