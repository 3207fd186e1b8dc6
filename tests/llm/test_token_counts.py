from __future__ import annotations

import json

import public_tokenizers
from tokenizers import Tokenizer

from martlens.llm import token_counts
from tests.conftest import SMALL
from tests.llm.data import no_documents, odd_documents, odd_rows


def lengths_of(texts) -> list[int]:
    """By another library, which reads the same vocabulary from another file; its special tokens are ordinary text here."""
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file:
        tokenizer = Tokenizer.from_str(json.dumps(json.load(file) | {"added_tokens": []}))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return [len(tokenizer.encode(text, add_special_tokens=False).ids) if text else 0 for text in texts]


def check(frame, texts) -> None:
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(frame))
    table = token_counts.limit_table(histogram)
    lengths = lengths_of(texts)
    rows = sorted(table.collect())
    assert [r.n_tokens for r in rows] == sorted(set(lengths))
    for r in rows:
        within = [n for n in lengths if n <= r.n_tokens]
        assert r.n_docs == lengths.count(r.n_tokens)
        assert (r.docs_within, r.tokens_within) == (len(within), sum(within))
        assert (r.docs_beyond, r.tokens_beyond) == (len(lengths) - len(within), sum(lengths) - sum(within))
        assert r.truncated_tokens == sum(min(n, r.n_tokens) for n in lengths)
        assert r.share_within == len(within) / len(lengths)
    for r in token_counts.answers(table, [0, 7, 2048, 10**9]).collect():
        assert r.docs_within == sum(n <= r.context_limit for n in lengths)
        assert (r.docs, r.tokens) == (len(lengths), sum(lengths))
        assert r.truncated_tokens == sum(min(n, r.context_limit) for n in lengths)
    for r in token_counts.quantiles(table, [0.01, 0.5, 1.0]).collect():
        assert sum(n <= r.n_tokens for n in lengths) >= r.share * len(lengths)
        assert sum(n < r.n_tokens for n in lengths) < r.share * len(lengths)


def test_odd_documents(spark):
    check(odd_documents(spark), [row[1] for row in odd_rows()])


def test_given_documents(spark):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(frame, [r.text for r in frame.select("text").collect()])


def test_no_documents(spark):
    histogram = token_counts.length_histogram(token_counts.encoded_lengths(no_documents(spark)))
    table = token_counts.limit_table(histogram)
    assert table.collect() == []
    (answer,) = token_counts.answers(table, [8]).collect()
    assert (answer.docs, answer.tokens, answer.truncated_tokens) == (0, 0, 0)


def test_each_text_is_encoded_once(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    table = token_counts.limit_table(token_counts.length_histogram(token_counts.encoded_lengths(documents)))
    assert "MapInArrow" not in table._jdf.queryExecution().executedPlan().toString()
