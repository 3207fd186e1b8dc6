from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest

from martlens.llm import token_output
from martlens.llm.shared import model_path
from tests.conftest import SMALL
from tests.llm.data import no_documents, odd_documents, odd_rows


@pytest.fixture(scope="module")
def tokenizer():
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(model_path(token_output.MODEL))


def test_wavelet_matrix_equals_plain_search():
    draw = np.random.default_rng(4)
    for length, top in [(0, 1), (1, 1), (7, 2), (5000, 9), (20_000, 50_000), (9000, 70_000)]:
        values = draw.integers(0, top, length).astype(np.uint32)
        matrix = token_output.WaveletMatrix.of(values)
        assert (matrix.values() == values).all()
        for place in draw.integers(0, max(1, length), min(length, 20)):
            assert matrix.access(int(place)) == values[place]
        for value in [*draw.integers(0, top + 2, 10).tolist(), 1 << 40]:
            places = np.flatnonzero(values == value)
            end = int(draw.integers(0, length + 1))
            assert matrix.count(value) == len(places) and matrix.count(value, end) == (places < end).sum()
            for number in {0, len(places) // 2, len(places) - 1, len(places)} - {-1}:
                wanted = places[number] if number < len(places) else None
                assert matrix.locate(value, number) == wanted


def test_shard_files_keep_everything():
    ids = np.array([5, 2, 2, 70_000, 2], dtype=np.uint32)
    doc_ids, counts, matrix = token_output.read_shard(token_output.write_shard([-3, None, 9], [2, 1, 2], ids))
    assert (doc_ids, counts, matrix.values().tolist()) == ([-3, None, 9], [2, 1, 2], ids.tolist())
    with pytest.raises(ValueError):
        token_output.read_shard(b"something else")


def test_chunks_encode_as_whole_texts(tokenizer):
    encode = token_output.encoder(token_output.MODEL).encode
    draw = random.Random(6)
    letters = ["a", "B", "é", "ß", "İ", "Σ", "'", "'s", "'LL", " ", "\n", "\t", " ", "\x1c", " ", "1", "٣", "!", "#", "日"]
    letters += ["é", "́", "<|endoftext|>", "<|EndOfText|>", "<|", "😀", "ǅ", "ﬁ", "½", "\u0085", "\x00", "Ω", "K"]
    texts = ["".join(draw.choices(letters, k=draw.randint(0, 25))) for _ in range(3000)]
    for text in [*texts, *[row[1] or "" for row in odd_rows()]]:
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == wanted, repr(text)


def test_capitals_whose_lower_case_lies_elsewhere(tokenizer):
    encode = token_output.encoder(token_output.MODEL).encode
    for text in ["\u023a \u023e日", "x\u023ab, \u023e. Ab, ab aB"]:
        wanted = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encode(text), dtype="<u4").tolist() == wanted, text


def test_a_word_is_spelled_once_whatever_stands_behind_it(monkeypatch):
    own = token_output.TextEncoder(token_output.MODEL)
    asked = []
    monkeypatch.setattr(own, "tokens", lambda word, tokens=own.tokens: asked.append(word) or tokens(word))
    own.encode("Word word, word. Word! WORD日 zzz")
    assert asked.count("word") == 1 and len(own.chunks) < 10 and "word" not in own.pieces


def test_reading_back_makes_no_tables_for_lookups():
    file = token_output.write_shard([1], [3], np.array([5, 70_000, 2], dtype=np.uint32))
    matrix = token_output.read_shard(file)[2]
    assert matrix.values().tolist() == [5, 70_000, 2] and "ones_before" not in vars(matrix)


def check(frame, rows, tokenizer, settings) -> None:
    settings(shuffle__partitions="5")
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    expected, start = [], 0
    for row in rows:
        ids = [*tokenizer.encode(row[1] or "", add_special_tokens=False).ids, 2]
        expected.append((row[0], start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    found = token_output.encode_and_read(frame).collect()
    assert sorted(map(tuple, found), key=lambda r: r[1]) == expected
    small = token_output.write_shards(frame, shard_tokens=700).cache()
    assert small.count() > 5
    assert sorted(map(tuple, token_output.read_documents(small).collect()), key=lambda r: r[1]) == expected
    small.unpersist()


def test_odd_documents(spark, tokenizer, settings):
    check(odd_documents(spark), odd_rows(), tokenizer, settings)


def test_given_documents(spark, tokenizer, settings):
    frame = spark.read.parquet(f"{SMALL}/documents.parquet")
    check(frame, [(r.doc_id, r.text) for r in frame.collect()], tokenizer, settings)


def test_no_documents(spark):
    assert token_output.encode_and_read(no_documents(spark)).collect() == []
