"""Chunk reuse against the library, which encodes whole texts."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martlens.llm import bpe_chunks
from martlens.llm.queries import op11_bpe_chunks
from martlens.llm.shared import code_points, model_path
from tests.conftest import SMALL
from tests.llm.data import CLASHES, DOCUMENTS, no_documents, odd_documents, odd_rows, prose


OWN = bpe_chunks.Encoder()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(model_path(bpe_chunks.MODEL))


def awkward(seed: int, size: int) -> str:
    """Blanks, apostrophes, long runs, marks and letters of many scripts, and pieces of the end token."""
    draw = random.Random(seed)
    parts = [" ", "  ", "\n", "\t \n", "'", "'r", "e", "'ll", "'s", "a" * 70, "1" * 20, "!?", "é", "日本", "😀", " "]
    parts += ["<|endof", "text|>", "<|endoftext|>", "͸", "࢏", "x y", "Ġ", "‍", "ﬁ"]
    return "".join(draw.choice(parts) for _ in range(size))


@pytest.mark.parametrize("seed", range(12))
def test_ids_are_those_of_the_whole_text(library, seed, monkeypatch):
    monkeypatch.setattr(bpe_chunks, "LEAST", 1 + seed % 5)
    monkeypatch.setattr(bpe_chunks, "MOST", 7 + 20 * seed)
    monkeypatch.setattr(bpe_chunks, "AVERAGE_BITS", 1 + seed % 4)
    own = bpe_chunks.Encoder()
    crossed = 0
    for size in (0, 1, 2, 5, 30, 200, 700):
        for text in (awkward(seed * 100 + size, size), prose(seed, size)):
            ids, chunks, through = own.encode(text)
            assert ids == library.encode(text, add_special_tokens=False).ids
            assert own.decode(ids) == library.decode(ids, skip_special_tokens=False)
            crossed += through
    assert crossed > 0


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=300))
def test_any_text(text):
    least, most = bpe_chunks.LEAST, bpe_chunks.MOST
    bpe_chunks.LEAST, bpe_chunks.MOST = 1, 3
    try:
        OWN.chunks.clear()
        assert OWN.encode(text)[0] == OWN.library.encode(text, add_special_tokens=False).ids
    finally:
        bpe_chunks.LEAST, bpe_chunks.MOST = least, most


def test_cuts_follow_the_content():
    text = prose(3, 3000)
    ends = bpe_chunks.cuts(code_points(text))
    assert ends[-1] == len(text) and all(b - a <= bpe_chunks.MOST for a, b in zip([0, *ends], ends))
    assert all(b - a >= bpe_chunks.LEAST for a, b in zip([0, *ends], ends[:-1]))
    shifted = "something before it, " + text
    moved = {e - 21 for e in bpe_chunks.cuts(code_points(shifted))}
    assert len(moved.intersection(ends)) >= len(ends) - 3
    assert bpe_chunks.cuts(code_points("")) == [] and bpe_chunks.cuts(code_points("a" * 9000))[-1] == 9000


def test_shared_chunks_are_found_once_and_used(spark):
    passage = prose(8, 900)
    rows = [(i, prose(50 + i, 60) + passage, None, None, 0) + (None,) * CLASHES for i in range(30)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(6)
    sent = bpe_chunks.shared_chunks(docs)
    assert sent and all(chunk in passage for chunk in sent)
    assert len("".join(sent)) > 0.7 * len(passage)
    few = bpe_chunks.shared_chunks(docs, most=2)
    assert len(few) == 2 and set(few) <= set(sent)
    ids = {r.doc_id: r.ids for r in bpe_chunks.encode(docs, most=2).collect()}
    assert ids == {r.doc_id: r.ids for r in bpe_chunks.encode(docs).collect()}
    own = bpe_chunks.Encoder()
    assert all(ids[row[0]] == own.library.encode(row[1], add_special_tokens=False).ids for row in rows)


def expected(library, rows) -> list[tuple]:
    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), sha(",".join(map(str, ids))), sha(decoded)))
    return sorted(out, key=repr)


def test_odd_and_no_documents(spark, library):
    found = bpe_chunks.encode_digests(odd_documents(spark)).collect()
    assert sorted([tuple(r)[:4] for r in found], key=repr) == expected(library, [row[:2] for row in odd_rows()])
    assert bpe_chunks.encode_digests(no_documents(spark)).collect() == []
    assert bpe_chunks.encode(no_documents(spark)).collect() == []


def test_the_query(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    found = op11_bpe_chunks(spark, SMALL)
    assert found.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted([tuple(r)[:4] for r in found.collect()], key=repr) == expected(library, rows)


def test_cuts_leave_their_input_and_keys_are_signed_64_bit_numbers():
    import xxhash

    codes = np.frombuffer(("many words, " * 900).encode("utf-32-le"), dtype="<u4")
    before = codes.copy()
    assert bpe_chunks.cuts(codes)[-1] == len(codes) and (codes == before).all()
    for chunk in ("", "a", "é 😀", *map(str, range(50))):
        assert np.uint64(xxhash.xxh3_64_intdigest(chunk)).view(np.int64) == bpe_chunks.chunk_key(chunk)


def test_frequent_units_are_asked_once_in_bounded_memory(library, monkeypatch):
    monkeypatch.setattr(bpe_chunks, "CACHED_WORDS", 200)
    own, asked = bpe_chunks.Encoder(), []
    packed = own.packed
    monkeypatch.setattr(own, "packed", lambda text: asked.extend(text.split()) or packed(text))
    for i in range(60):
        text = "first frequent words " + " ".join(f"rare{i}x{j}" for j in range(20)) + " y" * (i % 3) + " long" * 20 + "z" * 80
        assert own.encode(text)[0] == library.encode(text, add_special_tokens=False).ids
        assert len(own.ids_of) + len(own.older) <= 200 + 30
    assert asked.count("frequent") == 1 and asked.count("words") == 1 and asked.count("rare0x3") == 1
    assert all(len(unit) <= bpe_chunks.CACHED_LENGTH for unit in [*own.ids_of, *own.older])


def test_a_worker_keeps_its_encoder_but_not_what_was_sent(library):
    first = bpe_chunks.encoder(bpe_chunks.MODEL, {"some chunk": (4, 4, b"")})
    assert first.sent
    again = bpe_chunks.encoder(bpe_chunks.MODEL)
    assert again is first and not again.sent
    text = prose(5, 2000)
    assert [again.encode(text)[0] for _ in range(2)] == [library.encode(text, add_special_tokens=False).ids] * 2
