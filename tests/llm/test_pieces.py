from __future__ import annotations

import hashlib
import random

import pytest
import sentencepiece

from martlens.llm import pieces
from martlens.llm.shared import model_path
from tests.conftest import SMALL
from tests.llm.data import no_documents, odd_documents, odd_rows, prose

LETTERS = ["a", "the", "é", " ", "  ", "\n", "\t", "▁", "😀", "日本", "ﬁ", " ", "\x00", "①", "ｱﾞ", "é", "</s>", "<0x41>", "Ａ"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=model_path(pieces.MODEL))


def odd_texts() -> list[str]:
    draw = random.Random(8)
    return ["".join(draw.choices(LETTERS, k=draw.randint(0, 14))) for _ in range(2000)] + [row[1] or "" for row in odd_rows()]


def test_ids_equal_the_library(library):
    own = pieces.encoder()
    for text in odd_texts():
        found, joined = own.encode(text)
        wanted = library.encode(text, add_eos=True)
        assert found.ids.tolist() == wanted, repr(text)
        assert joined == " ".join(map(str, wanted))


class Asked:
    """The library, and the texts it was asked to encode."""

    def __init__(self, pieces):
        self.pieces, self.texts = pieces, []

    def encode(self, text, **how):
        self.texts.append(text)
        return self.pieces.encode(text, **how)


def test_a_text_is_encoded_once_as_a_whole(monkeypatch):
    own = pieces.encoder()
    for text in ("the same word and the same word", " two  blanks ", "▁ a ▁", prose(3, 5000)):
        asked = Asked(own.pieces)
        monkeypatch.setattr(own, "pieces", asked)
        own.encode(text)
        own.encode(text)
        monkeypatch.undo()
        assert asked.texts == ["▁" + text.replace(" ", "▁")] * 2


@pytest.mark.parametrize("block", [1, 2, 7])
def test_blocks_of_long_texts_change_nothing(monkeypatch, block):
    own = pieces.encoder()
    whole = {text: own.encode(text) for text in odd_texts()}
    monkeypatch.setattr(pieces, "BLOCK", block)
    for text, (found, joined) in whole.items():
        again, shown = own.encode(text)
        assert shown == joined, repr(text)
        for field in ("ids", "begins", "ends"):
            assert getattr(again, field).tolist() == getattr(found, field).tolist(), repr(text)


def test_blocks_are_bounded_and_start_with_blanks():
    own = pieces.encoder()
    normal = "▁" + prose(4, 40_000).replace(" ", "▁▁")
    blocks = list(own._blocks(normal))
    assert "".join(blocks) == normal and len(blocks) > 1
    assert all(len(block) < pieces.BLOCK + 100 for block in blocks)
    assert all(block[:2] == "▁▁" and block[-1] != "▁" for block in blocks[1:])
    assert list(own._blocks("")) == []


def test_spans_cover_the_text_and_hold_the_pieces(library):
    own = pieces.encoder()
    for text in odd_texts():
        found, _ = own.encode(text)
        raw = text.encode()
        assert found.ends[-1] == found.begins[-1] == len(raw)
        if len(found.ids) == 1:
            continue
        assert found.begins[0] == 0 and (found.begins[1:] == found.ends[:-1]).all()
        for i, (begin, end) in enumerate(zip(found.begins[:-1], found.ends[:-1])):
            piece = library.id_to_piece(int(found.ids[i]))
            shown = bytes([int(piece[3:5], 16)]) if library.is_byte(int(found.ids[i])) else piece.replace("▁", " ").encode()
            part = raw[begin:end].replace("▁".encode(), b" ")
            assert part == (shown[1:] if i == 0 and len(part) < len(shown) else shown), (repr(text), i)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normalisation_equals_the_library(rule):
    from sentencepiece import sentencepiece_model_pb2

    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(theirs.serialized_model_proto())
    spec = proto.normalizer_spec
    own = pieces.Normalizer(
        pieces.CharacterMap(spec.precompiled_charsmap),
        spec.add_dummy_prefix,
        spec.remove_extra_whitespaces,
        spec.escape_whitespaces,
    )
    for text in odd_texts()[:600]:
        if "\x00" in text:
            continue
        normal, places = own.normalize(text)
        wanted, offsets = theirs.normalize(text, with_offsets=True)
        assert normal.decode() == wanted, repr(text)
        # The library counts code points of both sides.
        starts = [i for i, byte in enumerate(normal) if byte & 0xC0 != 0x80] + [len(normal)]
        assert [len(text.encode()[: places[i]].decode()) for i in starts] == list(offsets), repr(text)


def test_odd_documents(spark, library):
    wanted = {}
    for row in odd_rows():
        ids = library.encode(row[1] or "", add_eos=True)
        digests = (hashlib.sha256(" ".join(map(str, ids)).encode()), hashlib.sha256(library.decode(ids).encode()))
        wanted.setdefault(row[0], []).append((len(ids), *[d.hexdigest() for d in digests]))
    found = pieces.encode_digests(odd_documents(spark), with_ids=True).collect()
    assert len(found) == len(odd_rows())
    for row in found:
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) in wanted[row.doc_id]
        assert len(row.ids) == row.n_tokens


def test_given_documents(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    rows = pieces.encode(spark.read.parquet(f"{SMALL}/documents.parquet")).collect()
    assert len(rows) == len(texts)
    for row in rows:
        assert row.ids == library.encode(texts[row.doc_id], add_eos=True)
        assert row.ends[-1] == len(texts[row.doc_id].encode())


def test_no_documents(spark):
    assert pieces.encode_digests(no_documents(spark)).collect() == []
