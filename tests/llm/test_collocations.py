"""Collocations against counts of every phrase, and the parts that large corpora need forced on small ones."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martlens.llm import collocations
from martlens.llm.queries import op12_collocations
from martlens.llm.statements import llm_statements
from tests.compare import differences, oracle_connection
from tests.conftest import SMALL
from tests.llm.data import CLASHES, DOCUMENTS, no_documents, odd_documents, odd_rows, prose


def plain_pieces(text: str | None) -> list[list[str]]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", piece) for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower)]


def plain_collocations(rows: list[tuple], least: int, best: int = 2000) -> list[tuple]:
    f: dict[str, Counter] = {}
    for text, lang in rows:
        own = f.setdefault("und" if lang is None else lang, Counter())
        for words in plain_pieces(text):
            for k in range(1, 5):
                own.update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        total = sum(n for p, n in counts.items() if len(p) == 1)
        candidates = {p: n for p, n in counts.items() if len(p) > 1 and n >= least}
        inside = Counter()
        for p, n in candidates.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    inside[p[i : i + size]] = max(inside[p[i : i + size]], n)
        rows_ = []
        for p, a in candidates.items():
            if 100 * inside[p] >= 80 * a:
                continue
            cuts = [(2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows_)[:best], start=1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total, -score))
    return sorted(out)


def rows_of(spark, docs, **kw):
    return sorted(tuple(r) for r in collocations.collocations(docs, **kw).collect())


@pytest.fixture(scope="module")
def varied(spark):
    rows = odd_rows()
    for i in range(250):
        text = f"the old {prose(i % 7, 12)}; in the\tOLD house. {prose(i % 23, 25)}\nthe old house of the old house"
        rows.append((100 + i, text, [None, "en", "de", "und"][i % 4], None, 0) + (None,) * CLASHES)
    return rows, spark.createDataFrame(rows, DOCUMENTS).repartition(4)


def test_against_all_phrases(spark, varied):
    rows, docs = varied
    expected = plain_collocations([(r[1], r[2]) for r in rows], 5)
    assert len(expected) > 100 and len({r[0] for r in expected}) >= 3
    assert rows_of(spark, docs, least=5) == expected
    assert rows_of(spark, docs, least=5, best=7) == plain_collocations([(r[1], r[2]) for r in rows], 5, 7)


@pytest.mark.parametrize(("ranks", "dense"), [(4, 1), (64, 10**9), (2**18, 1)])
def test_ranks_run_out_and_tiles_are_full(spark, varied, ranks, dense, monkeypatch):
    """With few ranks most phrases are told by the bitmap and counted as text."""
    rows, docs = varied
    monkeypatch.setattr(collocations, "RANKS", ranks)
    monkeypatch.setattr(collocations, "DENSE_CELLS", dense)
    frequent = collocations.frequent_words(docs, 5)
    assert (collocations.ranked(frequent, True).rest is not None) == (ranks < 2**18)
    assert rows_of(spark, docs, least=5) == plain_collocations([(r[1], r[2]) for r in rows], 5)


def test_tiles_count_cells(monkeypatch):
    monkeypatch.setattr(collocations, "BUFFER", 500)
    monkeypatch.setattr(collocations, "COORDINATES", 900)
    monkeypatch.setattr(collocations, "DENSE_CELLS", 60)
    draw = np.random.default_rng(3)
    tiles, seen, counted = collocations.Tiles(), Counter(), Counter()
    batches = []
    for _ in range(60):
        before = np.minimum(draw.zipf(1.3, 100), 200_000)
        cells = draw.integers(0, 3, 100) << collocations.LANG_SHIFT | before << collocations.RANK_BITS | draw.zipf(1.3, 100) % 5000
        seen.update(cells.tolist())
        batches += tiles.add(cells)
    batches += tiles.rest()
    for batch in batches:
        for cell, n in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
            counted[cell] += n
    assert counted == seen and tiles.dense and len(tiles.dense) <= collocations.DENSE_TILES


def test_long_pieces_are_cut_without_losing_a_phrase(monkeypatch):
    text = " ".join(["a b c d e"] * 90) + " " + "x" * 300 + ", " + "b c. " * 40
    batch = pa.RecordBatch.from_arrays([pa.array([text, None, text.upper()]), pa.array(["en"] * 3)], ["text", "lang"])
    words = collocations.Ranked({"en": [b"a", b"b", b"c", b"d", b"e"]})
    reader = collocations.Reader([words])
    expected = Counter()
    for plain in [p for t in (text, text.upper()) for p in plain_pieces(t)]:
        expected.update(zip(plain, plain[1:]))
    for size in (7, 50, 2_000_000):
        monkeypatch.setattr(collocations, "BLOCK_BYTES", size)
        found = Counter()
        for lang, block, carried in collocations.blocks(batch):
            cells, phrases = reader.count(lang, block, carried, 2)
            assert not phrases
            found.update(cells.tolist())
        side = 1 << collocations.RANK_BITS
        named = {("abcde"[c // side], "abcde"[c % side]): n for c, n in found.items()}
        assert named == {pair: n for pair, n in expected.items() if pair[0][0] != "x" and pair[1][0] != "x"}


def test_the_hash_is_the_one_of_the_engine(spark):
    from pyspark.sql import functions as F
    from xxhash import xxh64_intdigest

    phrases = ["a", "the old house", "é 日本", "x" * 100]
    found = spark.createDataFrame([(p,) for p in phrases], "p string").select("p", F.xxhash64("p").alias("h")).collect()
    assert all(r.h % 2**64 == xxh64_intdigest(r.p.encode(), 42) for r in found)


def test_the_bit_of_a_cell_is_the_one_of_the_engine(spark):
    from pyspark.sql import functions as F

    top = collocations.RANKS - 1
    cells = [lang << collocations.LANG_SHIFT | before << collocations.RANK_BITS | last
             for lang in (0, 3, 5000) for before in (0, 1, 77, top) for last in (0, 9, top)]
    frame = spark.createDataFrame([(c,) for c in cells], "c long").select("c", collocations.cell_bit(F.col("c")).alias("bit"))
    own = dict(zip(cells, collocations.cell_bit(np.array(cells)).tolist()))
    assert {r.c: r.bit for r in frame.collect()} == own
    words = collocations.bitmap(frame.where("c > 9").select("bit"))
    level = collocations.Ranked(rest_cells=words)
    marked = {own[c] for c in cells if c > 9}
    assert level.beyond_cells(np.array(cells)).tolist() == [own[c] in marked for c in cells]
    assert collocations.bitmap(frame.where("false").select("bit")) is None


def test_odd_and_no_documents(spark):
    expected = plain_collocations([(r[1], r[2]) for r in odd_rows()], 30)
    assert rows_of(spark, odd_documents(spark)) == expected
    assert rows_of(spark, no_documents(spark)) == []


def test_the_query(spark):
    connection = oracle_connection(SMALL)
    assert differences(op12_collocations(spark, SMALL), connection, llm_statements()["op12_collocations"]) == []
