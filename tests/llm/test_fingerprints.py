from __future__ import annotations

import hashlib
import random

import numpy as np

from martlens.llm import fingerprints
from martlens.llm.shared import code_points
from tests.llm.data import no_documents, odd_documents, odd_rows, prose


def plain_winnow(text: str, gram: int, window: int) -> list[tuple[int, int]]:
    """Every window looked at on its own."""
    codes = code_points(text)
    if not len(codes):
        return []
    gram = min(gram, len(codes))
    hashes = [int(fingerprints.gram_hashes(codes[i : i + gram], gram)[0]) >> 32 for i in range(len(codes) - gram + 1)]
    window, kept = min(window, len(hashes)), []
    for begin in range(len(hashes) - window + 1):
        part = hashes[begin : begin + window]
        place = begin + max(i for i, value in enumerate(part) if value == min(part))
        if not kept or kept[-1] != (hashes[place], place):
            kept.append((hashes[place], place))
    return kept


def test_winnowing_equals_looking_at_every_window():
    draw = random.Random(5)
    for _ in range(150):
        text = "".join(draw.choices("abé😀", k=draw.randint(0, 60)))
        gram, window = draw.randint(1, 9), draw.randint(1, 9)
        found = fingerprints.as_entries(fingerprints.as_text(fingerprints.winnow(code_points(text), gram, window)))
        assert found == plain_winnow(text, gram, window), (text, gram, window)


def test_ties_take_the_rightmost():
    entries = fingerprints.as_entries(fingerprints.as_text(fingerprints.winnow(code_points("a" * 20), 4, 5)))
    assert [place for _, place in entries] == list(range(4, 17))


def test_a_shared_passage_is_always_found():
    passage = prose(9, 40)[: fingerprints.GRAM + fingerprints.WINDOW - 1]
    for seed in range(20):
        left = fingerprints.winnow(code_points(prose(seed, 200) + passage + prose(seed + 50, 30)))
        right = fingerprints.winnow(code_points(prose(seed + 100, 77) + passage + prose(seed + 150, 90)))
        assert len(np.intersect1d(left >> np.uint64(32), right >> np.uint64(32)))


def plain_comparison(rows: list[tuple]) -> list[tuple]:
    def order(row):
        return (row[0] is None, -(row[0] or 0), row[1] is not None, row[1] or "")

    rows = sorted(rows, key=order)
    out = []
    for i, row in enumerate(rows):
        text, following = row[1] or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, changed, other = (fingerprints.winnow(code_points(t)) for t in (text, edited, following))
        out.append(
            (
                row[0],
                len(text),
                hashlib.sha256(edited.encode()).hexdigest(),
                fingerprints.as_text(own),
                fingerprints.as_text(changed),
                fingerprints.likeness(own, changed),
                fingerprints.likeness(own, other),
            )
        )
    return out


def test_comparison_with_edits(spark):
    def key(row):
        return (row[0] is None, row[0] or 0, row[2])

    expected = sorted(plain_comparison(odd_rows()), key=key)
    found = sorted((tuple(r) for r in fingerprints.compare_with_edits(odd_documents(spark)).collect()), key=key)
    assert found == expected


def test_comparison_over_many_ranges(spark, settings):
    settings(shuffle__partitions="7")
    rows = [(i * i, prose(i % 40, 5 + i % 9)) for i in range(200)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = sorted(tuple(r) for r in fingerprints.compare_with_edits(frame).collect())
    assert found == sorted(plain_comparison(rows))


def test_small_tables(spark):
    assert fingerprints.compare_with_edits(no_documents(spark)).collect() == []
    (row,) = fingerprints.compare_with_edits(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).collect()
    assert row.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and row.near_next == 1.0
    only = spark.createDataFrame([(None, "ab"), (None, None)], "doc_id long, text string")
    assert fingerprints.compare_with_edits(only).count() == 2
    prints = {r.fingerprint for r in fingerprints.fingerprints(only).collect()}
    assert "" in prints and len(prints) == 2
