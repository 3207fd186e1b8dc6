"""Ranked search against scores worked out for every document and item."""

from __future__ import annotations

import math
import re
from collections import Counter

import numpy as np
import pytest

from martlens.llm import ranked_search
from martlens.llm.queries import op13_ranked_search
from tests.conftest import SMALL
from tests.llm.data import CLASHES, DOCUMENTS, no_documents, odd_documents, odd_rows, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def plain_terms(text: str | None) -> list[str]:
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(documents: list[tuple], items: list[tuple]) -> list[tuple]:
    found = [(doc_id, Counter(plain_terms(text))) for doc_id, text in documents]
    sizes = [sum(c.values()) for _, c in found]
    holding = Counter(term for _, counts in found for term in counts)
    n_docs, length = sum(s > 0 for s in sizes), sum(sizes)
    out = []
    for item_id, text in items:
        asked, scores = plain_terms(text), []
        for (doc_id, counts), size in zip(found, sizes):
            score = 0
            if size:
                m = 100 - 25 + 25 * size * n_docs // length
                for term in asked:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding[term] + 1)))
                    score += w * ((1000000000 * counts[term]) // (1000 * counts[term] + 12 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        best = sorted(scores, key=lambda s: s[:3])[:20]
        out += [(item_id, rank, doc_id, -score) for rank, (score, _, _, doc_id) in enumerate(best, start=1)]
    return sorted(out, key=repr)


def asked(spark, items):
    return spark.createDataFrame(items, "item_id long, text string, doc_id long, item string")


ITEMS = [
    (1, "the the or an éti Verqu", 0, ""),
    (2, None, 0, ""),
    (2, "!!!", 0, ""),
    (3, prose(2, 40), 0, ""),
    (3, prose(1, 60), 0, ""),
    (None, "no id x 日本語 unknownword", 0, ""),
    (4, "another text of IT it it", 0, ""),
]


def test_against_all_scores(spark):
    rows = odd_rows() + [(100 + i % 70, prose(i % 50, 3 + i % 90), None, None, 0) + (None,) * CLASHES for i in range(300)]
    rows += [(5000 + i, "a copy: " + prose(2, 50), None, None, 0) + (None,) * CLASHES for i in range(200)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(5)
    found = ranked_search.search(docs, asked(spark, ITEMS))
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    expected = plain_search([r[:2] for r in rows], [i[:2] for i in ITEMS])
    assert sorted(map(tuple, found.collect()), key=repr) == expected


def test_small_blocks_and_matrices(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 2)
    monkeypatch.setattr(ranked_search, "BLOCK_TERMS", 30)
    docs = odd_documents(spark)
    found = ranked_search.search(docs, asked(spark, ITEMS)).collect()
    assert sorted(map(tuple, found), key=repr) == plain_search([r[:2] for r in odd_rows()], [i[:2] for i in ITEMS])


def test_nothing_to_search(spark):
    assert ranked_search.search(no_documents(spark), asked(spark, ITEMS)).collect() == []
    assert ranked_search.search(odd_documents(spark), asked(spark, [])).collect() == []
    assert ranked_search.search(odd_documents(spark), asked(spark, [(1, "", 0, "")])).collect() == []


@pytest.mark.parametrize("rows", [64, 4096])
def test_bounds_are_never_below_the_scores(spark, rows, monkeypatch):
    monkeypatch.setattr(ranked_search, "MOST_ROWS", rows)
    texts = [prose(i % 9, 5 + 40 * i) + " the" * i for i in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    (block,) = ranked_search.blocks(asked(spark, ITEMS))
    ranked_search.weigh(docs, block)
    found = ranked_search.bound_rows(ranked_search.signatures(docs), block, np.ones(len(block.item_ids), dtype=np.int64))
    bounds = {(r.item, r.doc_id): r.bound for r in found.collect()}
    looser = 0
    for doc_id, text in enumerate(texts):
        counts = Counter(ranked_search.terms(text.encode()))
        m = block.damping(sum(counts.values()))
        for item, (numbers, times) in enumerate(block.of_items):
            names = {n: t for t, n in block.numbers.items()}
            score = sum(
                int(c) * int(block.weights[n]) * (10**9 * counts[names[n]] // (1000 * counts[names[n]] + 12 * m))
                for n, c in zip(numbers.tolist(), times.tolist())
            )
            assert bounds.get((item, doc_id), 0) >= score
            looser += bounds.get((item, doc_id), 0) > score
    assert looser > 0


def test_the_query(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()
    assert sorted(map(tuple, op13_ranked_search(spark, SMALL).collect()), key=repr) == plain_search(docs, items)
