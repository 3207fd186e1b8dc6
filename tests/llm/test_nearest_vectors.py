from __future__ import annotations

import math

import numpy as np
import pytest

from martlens.llm import nearest_vectors
from tests.conftest import MEDIUM

SCHEMA = "vec_id long, embedding array<float>, label int, node string, parts string"


def plain_search(rows) -> dict:
    usable = {}
    for vec_id, vector in rows:
        if vec_id is None or not vector or any(x is None or not math.isfinite(x) for x in vector) or not any(vector):
            continue
        usable.setdefault(vec_id, np.array(vector, dtype=np.float32).astype(float))
    ids = sorted(usable)
    matrix = np.array([usable[i] for i in ids])
    norms = np.sqrt((matrix * matrix).sum(axis=1))
    out = {}
    for i, vec_id in enumerate(ids):
        if vec_id % 50 == 0:
            scores = matrix @ matrix[i] / (norms[i] * norms)
            order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (-round(scores[j], 13), ids[j]))[:5]
            out[vec_id] = [(ids[j], scores[j]) for j in order]
    return out


def found_by_query(table) -> dict:
    out = {}
    for r in nearest_vectors.search(table).collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for hits in out.values():
        hits.sort()
        assert [rank for rank, _, _ in hits] == list(range(1, len(hits) + 1))
        assert all(b[2] <= a[2] for a, b in zip(hits, hits[1:]))
    return {q: [(v, s) for _, v, s in hits] for q, hits in out.items()}


def recall(found, wanted) -> float:
    hit = sum(len({v for v, _ in found[q]} & {v for v, _ in hits}) for q, hits in wanted.items())
    return hit / sum(len(hits) for hits in wanted.values())


def test_recall_over_given_vectors(spark):
    table = spark.read.parquet(f"{MEDIUM}/embeddings.parquet")
    wanted = plain_search([(r.vec_id, r.embedding) for r in table.collect()])
    found = found_by_query(table)
    assert set(found) == set(wanted) and recall(found, wanted) >= 0.9
    for q, hits in found.items():
        known = dict(wanted[q])
        assert all(s == pytest.approx(known[v], abs=1e-12) for v, s in hits if v in known)


def test_clustered_vectors_need_few_parts(spark):
    draw = np.random.default_rng(9)
    centres = draw.normal(size=(60, 16)) * 4
    rows = [(i, (centres[i % 60] + draw.normal(size=16)).tolist()) for i in range(3000)]
    router = nearest_vectors.fit_router(nearest_vectors.unit(np.array([v for _, v in rows])), 32)
    assert router.probes <= 16
    table = spark.createDataFrame([(i, v, 0, "c", "c") for i, v in rows], SCHEMA)
    wanted = plain_search(rows)
    assert recall(found_by_query(table), wanted) >= 0.9


def test_a_vector_that_a_third_of_all_rows_share(spark):
    draw = np.random.default_rng(1)
    same = draw.normal(size=8).tolist()
    rows = [(i, same if i % 3 == 0 else draw.normal(size=8).tolist()) for i in range(1200)]
    table = spark.createDataFrame([(i, v, 0, "c", "c") for i, v in rows], SCHEMA)
    found = found_by_query(table)
    for q in (0, 150, 300):
        assert [v for v, _ in found[q]] == [v for v in (0, 3, 6, 9, 12, 15) if v != q][:5]
    assert recall(found, plain_search(rows)) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0]),
        (0, [1.0, 0.0]),
        (50, [0.0, 2.0]),
        (1, [2.0, 0.0]),
        (2, [2.0, 0.0]),
        (3, [-1.0, 0.0]),
        (4, None),
        (5, []),
        (6, [0.0, 0.0]),
        (7, [None, 1.0]),
        (8, [nan, 1.0]),
        (9, [inf, 1.0]),
        (10, [1.0]),
        (None, [1.0, 1.0]),
        (100, None),
    ]
    table = spark.createDataFrame([(i, v, 0, "c", "c") for i, v in rows], SCHEMA)
    found = found_by_query(table)
    assert found[0] == [(1, 1.0), (2, 1.0), (50, 0.0), (3, -1.0)]
    assert found[50] == [(0, 0.0), (1, 0.0), (2, 0.0), (3, 0.0)]
    assert set(found) == {0, 50}


def test_few_rows(spark):
    assert nearest_vectors.search(spark.createDataFrame([], SCHEMA)).collect() == []
    assert nearest_vectors.search(spark.createDataFrame([(0, [1.0], 0, "c", "c")], SCHEMA)).collect() == []
