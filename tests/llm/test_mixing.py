from __future__ import annotations

import re
from collections import Counter, defaultdict

import duckdb
import pytest
from hypothesis import given, settings as hypothesis_settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martlens.llm import mixing
from martlens.llm.statements import OP6
from tests.compare import differences, oracle_connection
from tests.conftest import SMALL
from tests.llm.data import no_documents, odd_documents, odd_rows, prose


def plain_targets(sizes: dict) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weights = {name: (5, 2, 1)[i % 3] for i, name in enumerate(names)}
    capped, total = set(), 1.5 * sum(sizes.values())
    while True:
        open_ = [n for n in names if n not in capped]
        level = (total - sum(2 * sizes[n] for n in capped)) / max(1, sum(weights[n] for n in open_))
        above = {n for n in open_ if level * weights[n] > 2 * sizes[n]}
        if not above:
            return {n: 2.0 * sizes[n] if n in capped else level * weights[n] for n in names}
        capped |= above


def check(frame, rows) -> None:
    size = {}
    for row in rows:
        size.setdefault(row[0], []).append((len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or "")), row[3]))
    sums = Counter()
    for row in rows:
        sums[row[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", row[1] or ""))
    wanted = plain_targets(dict(sums))
    found = mixing.mix(frame).collect()
    assert len(found) == len(rows)
    taken = defaultdict(int)
    for r in found:
        options = [s for s in size[r.doc_id] if s[0] == r["size"] and sums[s[1]] == r.source_size]
        assert options and any(r.target == pytest.approx(wanted[s[1]]) for s in options)
        assert 0 <= r.taken <= 2 * r["size"]
        taken[options[0][1]] += r.taken
    for source, target in wanted.items():
        assert abs(taken[source] - target) <= 3 * mixing.BLOCK_WORDS, (source, taken[source], target)
    assert sorted(map(str, found)) == sorted(map(str, mixing.mix(frame.repartition(5)).collect()))


def test_odd_documents(spark):
    check(odd_documents(spark), odd_rows())


def test_a_hot_source_over_many_shards(spark):
    rows = [(i, prose(i % 50, 1 + i % 30), "en", "hot" if i % 3 else f"s{i % 7}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = mixing.mix(frame, shard_words=500).collect()
    sums, taken = Counter(), Counter()
    for r, source in zip(sorted(found), [row[3] for row in rows]):
        sums[source] += r["size"]
        taken[source] += r.taken
    for source, target in plain_targets(dict(sums)).items():
        shards = sums[source] // 500 + 2
        assert abs(taken[source] - target) <= 2 * mixing.BLOCK_WORDS * shards


@hypothesis_settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 40), min_size=1, max_size=12), st.integers(0, 60))
def test_apportionment_equals_dealing_seat_by_seat(spark, weights, seats):
    if not any(weights):
        weights = [*weights, 1]
    won = Counter()
    for _ in range(seats):
        best = max((i for i, w in enumerate(weights) if w), key=lambda i: (weights[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    rows = [(g, i, w, seats) for g in (0, 1) for i, w in enumerate(weights)]
    table = spark.createDataFrame(rows, "g int, i int, w int, seats long")
    for r in mixing.apportion(table, ["g"], "i", "w", "seats").collect():
        assert r.quota == won[r.i]


def test_matches_sql(spark, tmp_path):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    assert differences(mixing.mix(documents), oracle_connection(SMALL), OP6) == []
    odd_documents(spark).write.parquet(str(tmp_path / "documents"))
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    assert differences(mixing.mix(spark.read.parquet(str(tmp_path / "documents"))), connection, OP6) == []


def test_mixed_documents(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    found = mixing.mixed_documents(documents)
    assert found.columns == documents.columns
    times = {r.doc_id: r["count"] for r in found.groupBy("doc_id").count().collect()}
    taken = {r.doc_id: r.taken / max(1, r["size"]) for r in mixing.mix(documents).collect()}
    assert all(int(taken[d]) <= times.get(d, 0) <= int(taken[d]) + 1 for d in taken)
    odd = mixing.mixed_documents(odd_documents(spark))
    assert odd.where(F.trim(F.coalesce("text", F.lit(""))) == "").count() == 0


def test_no_documents(spark):
    assert mixing.mix(no_documents(spark)).collect() == []
    assert mixing.mixed_documents(no_documents(spark)).collect() == []
