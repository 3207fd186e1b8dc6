from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from martlens.llm import near_duplicates
from tests.conftest import MEDIUM, SMALL
from tests.llm.data import no_documents, odd_documents, odd_rows, prose


def plain_shared(left, right) -> int:
    last = [0] * (len(right) + 1)
    for x in left:
        row = [0]
        for j, y in enumerate(right):
            row.append(last[j] + 1 if x == y else max(last[j + 1], row[-1]))
        last = row
    return last[-1]


@pytest.mark.parametrize("chunk", [1, 5, 512])
def test_banded_alignment_equals_the_full_table(chunk, monkeypatch):
    monkeypatch.setattr(near_duplicates, "CHUNK", chunk)
    draw = random.Random(chunk)
    for _ in range(800):
        left = [draw.randrange(4) for _ in range(draw.randrange(30))]
        right = [x for x in left if draw.random() > 0.2] + [draw.randrange(4) for _ in range(draw.randrange(6))]
        if draw.random() < 0.3:
            draw.shuffle(right)
        shared, band = plain_shared(left, right), draw.randrange(30)
        found = near_duplicates.shared_in_order(left, right, band)
        assert found <= shared and (found == shared or len(left) + len(right) - 2 * shared > band)


def test_linked_is_a_share_of_all_runs():
    draw = random.Random(3)
    for _ in range(400):
        left = np.array([draw.randrange(50) for _ in range(draw.randrange(1, 60))], dtype=np.uint64)
        right = np.array([x for x in left if draw.random() > 0.1] or [1], dtype=np.uint64)
        shared = plain_shared(left.tolist(), right.tolist())
        wanted = shared / (len(left) + len(right) - shared) >= 0.8 - 1e-12
        assert near_duplicates.linked(left, right) == wanted


def test_labels_tell_repeated_runs_apart():
    runs = near_duplicates.runs_of_words("a b c d e " * 20)
    assert len(set(runs.tolist())) == 5 and len(set(near_duplicates.labelled(runs).tolist())) == len(runs)


def test_sketches_see_the_order():
    words = prose(3, 400).split()
    swapped = words[200:] + words[:200]
    one, other = (near_duplicates.order_minhash(near_duplicates.runs_of_words(" ".join(w))) for w in (words, swapped))
    assert 0 < (one == other).sum() < len(one) / 2


def union_find(pairs):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components(spark):
    draw = random.Random(2)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)] + [(1000 + i, 1001 + i) for i in range(60)]
    pairs += [(2000, 2001 + i) for i in range(200)]
    found = near_duplicates.components(spark.createDataFrame(pairs, "a long, b long"))
    wanted = {x: r for x, r in union_find((a, b) for a, b in pairs if a != b).items() if x != r}
    assert {r.node: r.root for r in found.collect() if r.node != r.root} == wanted


def plain_classes(rows) -> dict:
    """Every pair aligned in full."""
    runs = [(d, t, near_duplicates.runs_of_words(t)) for d, t in rows if d is not None and t and t.split()]
    pairs = []
    for i, (a, text, left) in enumerate(runs):
        for b, other, right in runs[i + 1 :]:
            if a == b or text == other or near_duplicates.linked(left, right):
                pairs.append((a, b))
    roots = union_find((a, b) for a, b in pairs if a != b)
    return {d: roots.get(d, d) for d, _, _ in runs}


@pytest.mark.parametrize("folder", [SMALL, MEDIUM])
def test_classes_equal_all_pairs(spark, folder):
    documents = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 500")
    wanted = plain_classes([(r.doc_id, r.text) for r in documents.collect()])
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(documents).collect()}
    assert found == wanted and len(set(found.values())) < len(found)


def test_classes_equal_plain_shingles(spark):
    """Pairs of all sizes with ever more words changed, judged by shingles of words alone; no pair swaps passages."""

    def shingles(text: str) -> Counter:
        words = text.lower().split()
        return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))

    draw = random.Random(8)
    rows = []
    for size in (5, 9, 20, 60, 110, 180, 300):
        for changes in range(1, 12):
            words = prose(1000 * size + changes, size).split()
            other = list(words)
            for place in draw.sample(range(size), min(changes, size)):
                other[place] = f"c{place}"
            rows += [" ".join(words), " ".join(other)]
    rows = list(enumerate(rows))
    pairs, held = [], [shingles(text) for _, text in rows]
    for i, left in enumerate(held):
        for j in range(i):
            if (left & held[j]).total() >= 0.8 * (left | held[j]).total() - 1e-9:
                pairs.append((i, j))
    roots = union_find(pairs)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    assert found == {i: roots.get(i, i) for i, _ in rows} and 10 < len(pairs) < 70


def test_many_copies_and_shared_passages(spark):
    """A group of near copies, and texts that share most of a passage but not each other's rest."""
    draw = random.Random(11)
    base, passage = prose(21, 150).split(), prose(22, 60)
    rows = []
    for i in range(150):
        words = list(base)
        for _ in range(2):
            words[draw.randrange(len(words))] = f"w{i}x"
        rows.append((i, " ".join(words)))
    rows += [(500 + i, f"{passage} {prose(1000 + i, 40)}") for i in range(60)]
    rows += [(900 + i, passage) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()}
    assert found == plain_classes(rows)
    assert {found[i] for i in range(150)} == {0} and all(found[500 + i] == 500 + i for i in range(60))


def test_a_pivot_that_leaves_a_link_open(spark):
    """b is like a and c, which are not like each other; every order of the three ends in one class."""
    words = prose(31, 300).split()
    middle, last = list(words), list(words)
    for i in range(0, 5):
        middle[i * 14 + 3] = f"m{i}"
        last[i * 14 + 3] = f"m{i}"
        last[150 + i * 14 + 3] = f"l{i}"
    texts = [" ".join(words), " ".join(middle), " ".join(last)]
    for order in [(0, 1, 2), (1, 0, 2), (2, 1, 0), (0, 2, 1)]:
        frame = spark.createDataFrame([(n, texts[k]) for n, k in enumerate(order)], "doc_id long, text string")
        rows = near_duplicates.near_duplicates(frame).collect()
        assert {r.class_id for r in rows} == {0}


def test_near_copies_of_short_texts(spark):
    """Texts of 5 to 30 words with one word changed, put in front, put behind or left out, and a common passage in many texts."""
    rows = []
    for size in range(5, 31):
        for copy in range(6):
            words = prose(100 * size + copy, size).split()
            changed = [words[:-1] + ["other"], words + ["more"], ["more"] + words, words[1:], words[:-2]]
            rows += [" ".join(x) for x in (words, *changed)]
    rows += [f"{prose(5, 15)} {prose(9000 + i, 4)}" for i in range(80)]
    rows = list(enumerate(dict.fromkeys(rows)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    wanted = plain_classes(rows)
    assert {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()} == wanted
    assert len(set(wanted.values())) < len(rows) - 400


@pytest.mark.parametrize("size", [95, 99, 100, 104, 110, 127])
def test_pairs_about_the_bound_between_the_methods(spark, size):
    rows = []
    for copy in range(12):
        words = prose(50 * size + copy, size).split()
        rows += [" ".join(words), " ".join(words[: 4 + math.ceil(0.8 * (size - 4))])]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in near_duplicates.near_duplicates(frame).collect()} == plain_classes(rows)


def test_odd_documents(spark):
    rows = near_duplicates.near_duplicates(odd_documents(spark)).collect()
    assert len(rows) == len(odd_rows())
    classes = defaultdict(set)
    for r in rows:
        classes[r.doc_id].add(r.class_id)
    assert classes[None] == {None} and classes[1] == {1} and classes[2] == {2} and classes[8] == {8}
    assert classes[5] == classes[6] == classes[7] == {5} and classes[9] == {9}
    kept = near_duplicates.without_near_duplicates(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [-5, 1, 2, 3, 4, 5, 8, 9, 10, 11, 12] and ids.count(None) == 2


def test_one_document_of_each_class_stays(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    classes = near_duplicates.near_duplicates(documents)
    kept = near_duplicates.without_near_duplicates(documents)
    assert kept.count() == classes.select("class_id").distinct().count()
    assert kept.join(classes.where(F.col("doc_id") == F.col("class_id")), "doc_id", "left_anti").count() == 0


def test_no_documents(spark):
    assert near_duplicates.near_duplicates(no_documents(spark)).collect() == []
    assert near_duplicates.without_near_duplicates(no_documents(spark)).collect() == []


def test_components_of_few_edges_and_of_many_are_the_same(spark, monkeypatch):
    draw = random.Random(5)
    pairs = [(draw.randrange(200), draw.randrange(200)) for _ in range(120)] + [(900 + i, 901 + i) for i in range(30)]
    found = []
    for most in (near_duplicates.BROADCAST_ROWS, 0):
        monkeypatch.setattr(near_duplicates, "BROADCAST_ROWS", most)
        frame = spark.createDataFrame(pairs, "a long, b long")
        found.append({r.node: r.root for r in near_duplicates.components(frame).collect()})
    assert found[0] == found[1] != {}


def test_components_of_edges_in_one_task_and_in_several_are_the_same(spark, monkeypatch):
    draw = random.Random(6)
    pairs = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(900 + i, 901 + i) for i in range(80)]
    wanted = {x: r for x, r in union_find((a, b) for a, b in pairs if a != b).items() if x != r}
    sent = near_duplicates.BROADCAST_ROWS
    for most, rows in ((near_duplicates.EDGES_A_TASK, sent), (150, sent), (150, 0)):
        monkeypatch.setattr(near_duplicates, "EDGES_A_TASK", most)
        monkeypatch.setattr(near_duplicates, "BROADCAST_ROWS", rows)
        frame = spark.createDataFrame(pairs, "a long, b long")
        assert {r.node: r.root for r in near_duplicates.components(frame).collect() if r.node != r.root} == wanted


def test_trees_of_parts_link_the_same_nodes(monkeypatch):
    monkeypatch.setattr(near_duplicates, "EDGES_A_TASK", 10)
    draw = random.Random(7)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(240)]
    parts = [pairs[i : i + 9] for i in range(0, len(pairs), 9)]
    batches = [pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*part)], ["u", "v"]) for part in parts]
    found = [tuple(e.values()) for batch in near_duplicates.hung_on_smallest(batches) for e in batch.to_pylist()]
    wanted = union_find((a, b) for a, b in pairs if a != b)
    trees = union_find(found)
    assert {x: r for x, r in wanted.items()} == {x: trees[x] for x in wanted} and len(found) < len(pairs)


def test_few_links_take_few_jobs(spark):
    """Every round of joins costs the driver memory; a chain of few links took a dozen of them."""
    frame = spark.createDataFrame([(i, i + 1) for i in range(500)], "a long, b long")
    spark.sparkContext.setJobGroup("few-links", "")
    found = near_duplicates.components(frame)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("few-links")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert {r.root for r in found.collect()} == {0} and found.count() == 500 and len(jobs) < 8
