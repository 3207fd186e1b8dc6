from __future__ import annotations

import random
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from martlens.llm import language_id, shared
from tests.conftest import MEDIUM
from tests.llm.data import no_documents, odd_documents, odd_rows, prose


def test_held_out_accuracy(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    found = language_id.identify(documents).join(documents.select("doc_id", "lang"), "doc_id")
    (row,) = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")).alias("right")).collect()
    assert row.right >= 0.97
    assert found.where("rejected").count() == 0
    assert found.where("score < 0 OR score > 1").count() == 0
    for r in found.select("doc_id", "held_out").limit(100).collect():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)


def test_labels_of_the_held_out_part_change_nothing(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    wrong = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, "xx").otherwise(F.col("lang"))
    found = language_id.identify(documents).exceptAll(language_id.identify(documents.withColumn("lang", wrong)))
    assert found.count() == 0


def test_odd_documents(spark):
    found = language_id.identify(odd_documents(spark)).collect()
    assert len(found) == len(odd_rows())
    texts = {}
    for row in odd_rows():
        texts.setdefault(row[0], []).append(row[1])
    learned = {row[2] for row in odd_rows()} - {None}
    for row in found:
        if not any(language_id.has_letter(t) for t in texts[row.doc_id]):
            assert (row.lang_pred, row.score, row.rejected) == ("und", 0.0, True)
        elif len(texts[row.doc_id]) == 1:
            assert row.lang_pred in learned and 0 <= row.score <= 1
        assert row.doc_id is not None or not row.held_out


def test_far_texts_are_rejected(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.learn(language_id.training_part(documents))
    russian = "Все счастливые семьи похожи друг на друга, каждая несчастливая семья несчастлива по-своему."
    strange = spark.createDataFrame([(1, russian, "clash")], "doc_id long, text string, score string")
    (row,) = language_id.predict(strange, model).collect()
    assert row.rejected and row.lang_pred in model.languages


def test_long_texts_of_no_learned_language_are_rejected(spark):
    documents = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    model = language_id.learn(language_id.training_part(documents))
    draw = random.Random(4)

    def invented(letters: str, size: int) -> str:
        text = ""
        while len(text) < size:
            text += "".join(draw.choices(letters, k=draw.randint(2, 9))) + " "
        return text[:size]

    cyrillic, han = ("".join(map(chr, range(*ends))) for ends in ((0x430, 0x450), (0x4E00, 0x5A00)))
    strange = []
    for size in (100, 500, 1_000, 3_000, 10_000, 50_000):
        strange += [invented(letters, size) for letters in (cyrillic, han, "abcdefghijklmnopqrstuvwxyz")]
        strange.append("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=size)))
    held_out = documents.where("crc32(cast(doc_id as string)) % 3 = 1").orderBy("doc_id").collect()
    longer = [r.text.split() for r in held_out if len(r.text.split()) > 300]
    strange += [" ".join(word[::-1] for word in words) for words in longer[:50]]
    clean = [" ".join(words[:n]) for words in longer[:50] for n in (4, 40, 100, 300)]
    rows = [(i, text) for i, text in enumerate(strange + clean)]
    found = language_id.predict(spark.createDataFrame(rows, "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.doc_id for r in found if r.rejected] == list(range(len(strange)))


def test_few_training_texts_set_no_bound():
    vectors = np.eye(3, 8, dtype=np.float32) + 0.5
    assert language_id.smallest_cosines(vectors).max() == 0
    many = language_id.smallest_cosines(np.tile(vectors / np.linalg.norm(vectors, axis=1)[:, None], (20, 1)))
    assert many[4] > 0.3 and many[3] == 0 and many[-1] == many[4]


def test_nothing_to_learn(spark):
    assert language_id.identify(no_documents(spark)).collect() == []
    bare = spark.createDataFrame([(1, "some words", None)], "doc_id long, text string, lang string")
    (row,) = language_id.identify(bare).collect()
    assert (row.lang_pred, row.score) == ("und", 0.0)


def whole(entries, size: int) -> np.ndarray:
    out = np.zeros((len(entries), size), dtype=np.float32)
    for row, (places, values) in zip(out, entries):
        row[places] = values
    return out


def plain_clusters(vectors: np.ndarray, clusters: int) -> np.ndarray:
    def scaled(v: np.ndarray) -> np.ndarray:
        return v / np.linalg.norm(v)

    centres = [scaled(vectors.mean(axis=0))]
    while len(centres) < clusters:
        centres.append(vectors[int((vectors @ np.stack(centres).T).max(axis=1).argmin())])
    found = np.stack(centres)
    for _ in range(language_id.ROUNDS):
        own = (vectors @ found.T).argmax(axis=1)
        found = np.stack([scaled(vectors[own == i].mean(axis=0)) if (own == i).any() else found[i] for i in range(clusters)])
    return found


def test_clustering_holds_no_whole_vectors():
    size, texts = language_id.SIZE, [prose(seed, 150) for seed in range(200)]
    blank = language_id.LanguageModel(np.ones(size), np.zeros((0, size), dtype=np.float32), [], np.zeros((0, language_id.SIZES)))
    tracemalloc.start()
    entries = [blank.entries(text) for text in texts]
    found, floors = language_id.cluster(entries, size, 4), language_id.smallest_cosines(entries)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # 200 whole vectors have 52 MB.
    assert peak < 15e6
    vectors = whole(entries, size)
    assert np.abs(found - plain_clusters(vectors, 4)).max() < 1e-6
    assert np.abs(floors - language_id.smallest_cosines(vectors)).max() < 1e-12


def test_texts_reach_workers_in_small_batches(spark, settings):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    settings(execution__arrow__maxBytesPerBatch="64m")
    rows = [(i, "some words of a text " * 5000, "en") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1)
    model = language_id.learn(language_id.training_part(docs))
    assert language_id.predict(docs, model).count() == 100

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    # What a batch may exceed the bound by is one row.
    assert max(r.size for r in docs.mapInArrow(sizes, "size long").collect()) < shared.BATCH_BYTES + 200_000
    settings(execution__arrow__maxBytesPerBatch="1m")
    shared.small_batches(spark)
    assert spark.conf.get(name) == "1m"
