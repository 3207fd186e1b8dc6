from __future__ import annotations

import sentencepiece

import __spark_entry__ as registered
import corpus_pipeline
from martlens.llm import language_id, near_duplicates, secret_scan
from martlens.llm.shared import model_path
from tests.conftest import SMALL
from tests.llm.data import no_documents, odd_documents


def test_each_stage_does_what_it_says(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "near_duplicates", "secret_scans", "mixing", "pieces"]

    told = stages["language_id"](spark, docs, SMALL).cache()
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert {r.doc_id: r.lang for r in told.collect()} == {d: r.lang_pred for d, r in found.items() if not r.rejected}

    single = stages["near_duplicates"](spark, told, SMALL).cache()
    classes = near_duplicates.near_duplicates(told)
    assert {r.doc_id for r in single.collect()} == {r.class_id for r in classes.collect()}

    clean = stages["secret_scans"](spark, single, SMALL).cache()
    before = {r.doc_id: r.text for r in single.collect()}
    held = {r.doc_id for r in secret_scan.secret_scan(single).collect() if r.spans and not r.n_copied}
    after = {r.doc_id: r.text for r in clean.collect()}
    assert set(after) == set(before) and {d for d in after if after[d] != before[d]} == held
    assert all("<secret>" in after[d] for d in held)

    mixed = stages["mixing"](spark, clean, SMALL).cache()
    assert {r.text for r in mixed.collect()} <= set(after.values())

    library = sentencepiece.SentencePieceProcessor(model_file=model_path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text for r in mixed.collect()}
    rows = stages["pieces"](spark, mixed, SMALL).collect()
    assert len(rows) == mixed.count()
    assert all(r.ids == library.encode(texts[r.doc_id], add_eos=True) for r in rows)
    for frame in (told, single, clean, mixed):
        assert frame.columns == docs.columns


def test_run_and_registration(spark):
    assert registered.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, SMALL).count() > 0
    names = [f"op{n}_" for n in range(1, 14)]
    assert all(sum(q.startswith(n) for q in registered.queries()) == 1 for n in names)


def test_odd_documents_through_every_stage(spark):
    """Rows, texts and lengths of odd documents stage by stage, with columns of any other names beside them."""
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = stage(spark, docs, SMALL).cache()
        after = docs.collect()
        assert docs.columns == odd_documents(spark).columns
        old, new = {(r.doc_id, r.text) for r in before}, {(r.doc_id, r.text) for r in after}
        if name == "secret_scans":
            changed = [r for r in after if (r.doc_id, r.text) not in old]
            assert changed and all("<secret>" in r.text and r.n_chars == len(r.text) for r in changed)
            assert sorted(str(r.doc_id) for r in before) == sorted(str(r.doc_id) for r in after)
        else:
            assert new <= old and after
        assert all(r.part == "clash" and r.cuts == "clash" and r._id == "clash" for r in after)
        if name == "language_id":
            assert all(any(c.isalpha() for c in r.text) and r.lang is not None for r in after)
    library = sentencepiece.SentencePieceProcessor(model_file=model_path("piece_bpe_32k.model"))
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    expected = [(r.doc_id, library.encode(r.text, add_eos=True)) for r in docs.collect()]
    assert sorted([(r.doc_id, r.ids) for r in encoded], key=repr) == sorted(expected, key=repr)


def test_no_documents(spark):
    docs = no_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.collect() == []
