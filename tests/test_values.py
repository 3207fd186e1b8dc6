"""Value resolution against comparing every term with every word."""

from __future__ import annotations

import random

import duckdb
import pyarrow as pa
import pytest

from martlens.functions.vocabulary import word_table
from martlens.operators.values import EDITS, resolve, resolve_names, rows_meaning, value_index
from martlens.plans import queries
from tests.conftest import SMALL


def nearest_by_brute_force(terms, known, edits=EDITS):
    connection = duckdb.connect()
    connection.register("terms", pa.table({"term": sorted(set(t.strip().lower() for t in terms if t.strip()))}))
    word, column, code = zip(*known)
    connection.register("known", pa.table({"word": word, "column_name": column, "code": code}))
    rows = connection.sql(
        """SELECT t.term, k.column_name, k.code, levenshtein(t.term, k.word) AS distance, length(t.term) AS letters
           FROM terms AS t, known AS k"""
    ).fetchall()
    exact = {(t, c, v, 0) for t, c, v, d, _ in rows if d == 0}
    found = set(exact)
    best = {}
    for term, column, code, distance, letters in rows:
        allowed = max([number for least, number in edits.items() if letters >= least], default=0)
        if distance <= allowed and term not in {e[0] for e in exact}:
            best[term, column] = min(best.get((term, column), (distance, code)), (distance, code))
    found.update((term, column, code, distance) for (term, column), (distance, code) in best.items())
    return found


def index_frame(spark, values):
    return spark.createDataFrame(
        [(c, v, v.strip().lower(), 1) for c, v in values], "column_name string, value string, term string, rows long"
    )


def no_words(spark):
    return spark.createDataFrame([], "term string, column_name string, code string")


@pytest.mark.parametrize("edits", [EDITS, {}, {1: 1}, {3: 2}, {4: 1, 6: 3}])
def test_resolve_matches_brute_force_on_random_words(spark, edits):
    rng = random.Random(5)
    letters = "abcd"
    values = sorted({(rng.choice("xy"), "".join(rng.choices(letters, k=rng.randint(1, 9)))) for _ in range(150)})
    terms = ["".join(rng.choices(letters, k=rng.randint(1, 10))) for _ in range(150)]
    got = resolve(
        spark.createDataFrame([(t,) for t in terms], "term string"), index_frame(spark, values), no_words(spark), edits
    )
    want = nearest_by_brute_force(terms, [(v, c, v) for c, v in values], edits)
    assert {tuple(r) for r in got.collect()} == want


def test_terms_are_trimmed_and_blank_terms_dropped(spark):
    terms = spark.createDataFrame([(" PayPal ",), ("paypal",), ("  ",), (None,)], "term string")
    index = index_frame(spark, [("payment_method", "PM02"), ("payment_method", "PM01")])
    got = resolve(terms, index, word_table(spark)).collect()
    assert [tuple(r) for r in got] == [("paypal", "payment_method", "PM02", 0)]


def test_one_text_can_be_a_code_of_two_columns(spark):
    index = index_frame(spark, [("state_code", "CA"), ("country_code", "CA")])
    got = resolve(spark.createDataFrame([("ca",)], "term string"), index, no_words(spark))
    assert {(r.column_name, r.code) for r in got.collect()} == {("state_code", "CA"), ("country_code", "CA")}


def test_codes_that_are_not_stored_are_not_offered(spark):
    index = index_frame(spark, [("state_code", "NY")])
    got = resolve(spark.createDataFrame([("california",), ("new york",)], "term string"), index, word_table(spark))
    assert [tuple(r) for r in got.collect()] == [("new york", "state_code", "NY", 0)]


def test_index_counts_rows_and_skips_null(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), (" B ", "x")], "p string, q string")
    got = {tuple(r) for r in value_index([(df, ["p", "q"])]).collect()}
    assert got == {("p", "a", "a", 2), ("p", " B ", "b", 1), ("q", "x", "x", 2)}


def test_rows_meaning_keeps_rows_once(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, kind string")
    resolved = spark.createDataFrame(
        [("t", "kind", "a"), ("u", "kind", "a"), ("t", "other", "b")], "term string, column_name string, code string"
    )
    assert [r.id for r in rows_meaning(facts, "kind", resolved).collect()] == [1]


def test_words_cover_columns_and_snippets(spark):
    rows = {tuple(r) for r in word_table(spark).collect()}
    assert ("province", "column", "state_code", None) in rows and ("big orders", "filter", "is_high_value", None) in rows
    assert ("b2b", "code", "segment", "Corporate") in rows and len(rows) == 22 + 4 + 13


def test_filters_measures_and_fields_are_named_by_their_words(spark):
    terms = [(t,) for t in ("Big Orders", "net revenu", "province", "paypal", "basket size", "nothing like it")]
    found = resolve_names(spark.createDataFrame(terms, "term string"), word_table(spark)).collect()
    assert {tuple(r) for r in found} == {
        ("big orders", "filter", "is_high_value", 0),
        ("net revenu", "measure", "net_of_refunds", 1),
        ("province", "column", "state_code", 0),
        ("basket size", "field", "order_size", 0),
    }


def test_only_numbers_asked_for_are_computed(spark, gold):
    everything = {(r.term, r.name): r.number for r in queries.numbers_by_term(spark, SMALL).collect()}
    large = queries.numbers_by_term(spark, SMALL, ["big orders"])
    assert {(r.term, r.name): r.number for r in large.collect()} == {
        ("big orders", "is_high_value"): everything["big orders", "is_high_value"]
    }
    read = large.inputFiles()
    assert read and all("/fact_orders/" in path for path in read)
    nothing = queries.numbers_by_term(spark, SMALL, ["campaign", ""])
    assert nothing.columns == large.columns and nothing.collect() == [] and nothing.inputFiles() == []
