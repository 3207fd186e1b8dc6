"""The business vocabulary: what codes mean and which other words people use."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code -> the words for it, the first one being its label.
CODE_WORDS = {
    "payment_method": {
        "PM01": ["Credit Card"],
        "PM02": ["PayPal"],
        "PM03": ["Gift Card"],
        "PM04": ["Debit Card"],
    },
    "currency": {
        "USD": ["US Dollars"],
        "CAD": ["Canadian Dollars"],
    },
    "state_code": {
        "CA": ["California"],
        "NY": ["New York"],
        "TX": ["Texas"],
        "IL": ["Illinois"],
        "WA": ["Washington"],
        "FL": ["Florida"],
        "MA": ["Massachusetts"],
        "ON": ["Ontario"],
        "QC": ["Quebec"],
        "BC": ["British Columbia"],
        "AB": ["Alberta"],
    },
    "segment": {
        "Corporate": ["Enterprise", "B2B"],
        "SMB": ["Small Business"],
        "Consumer": ["Individual", "Retail"],
    },
}

# Other names of columns, filters, measures and fields.
COLUMN_WORDS = {
    "payment_method": ["payment type", "payment method"],
    "state_code": ["state", "province"],
}
SNIPPET_WORDS = {
    "filter": {
        "is_high_value": ["large orders", "big orders", "high value"],
        "is_refunded": ["refunds only", "just refunds"],
    },
    "measure": {
        "net_of_refunds": ["net revenue", "revenue after refunds"],
        "distinct_customers": ["unique customers", "number of customers"],
    },
    "field": {
        "age_group": ["age bracket", "age band"],
        "order_size": ["order size", "basket size"],
    },
}


def normalised(term: str) -> str:
    return term.strip().lower()


def codes_meant(column: str, term: str) -> list[str]:
    """Codes of a column that a word stands for: the code itself or any of its words."""
    wanted = normalised(term)
    codes = [
        code
        for code, words in CODE_WORDS[column].items()
        if wanted == normalised(code) or wanted in map(normalised, words)
    ]
    if not codes:
        raise LookupError(f"{term!r} names no value of {column}")
    return codes


def means(column: str, term: str, value: Column | None = None) -> Column:
    """Predicate 'the column holds what this word stands for'. Plain codes, so it is pushed into the scan."""
    return (F.col(column) if value is None else value).isin(codes_meant(column, term))


def code_table(spark: SparkSession, column: str) -> DataFrame:
    """Code and label of one column. A local table of known size: Spark broadcasts it by its own size check."""
    words = CODE_WORDS[column]
    return spark.createDataFrame(pa.table({column: list(words), "label": [w[0] for w in words.values()]}))


def word_table(spark: SparkSession) -> DataFrame:
    """Every word with its kind, the name of what it concerns and the code it stands for.

    The kind is code, column, filter, measure or field; only words for codes have a code.
    """
    rows = [
        (normalised(w), "code", col, code) for col, codes in CODE_WORDS.items() for code, ws in codes.items() for w in ws
    ]
    for kind, names in {"column": COLUMN_WORDS, **SNIPPET_WORDS}.items():
        rows += [(normalised(w), kind, name, None) for name, words in names.items() for w in words]
    kinds = pa.schema([(name, pa.string()) for name in ("term", "kind", "column_name", "code")])
    return spark.createDataFrame(pa.table(list(zip(*rows)), schema=kinds))
