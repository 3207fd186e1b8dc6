"""From the words people use to the codes that are stored."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Letters a term has at least -> typing errors it may hold.
EDITS = {3: 1, 6: 2}


def decode(df: DataFrame, codes: DataFrame, column: str, label: str) -> DataFrame:
    """Add the label of a code; unknown codes keep their row with a NULL label."""
    return df.join(codes.select(column, F.col("label").alias(label)), column, "left")


def value_index(tables: Sequence[tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Distinct values of columns with their row counts: (column_name, value, term, rows).

    Each table is scanned once for all its columns, and counts are added up before they are shuffled. A value is
    identified together with its column, since one text may be a code of several columns.
    """
    counted = [
        df.select(*columns)
        .unpivot([], list(columns), "column_name", "value")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
        for df, columns in tables
    ]
    index = reduce(DataFrame.unionByName, counted)
    return index.select("column_name", "value", F.lower(F.trim("value")).alias("term"), "rows")


def edits_allowed(term: str | Column, edits: Mapping[int, int] = EDITS) -> Column:
    """How many typing errors a term may hold: by default none up to 2 letters, one up to 5, two beyond."""
    allowed = F.lit(0)
    for letters, number in sorted(edits.items()):
        allowed = F.when(F.length(term) >= letters, number).otherwise(allowed)
    return allowed


def resolve(terms: DataFrame, index: DataFrame, words: DataFrame, edits: Mapping[int, int] = EDITS) -> DataFrame:
    """Stored codes for user terms: (term, column_name, code, distance).

    A term that equals a word or a stored value takes all the codes it names, at distance 0. Any other term takes, per
    column, the nearest code within ``edits_allowed``, the smallest code on a tie. Terms nothing matches give no row.
    """
    stored = index.select("column_name", F.col("value").alias("code"))
    known = (
        words.where("code IS NOT NULL")
        .select("term", "column_name", "code")
        .join(stored, ["column_name", "code"], "left_semi")
        .unionByName(index.select("term", "column_name", F.col("value").alias("code")))
        .distinct()
    )
    return nearest_names(terms, known, "column_name", "code", edits)


def resolve_names(terms: DataFrame, words: DataFrame, edits: Mapping[int, int] = EDITS) -> DataFrame:
    """Columns, filters, measures and fields for user terms: (term, kind, name, distance), matched as codes are."""
    known = words.where("kind <> 'code'").select("term", "kind", F.col("column_name").alias("name")).distinct()
    return nearest_names(terms, known, "kind", "name", edits)


def nearest_names(terms: DataFrame, known: DataFrame, group: str, name: str, edits: Mapping[int, int]) -> DataFrame:
    """(term, group, name, distance): all names a term equals, or else in each group the nearest within the edits allowed.

    Two texts within ``n`` edits share a text left over after deleting at most ``n`` letters from each, so near pairs
    are found by an equi-join on these leftovers, without pairing every term with every word. Leftovers are made only of
    words whose length is near that of some term.
    """
    asked = terms.select(F.lower(F.trim("term")).alias("term")).where("term <> ''").distinct()
    exact = asked.join(known, "term").select("term", group, name, F.lit(0).alias("distance"))
    unknown = asked.join(known.select("term"), "term", "left_anti").withColumn("edits", edits_allowed("term", edits))
    unknown = unknown.where("edits > 0")
    left = unknown.select("term", "edits", F.explode(_leftovers(F.col("term"), F.col("edits"), edits)).alias("leftover"))
    reach = F.explode(F.sequence(F.length("term") - F.col("edits"), F.length("term") + F.col("edits")))
    lengths = unknown.select(reach.alias("letters"), "edits").distinct()
    near_length = known.withColumn("letters", F.length("term")).join(lengths, "letters")
    right = near_length.select(
        F.col("term").alias("word"),
        group,
        name,
        "edits",
        F.explode(_leftovers(F.col("term"), F.col("edits"), edits)).alias("leftover"),
    )
    near = (
        left.join(right, ["leftover", "edits"])
        .withColumn("distance", F.levenshtein("term", "word"))
        .where("distance <= edits")
        .groupBy("term", group)
        .agg(F.min(F.struct("distance", name)).alias("best"))
        .select("term", group, f"best.{name}", "best.distance")
    )
    return exact.unionByName(near)


def rows_meaning(df: DataFrame, column: str, resolved: DataFrame) -> DataFrame:
    """Rows whose column holds a code that was resolved for it."""
    codes = resolved.where(F.col("column_name") == column).select(F.col("code").alias(column)).distinct()
    return df.join(codes, column, "left_semi")


def _leftovers(text: Column, deletions: Column, edits: Mapping[int, int]) -> Column:
    """The text itself and what is left after deleting letters, as many as ``deletions`` says."""
    last, found = F.array(text), [F.array(text)]
    for number in range(1, max(edits.values(), default=0) + 1):
        shorter = F.array_distinct(F.flatten(F.transform(last, _one_letter_less)))
        last = F.when(deletions >= number, shorter).otherwise(F.expr("CAST(array() AS array<string>)"))
        found.append(last)
    return F.array_distinct(F.concat(*found))


def _one_letter_less(text: Column) -> Column:
    # Starts at position 1 for an empty text too: deleting past the end leaves the text as it is.
    positions = F.sequence(F.lit(1), F.greatest(F.length(text), F.lit(1)))
    return F.transform(
        positions, lambda at: F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + 1))
    )
