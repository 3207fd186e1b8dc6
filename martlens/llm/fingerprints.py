"""Document fingerprints by winnowing.

Every run of ``gram`` code points is hashed; of every ``window`` successive hashes the smallest is kept, the rightmost one
on ties, with its position. Two texts that share a passage of at least ``window + gram - 1`` code points therefore share a
fingerprint entry whose positions mark the passage in both.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martlens.llm.shared import code_points, mixed, ship, shuffle_partitions

GRAM = 16
WINDOW = 14
BASE = np.uint64(0x9E3779B97F4A7C15)
FLUSH_CHARS = 4_000_000

SCHEMA = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
near_edited double, near_next double"""


def gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """A hash of every run of ``gram`` code points, built from runs of 1, 2, 4, … of them."""
    run, run_length, power = codes.astype(np.uint64) + np.uint64(1), 1, BASE
    out, out_length = None, 0
    with np.errstate(over="ignore"):
        while True:
            if gram & run_length:
                out = run if out is None else out[: len(out) - run_length] * power + run[out_length:]
                out_length += run_length
            if out_length == gram:
                return mixed(out[: len(codes) - gram + 1])
            run = run[:-run_length] * power + run[run_length:]
            run_length *= 2
            power = power * power


def winnow(codes: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> np.ndarray:
    """The kept entries in text order, each ``hash << 32 | position`` with a hash of 32 bits.

    A text shorter than ``gram`` is one run; a text with fewer than ``window`` runs is one window; an empty text has no entry.
    """
    if not len(codes):
        return np.empty(0, dtype=np.uint64)
    hashes = gram_hashes(codes, min(gram, len(codes)))
    low = np.uint64(0xFFFFFFFF)
    # The complement of the position in the low half makes the rightmost of equal hashes the smallest.
    least = (hashes & ~low) | (low - np.arange(len(hashes), dtype=np.uint64))
    wide, span = min(window, len(least)), 1
    while span * 2 <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if rest := wide - span:
        least = np.minimum(least[:-rest], least[rest:])
    kept = least[np.concatenate(([True], least[1:] != least[:-1]))]
    return (kept & ~low) | (low - (kept & low))


def as_text(entries: np.ndarray) -> str:
    """Sixteen hexadecimal digits for each entry: eight of the hash, eight of the position."""
    return entries.astype(">u8").tobytes().hex()


def as_entries(text: str) -> list[tuple[int, int]]:
    """(hash, position) of every entry of a fingerprint string."""
    values = np.frombuffer(bytes.fromhex(text), dtype=">u8")
    return [(int(v) >> 32, int(v) & 0xFFFFFFFF) for v in values]


def likeness(left: np.ndarray, right: np.ndarray) -> float:
    """Shared over all distinct hashes; 1 for two empty fingerprints."""
    a, b = np.unique(left >> np.uint64(32)), np.unique(right >> np.uint64(32))
    if not len(a) and not len(b):
        return 1.0
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared)


def fingerprints(documents: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id and the fingerprint of every text (null: empty), in one pass without a shuffle.

    Rows may repeat; every row gets its own result.
    """
    ship(documents.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [as_text(winnow(code_points(t.as_py() or ""), gram, window)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.string())], ["doc_id", "fingerprint"])

    frame = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return frame.mapInArrow(run, "doc_id long, fingerprint string")


def range_bounds(documents: DataFrame, parts: int) -> list[int]:
    """At most ``parts - 1`` ascending doc_ids that cut the rows into nearly equal ranges."""
    if parts < 2:
        return []
    found = documents.agg(
        F.percentile_approx("doc_id", [i / parts for i in range(1, parts)], 100 * parts).alias("bounds")
    ).first()["bounds"]
    return sorted(set(found or []))


def range_number(column: F.Column, bounds: list[int]) -> F.Column:
    """How many bounds lie below the value (null: 0), by bisection in a fixed number of steps."""
    if not bounds:
        return F.lit(0)
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))
    table = F.array(*[F.lit(int(b)).cast("long") for b in bounds])

    def halve(state, _):
        middle = F.floor((state["lo"] + state["hi"]) / 2).cast("int")
        below = F.get(table, middle) < column
        open_ = state["lo"] < state["hi"]
        return F.struct(
            F.when(open_ & below, middle + 1).otherwise(state["lo"]).alias("lo"),
            F.when(open_ & ~below, middle).otherwise(state["hi"]).alias("hi"),
        )

    start = F.struct(F.lit(0).alias("lo"), F.lit(len(bounds)).alias("hi"))
    return F.when(column.isNull(), 0).otherwise(F.aggregate(steps, start, halve)["lo"])


def compare_with_edits(documents: DataFrame, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """The fingerprint of every text, of its edited text, and the likeness to that and to the next document's.

    Documents follow each other by descending doc_id, the last before the first again; rows without a doc_id come last, rows
    with the same doc_id by text (null first). A null text is empty. The edited text has its last ``n_chars // 2`` code points
    replaced by as many from the start of the next document. An only document is its own next one.

    The rows are dealt out by ranges of doc_id, each text once. The first document of a range is also sent to the range before
    it, so that a range knows the successor of its last row without any other exchange.
    """
    spark = documents.sparkSession
    ship(spark)
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bounds = range_bounds(rows, shuffle_partitions(spark))
    rows = rows.withColumn("part", range_number(F.col("doc_id"), bounds))
    heads = {r["part"]: r["head"] for r in rows.groupBy("part").agg(F.max("doc_id").alias("head")).collect()}
    used = sorted(heads, reverse=True)
    before = {part: used[i - 1] for i, part in enumerate(used)}
    count = len(bounds) + 1
    head = F.get(F.array(*[F.lit(heads.get(p)).cast("long") for p in range(count)]), F.col("part"))
    host = F.get(F.array(*[F.lit(before.get(p, p)) for p in range(count)]), F.col("part"))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("guest"))
    guest = F.struct(host.alias("part"), F.lit(True).alias("guest"))
    dealt = (
        rows.withColumn("to", F.explode(F.when(F.col("doc_id").eqNullSafe(head), F.array(own, guest)).otherwise(F.array(own))))
        .select(F.col("to.part").alias("part"), F.col("to.guest").alias("guest"), "doc_id", "text")
        .repartitionById(count, F.col("part"))
        .sortWithinPartitions("part", "guest", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[list] = [[] for _ in range(7)]
        size = 0
        waiting = None  # (doc_id, text, codes, entries) of the row whose successor comes next
        done_part = None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column(0)[i].as_py()
                if part == done_part:
                    continue
                text = batch.column(3)[i].as_py() or ""
                codes = code_points(text)
                entries = winnow(codes, gram, window)
                if waiting is not None:
                    size += compared(waiting, (text, codes, entries), out)
                waiting = (batch.column(2)[i].as_py(), text, codes, entries)
                if batch.column(1)[i].as_py():
                    waiting, done_part = None, part
                if size >= FLUSH_CHARS:
                    yield record(out)
                    out, size = [[] for _ in range(7)], 0
        if out[0]:
            yield record(out)

    def compared(row, following, out: list[list]) -> int:
        doc_id, text, codes, entries = row
        next_text, next_codes, next_entries = following
        half = len(codes) // 2
        edited = text[: len(codes) - half] + next_text[:half]
        edited_entries = winnow(np.concatenate([codes[: len(codes) - half], next_codes[:half]]), gram, window)
        values = (
            doc_id,
            len(codes),
            hashlib.sha256(edited.encode()).hexdigest(),
            as_text(entries),
            as_text(edited_entries),
            likeness(entries, edited_entries),
            likeness(entries, next_entries),
        )
        for column, value in zip(out, values):
            column.append(value)
        return len(codes) + 200

    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in SCHEMA.replace("\n", " ").split(",")]

    def record(out: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names)

    return dealt.mapInArrow(run, SCHEMA)
