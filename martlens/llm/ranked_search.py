"""Ranked lexical search with bit-sliced Bloom signatures.

Documents of like size share a matrix of bits, one column each. Every term of a document, with the number of times it occurs
at least (1, 2, 4, 8), sets the rows that three hashes name. A row read across all columns is a slice: the conjunction of the
slices of a term tells which documents hold it, and never misses one. Slices weighted by what a term can add at most to a score
sum to an upper bound for every document. The best bounds are scored exactly first; the 20th of these scores is a floor, and
every document whose bound reaches it is scored exactly. So nothing is left out but what provably cannot be among the best.

The matrices do not depend on the queries and are stored. Queries are handled in blocks of bounded size.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import mixed, ship, stored

BEST = 20
HASHES = 3
BITS_PER_KEY = 8
LEVELS = (1, 2, 4, 8)
#: Bits of one matrix, and the most rows and columns it may have. A longer text has the same rows, more of them set.
CELLS, MOST_ROWS, MOST_COLUMNS = 2**22, 2**20, 4096
#: Columns whose bounds are worked out at a time.
COLUMNS = 512
#: Most items and most different terms of a block of queries; an item of more terms is a block of its own.
BLOCK_ITEMS, BLOCK_TERMS = 256, 16_384
#: Scored texts that a task remembers.
SEEN_TEXTS = 50_000

# ASCII letters and digits and everything beyond ASCII make terms, A-Z count as a-z.
_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(128, 256))
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEPT else 32 for b in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def text_bytes(value: pa.Scalar) -> bytes:
    return value.as_buffer().to_pybytes() if value.is_valid else b""


def hashes(found: Iterable[bytes], count: int) -> np.ndarray:
    from xxhash import xxh3_64_intdigest

    return np.fromiter(map(xxh3_64_intdigest, found), dtype=np.uint64, count=count)


def at_level(of_terms: np.ndarray, level: int) -> np.ndarray:
    return mixed(of_terms + np.uint64(level * 0x9E3779B97F4A7C15 % 2**64))


def rows_of(keys: np.ndarray, rows: int) -> list[np.ndarray]:
    """The row of each key for each hash; ``rows`` is a power of two."""
    shift = np.uint64(64 - rows.bit_length() + 1)
    odd = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]
    return [((keys * np.uint64(m)) >> shift).astype(np.int64) for m in odd[:HASHES]]


# ---- the stored matrices -----------------------------------------------------------------------------------------

MATRIX = "rows long, doc_ids array<long>, digests array<string>, sizes array<long>, slices binary"
_KINDS = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
_NAMES = [column.split()[0] for column in MATRIX.split(", ")]


@dataclass
class Open:
    """Columns of a matrix that is not full yet."""

    doc_ids: list = field(default_factory=list)
    digests: list[str] = field(default_factory=list)
    sizes: list[int] = field(default_factory=list)
    keys: list[np.ndarray] = field(default_factory=list)

    def batch(self, rows: int) -> pa.RecordBatch:
        width = -(-len(self.keys) // 8) * 8
        bits = np.zeros((rows, width), dtype=bool)
        column = np.repeat(np.arange(len(self.keys)), [len(k) for k in self.keys])
        for row in rows_of(np.concatenate(self.keys), rows):
            bits[row, column] = True
        values = [[rows], [self.doc_ids], [self.digests], [self.sizes], [np.packbits(bits, axis=1).tobytes()]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, _KINDS)], _NAMES)


def signatures(documents: DataFrame) -> DataFrame:
    """One row per matrix: its number of rows, and of each column doc_id, MD5 of the text and number of terms; its slices.

    A document without a term has no column. Full matrices leave the task at once, the others at its end.
    """
    ship(documents.sparkSession)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: dict[int, Open] = {}
        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                text = text_bytes(value)
                found = Counter(terms(text))
                if not found:
                    continue
                counts = np.fromiter(found.values(), dtype=np.int64, count=len(found))
                of_terms = hashes(found, len(found))
                keys = np.concatenate([at_level(of_terms[counts >= level], level) for level in LEVELS])
                rows = min(MOST_ROWS, 1 << max(6, (BITS_PER_KEY * len(keys) - 1).bit_length()))
                own = open_.setdefault(rows, Open())
                own.doc_ids.append(doc_id.as_py())
                own.digests.append(hashlib.md5(text).hexdigest())
                own.sizes.append(int(counts.sum()))
                own.keys.append(keys)
                if len(own.keys) >= max(8, min(MOST_COLUMNS, CELLS // rows)):
                    yield open_.pop(rows).batch(rows)
        for rows, own in open_.items():
            yield own.batch(rows)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, MATRIX)


# ---- queries -----------------------------------------------------------------------------------------------------


@dataclass
class Block:
    """Some items: their ids, and the numbers and counts of their terms; weights once the corpus is known."""

    item_ids: list = field(default_factory=list)
    of_items: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    numbers: dict[bytes, int] = field(default_factory=dict)
    weights: np.ndarray | None = None
    documents: int = 0
    length: int = 0

    def add(self, item_id, found: Counter) -> None:
        numbers = [self.numbers.setdefault(term, len(self.numbers)) for term in found]
        self.item_ids.append(item_id)
        self.of_items.append((np.array(numbers, dtype=np.int64), np.array(list(found.values()), dtype=np.int64)))

    def full(self, found: Counter) -> bool:
        more = len(self.numbers) + len(found) > BLOCK_TERMS
        return bool(self.item_ids) and (more or len(self.item_ids) >= BLOCK_ITEMS)

    def damping(self, size: int) -> int:
        return 100 - 25 + 25 * size * self.documents // self.length


def blocks(items: DataFrame) -> Iterator[Block]:
    """The items that have terms, in blocks; every row is an item of its own, and repeated terms count as often."""
    block = Block()
    for row in items.select("item_id", "text").orderBy("item_id", "text").toLocalIterator():
        found = Counter(terms((row["text"] or "").encode()))
        if found:
            if block.full(found):
                yield block
                block = Block()
            block.add(row["item_id"], found)
    if block.item_ids:
        yield block


def weigh(documents: DataFrame, block: Block) -> None:
    """Count, over all documents, those with terms, all terms, and the documents of each term of the block; set the weights."""
    held = documents.sparkSession.sparkContext.broadcast(block.numbers)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, with_terms, length, holding = held.value, 0, 0, Counter()
        for batch in batches:
            for value in batch.column(0):
                found = terms(text_bytes(value))
                with_terms += bool(found)
                length += len(found)
                holding.update(numbers[t] for t in set(found).intersection(numbers))
        keys, values = [-1, -2, *holding], [with_terms, length, *holding.values()]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(values, pa.int64())], ["number", "n"])

    counted = documents.select("text").mapInArrow(run, "number long, n long").groupBy("number").agg(F.sum("n").alias("n"))
    known = {row["number"]: row["n"] for row in counted.collect()}
    block.documents, block.length = known.get(-1, 0), known.get(-2, 0)
    block.weights = np.array(
        [
            math.floor(1000 * math.log((2 * block.documents + 2) / (2 * known[number] + 1))) if number in known else 0
            for number in range(len(block.numbers))
        ],
        dtype=np.int64,
    )


def share(occurrences, damping):
    return 1_000_000_000 * occurrences // (1000 * occurrences + 12 * damping)


class Bounds:
    """Upper bounds of the scores of a matrix's columns for the items of a block."""

    def __init__(self, block: Block, of_terms: np.ndarray):
        self.block = block
        # Terms that no document holds, or that weigh nothing, add nothing.
        self.used = np.flatnonzero(block.weights > 0)
        self.weights = block.weights[self.used]
        self.keys = [at_level(of_terms[self.used], level) for level in LEVELS]
        place = np.full(len(block.weights), -1, dtype=np.int64)
        place[self.used] = np.arange(len(self.used))
        self.of_items = [(place[n][place[n] >= 0], c[place[n] >= 0]) for n, c in block.of_items]

    def of(self, rows: int, sizes: np.ndarray, slices: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """First column and bounds (items by columns) of a few columns at a time."""
        found = [rows_of(keys, rows) for keys in self.keys]
        for first in range(0, len(sizes), COLUMNS):
            here = sizes[first : first + COLUMNS]
            part = slices[:, first // 8 : (first + COLUMNS) // 8]
            damping = 75 + 25 * here * self.block.documents // self.block.length
            total = np.zeros((len(self.keys[0]), len(here)), dtype=np.int64)
            held, before = None, 0
            for level, of_hashes in enumerate(found):
                both = part[of_hashes[0]]
                for row in of_hashes[1:]:
                    both = both & part[row]
                held = both if held is None else held & both
                # The most occurrences that do not reach the next level.
                most = np.minimum(here, LEVELS[level + 1] - 1) if level + 1 < len(LEVELS) else here
                value = share(most, damping)
                total += np.unpackbits(held, axis=1, count=len(here)) * (value - before)
                before = value
            total *= self.weights[:, None]
            yield first, np.stack([(total[n] * c[:, None]).sum(axis=0) for n, c in self.of_items])


def bound_rows(matrices: DataFrame, block: Block, floors: np.ndarray | None) -> DataFrame:
    """(item, digest, doc_id, bound): without floors each task's best ``BEST`` of an item, else all that reach its floor."""
    spark = matrices.sparkSession
    of_terms = hashes(block.numbers, len(block.numbers))
    held = spark.sparkContext.broadcast((block, of_terms, floors))
    names = ["item", "digest", "doc_id", "bound"]
    kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, of_terms, floors = held.value
        bounds = Bounds(block, of_terms)
        best: list[list[tuple]] = [[] for _ in block.item_ids]
        least = np.zeros(len(best), dtype=np.int64)
        for batch in batches:
            for rows, doc_ids, digests, sizes, slices in zip(*[batch.column(i) for i in range(5)]):
                rows, doc_ids, digests = rows.as_py(), doc_ids.as_py(), digests.as_py()
                bits = np.frombuffer(slices.as_py(), dtype=np.uint8).reshape(rows, -1)
                out: list[tuple] = []
                for first, found in bounds.of(rows, np.array(sizes.as_py(), dtype=np.int64), bits):
                    wanted = found >= floors[:, None] if floors is not None else found > least[:, None]
                    for item in np.flatnonzero(wanted.any(axis=1)):
                        columns = np.flatnonzero(wanted[item])
                        if floors is None and len(columns) > BEST:
                            columns = columns[np.argpartition(-found[item, columns], BEST - 1)[:BEST]]
                        more = [
                            (int(item), digests[first + c], doc_ids[first + c], bound)
                            for c, bound in zip(columns.tolist(), found[item, columns].tolist())
                        ]
                        if floors is not None:
                            out += more
                        else:
                            best[item] = sorted(best[item] + more, key=lambda r: (-r[3], r[1]))[:BEST]
                            least[item] = best[item][-1][3] if len(best[item]) == BEST else 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)
        rest = [row for rows in best for row in rows]
        if rest:
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rest), kinds)], names)

    return matrices.mapInArrow(run, "item int, digest string, doc_id long, bound long")


def exact_scores(asked: DataFrame, block: Block) -> DataFrame:
    """(item, digest, score) of rows (digest, text, items); a text that a task meets again is not scored again."""
    held = asked.sparkSession.sparkContext.broadcast(block)
    names, kinds = ["item", "digest", "score"], [pa.int32(), pa.string(), pa.int64()]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, seen = held.value, set()
        for batch in batches:
            out = []
            for digest, value, items in zip(batch.column(0), batch.column(1), batch.column(2)):
                digest = digest.as_py()
                if digest in seen:
                    continue
                if len(seen) > SEEN_TEXTS:
                    seen.clear()
                seen.add(digest)
                found = terms(text_bytes(value))
                damping, counts = block.damping(len(found)), np.zeros(len(block.numbers), dtype=np.int64)
                for term, count in Counter(found).items():
                    if (number := block.numbers.get(term)) is not None:
                        counts[number] = count
                of_terms = block.weights * share(counts, damping)
                for item in items.as_py():
                    numbers, times = block.of_items[item]
                    out.append((item, digest, int((of_terms[numbers] * times).sum())))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*out), kinds)], names)

    return asked.select("digest", "text", "items").mapInArrow(run, "item int, digest string, score long").distinct()


def scored(documents: DataFrame, pairs: DataFrame, block: Block, name: str) -> DataFrame:
    """The exact scores of pairs (item, digest), one row for each."""
    wanted = stored(pairs.groupBy("digest").agg(F.collect_set("item").alias("items")), f"{name}-asked")
    texts = documents.select(F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("digest"), "text")
    return stored(exact_scores(texts.join(wanted, "digest"), block), f"{name}-scores")


def first_documents(pairs: DataFrame) -> DataFrame:
    """Of each item and text the ``BEST`` smallest doc_ids; no more can be among an item's best."""
    by_id = Window.partitionBy("item", "digest").orderBy(F.asc_nulls_last("doc_id"))
    placed = pairs.withColumn("place", F.row_number().over(by_id))
    return placed.where(F.col("place") <= BEST).drop("place", "bound")


def search_block(documents: DataFrame, matrices: DataFrame, block: Block) -> DataFrame:
    """item (number in the block), rank, doc_id, score."""
    weigh(documents, block)
    by_bound = Window.partitionBy("item").orderBy(F.desc("bound"), "digest")
    first = bound_rows(matrices, block, None).withColumn("place", F.row_number().over(by_bound))
    first = stored(first.where(F.col("place") <= BEST).drop("place"), "search-first")
    known = scored(documents, first, block, "search-first")
    by_score = Window.partitionBy("item").orderBy(F.desc("score"))
    last = (
        first.join(known, ["item", "digest"])
        .withColumn("place", F.row_number().over(by_score))
        .where(F.col("place") == BEST)
        .select("item", "score")
    )
    # No document with less can be among the best; an item with fewer documents keeps all above 0.
    floors = np.ones(len(block.item_ids), dtype=np.int64)
    for row in last.collect():
        floors[row["item"]] = max(1, row["score"])
    open_ = stored(first_documents(bound_rows(matrices, block, floors)), "search-open")
    found = open_.join(scored(documents, open_, block, "search-open"), ["item", "digest"]).where("score > 0")
    by_rank = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= BEST)
    return ranked.select("item", "rank", "doc_id", "score")


def search(documents: DataFrame, items: DataFrame) -> DataFrame:
    """The 20 best documents of each item: item_id, rank, doc_id, score.

    Every row of ``items`` is a query of its own, also one with a repeated or null id; one without terms finds nothing. Repeated
    rows of ``documents`` are ranked each; equal scores go by doc_id, null ones last.
    """
    spark = documents.sparkSession
    ship(spark)
    matrices, parts = None, []
    for block in blocks(items):
        matrices = stored(signatures(documents), "search-signatures") if matrices is None else matrices
        found = stored(search_block(documents, matrices, block), "search-found")
        kind = items.schema["item_id"].dataType.simpleString()
        ids = spark.createDataFrame(list(enumerate(block.item_ids)), f"item int, item_id {kind}")
        parts.append(found.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score"))
    if not parts:
        kind = items.schema["item_id"].dataType.simpleString()
        return spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
