"""Near-duplicates by Order MinHash and banded alignment.

A text is the sequence of its runs of five words, each labelled by how often it occurred before, so that no label repeats. For
each of 48 seeded orders the seven smallest labelled runs are taken and kept in text order; their hash is one sketch. Texts
that share three sketches are candidates, and the alignment of their sequences decides: they are linked if the runs they share
in order are at least 0.8 of all runs of the two. Texts of at least 100 runs just at that bound share three sketches with a chance
of 0.998 (0.9988 for long ones), more similar ones almost surely (0.99999 at 0.85). Linked texts, and their links in turn, are
one class.

Few sketches of short texts agree. Pairs with a text of under 100 runs are therefore found exactly, by the runs themselves: of
texts that share enough, the rarest run they share is among the rarest few of both (``short_members``).

Exact copies are one node from the start, and only texts with candidates are ever moved. A group of texts that share a sketch
is not paired up: its members are aligned with a few pivots, and go on only as far as they are not in one class yet (``_links``).
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from martlens.llm.shared import BROADCAST_ROWS, mixed, ship, small_batches, small_side, stored, unused

WORDS = 5
SIMILARITY = 0.8
SKETCHES = 48
TAKEN = 7
AGREEING = 3
#: Pairs with a text of fewer runs are found by the runs instead of sketches.
SHORT = 100
#: Pivots of a group in the first round of alignments, and how many times more in each further round.
MORE_PIVOTS = 8
SEED = 7
CACHED_WORDS = 500_000
CELLS = 4_000_000
CHUNK = 512
#: Edges of which a task makes trees at once; so many at most are one task's work, of 2 MB.
EDGES_A_TASK = 100_000


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= CACHED_WORDS:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


_words = WordHashes()


def forget() -> None:
    _words.clear()


def forgetting(run):
    """A task's function that leaves no remembered words to later tasks of its worker."""

    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            forget()

    return wrapped


def runs_of_words(text: str, words: int = WORDS) -> np.ndarray:
    """A hash of every run of ``words`` words, lower-cased and parted by white space; fewer words are one run, none gives none."""
    parts = text.lower().split()
    each = np.fromiter(map(_words.__getitem__, parts), dtype=np.uint64, count=len(parts))
    if not len(each):
        return each
    length = min(words, len(each))
    out = np.zeros(len(each) - length + 1, dtype=np.uint64)
    for i in range(length):
        out = out * np.uint64(0x9E3779B97F4A7C15) + each[i : i + len(out)]
    return mixed(out)


def labelled(runs: np.ndarray) -> np.ndarray:
    """The runs, each told apart from its earlier occurrences."""
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    fresh = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    first = np.maximum.accumulate(np.where(fresh, np.arange(len(runs)), 0))
    number = np.empty(len(runs), dtype=np.uint64)
    number[order] = np.arange(len(runs)) - first
    return mixed(runs + number * np.uint64(0xD6E8FEB86659FD93)) if number.any() else mixed(runs)


def order_minhash(runs: np.ndarray, sketches: int = SKETCHES, taken: int = TAKEN, seed: int = SEED) -> np.ndarray:
    """One hash per seeded order: of the ``taken`` smallest labelled runs, in text order. No runs give no sketch."""
    if not len(runs):
        return np.empty(0, dtype=np.int64)
    labels = labelled(runs)
    seeds = mixed(np.arange(sketches, dtype=np.uint64) + np.uint64(seed * 1000))
    out = np.empty(sketches, dtype=np.uint64)
    step = max(1, CELLS // len(labels))
    for begin in range(0, sketches, step):
        part = seeds[begin : begin + step, None]
        ranks = (labels[None, :] ^ part) * (part | np.uint64(1))
        rows = np.arange(len(ranks))
        chosen = []
        for _ in range(min(taken, len(labels))):
            chosen.append(ranks.argmin(axis=1))
            ranks[rows, chosen[-1]] = np.uint64(0xFFFFFFFFFFFFFFFF)
        places = np.sort(np.stack(chosen, axis=1), axis=1)
        key = seeds[begin : begin + step].copy()
        for column in range(places.shape[1]):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + labels[places[:, column]])
        out[begin : begin + step] = key
    return out.view(np.int64)


def shared_in_order(left: list[int], right: list[int], band: int) -> int:
    """The longest common subsequence of two sequences, of pairs of places at most ``band`` apart.

    Rows are places of ``left``. One big integer holds, for the rows near the diagonal of a chunk of columns, whether the
    length grows from a row to the next (a zero bit) as it stands after the last column; the next value of ``right`` is one
    addition. Rows that leave the window have their growth added up; rows that enter have none yet.
    """
    begin = 0
    while begin < min(len(left), len(right)) and left[begin] == right[begin]:
        begin += 1
    left, right = left[begin:], right[begin:]
    end = 0
    while end < min(len(left), len(right)) and left[-1 - end] == right[-1 - end]:
        end += 1
    left, right = left[: len(left) - end], right[: len(right) - end]
    if not left or not right:
        return begin + end
    places: dict[int, int] = {}
    for i, value in enumerate(left):
        places[value] = places.get(value, 0) | 1 << i
    rows = len(left)
    width = min(rows, CHUNK + 2 * band + 2)
    mask = (1 << width) - 1
    low, grown, flat = 0, 0, mask
    for start in range(0, len(right), CHUNK):
        shift = min(max(0, start - band - 1), rows - width) - low
        if shift > 0:
            gone = (1 << shift) - 1
            grown += shift - (flat & gone).bit_count()
            flat = flat >> shift | gone << (width - shift)
            low += shift
        for value in right[start : start + CHUNK]:
            match = flat & (places.get(value, 0) >> low)
            if match:
                flat = ((flat + match) | (flat - match)) & mask
    return begin + end + grown + width - flat.bit_count()


def least_shared(left: int, right: int, similarity: float = SIMILARITY) -> int:
    """How many runs linked sequences of these lengths share in order at least."""
    return math.ceil(similarity * (left + right) / (1 + similarity) - 1e-9)


def linked(left: np.ndarray, right: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two sequences of runs share enough in order; those that share too little in any order are not aligned."""
    least = least_shared(len(left), len(right), similarity)
    if min(len(left), len(right)) < least:
        return False
    if len(np.intersect1d(labelled(left), labelled(right), assume_unique=True)) < least:
        return False
    # With so much shared, no pair of shared places is further apart than all the rest.
    band = len(left) + len(right) - 2 * least
    return shared_in_order(left.tolist(), right.tolist(), band) >= least


def sketched(documents: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(doc_id, digest, n, sketches, labels) of every document that has words; n counts its runs.

    Texts of ``SHORT`` runs have sketches, shorter ones and those that may be linked to shorter ones have their labelled runs.
    """
    ship(documents.sparkSession)
    small_batches(documents.sparkSession)
    most = (SHORT - 1) / similarity + 1e-9

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py()
                runs = runs_of_words(text, words)
                if len(runs):
                    sketches = order_minhash(runs) if len(runs) >= SHORT else None
                    labels = labelled(runs).view(np.int64) if len(runs) <= most else None
                    digest = hashlib.sha256(text.encode()).digest()[:16]
                    for column, item in zip(out, (doc_id.as_py(), digest, len(runs), sketches, labels)):
                        column.append(item)
            kinds = [pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(out, kinds)], ["doc_id", "digest", "n", "sketches", "labels"]
            )

    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(
        forgetting(run), "doc_id long, digest binary, n long, sketches array<long>, labels array<long>"
    )


def aligned(pairs: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """(a, b, linked) of pairs (a, b) of nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, runs, found = None, None, []
            for left, right in zip(batch.column(2), batch.column(3)):
                if (text := right.as_py()) != kept:
                    kept, runs = text, runs_of_words(text, words)
                found.append(linked(runs_of_words(left.as_py(), words), runs, similarity))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(found, pa.bool_())], ["a", "b", "linked"]
            )

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "a_text", "b_text")
    return both.mapInArrow(forgetting(run), "a long, b long, linked boolean")


def only_here(texts: DataFrame, words: int) -> DataFrame:
    """(node, only): how many labelled runs of a text no other of the texts has; texts without such runs are left out."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0), batch.column(1)):
                found = labelled(runs_of_words(text.as_py(), words)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(found), node.as_py())), pa.array(found)], ["node", "run"]
                )

    runs = texts.select("node", "text").mapInArrow(forgetting(run), "node long, run long")
    single = runs.groupBy("run").agg(F.count("*").alias("texts"), F.min("node").alias("node")).where("texts = 1")
    return single.groupBy("node").agg(F.count("*").alias("only"))


def short_members(nodes: DataFrame, similarity: float) -> DataFrame:
    """(bucket, node, n, common, marks) of short nodes (node, n, labels) that can have a link, in shared buckets.

    ``marks`` are the runs that some other short text has, too, the rarest first, and ``common`` counts them. Of n runs a
    link needs at least ``similarity * n`` shared ones, all of them among these; so the first one shared with a linked text has
    so many less one behind it. The runs up to there are the buckets. Common passages come last and make none.
    """
    runs = nodes.where("labels IS NOT NULL").select("node", "n", F.explode("labels").alias("label"))
    counts = stored(runs.groupBy("label").agg(F.count("*").alias("texts")).where("texts > 1"), "near-short-runs")
    ordered = F.array_sort(F.collect_list(F.struct("texts", "label")))
    held = runs.join(small_side(counts), "label").groupBy("node", "n").agg(ordered.alias("held"))
    held = held.select("node", "n", F.size("held").alias("common"), F.col("held.label").alias("marks"))
    spare = (F.col("common") - F.ceil(F.col("n") * similarity - 1e-9)).cast("int")
    kept = held.where(spare >= 0).withColumn("bucket", F.explode(F.slice("marks", F.lit(1), spare + 1)))
    kept = stored(kept, "near-short")
    groups = kept.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    return kept.join(groups.where("least < most").select("bucket"), "bucket")


def linkable(nodes: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """(bucket, node, n, common, marks) of nodes (node, n, sketches) that can have a link at all, in shared buckets.

    ``common`` counts the runs that some other text has, too. Two texts share no more than what each has in common with any
    other text: most texts that share just a passage, or have too many edits, are told by that alone.
    """
    only = stored(only_here(texts, words), "near-only")
    counted = nodes.join(small_side(only), "node", "left").withColumn("common", F.col("n") - F.coalesce("only", F.lit(0)))
    kept = counted.where(F.col("common") >= F.col("n") * similarity - 1e-9)
    kept = kept.select(F.explode("sketches").alias("bucket"), "node", "n", "common", F.col("sketches").alias("marks"))
    groups = kept.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    return kept.join(groups.where("least < most").select("bucket"), "bucket")


def _links(members: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """(node, root) of the classes that the links make inside groups of texts that share a sketch or a rare run.

    Members are (bucket, node, n, common, marks, by_run) with the runs that a text has, and has in common with any other. The
    marks are the sketches, or the runs in groups by runs.

    In each round the members of a group are aligned with its pivots, its first members: one at first, then more. A pivot has
    then met all others and leaves. A group is done when all its members are in one class, by whatever links. Two texts meet in
    the group of the first sketch they share, and only if they share ``AGREEING``, or of the first run, and only if they share
    enough runs in any order. Such texts that stay in different classes have therefore been aligned, or have too few common runs
    for their lengths: no link between classes is lost. A large group of like texts ends after a round or two.
    """
    tested, roots, pivots = None, None, 1
    members = members.withColumn("root", F.col("node"))
    while True:
        if pivots == 1:
            first = members.groupBy("bucket").agg(F.min("node").alias("node")).join(members, ["bucket", "node"])
        else:
            place = F.row_number().over(Window.partitionBy("bucket").orderBy("node"))
            first = members.withColumn("place", place).where(F.col("place") <= pivots)
        named = [F.col(c).alias(f"pivot_{c}") for c in ("node", "n", "common", "marks", "root")]
        first = stored(first.select("bucket", *named), "near-pivots")
        least = F.ceil(similarity * (F.col("n") + F.col("pivot_n")) / (1 + similarity) - 1e-9)
        enough = F.least("common", "pivot_common") >= least
        # Both arrays have the shared ones in the same order.
        same = F.array_intersect("marks", "pivot_marks")
        asked = F.when(F.col("by_run"), least).otherwise(AGREEING)
        agreeing = (F.size(same) >= asked) & (F.get(same, F.lit(0)) == F.col("bucket"))
        near = members.join(first, "bucket").where((F.col("root") != F.col("pivot_root")) & enough & agreeing)
        pairs = near.select(F.greatest("node", "pivot_node").alias("a"), F.least("node", "pivot_node").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        found = stored(aligned(pairs, texts, similarity, words), "near-aligned")
        tested = found.select("a", "b") if tested is None else tested.unionByName(found.select("a", "b"))
        fresh = found.where("linked").select("a", "b")
        if roots is None:
            roots = components(fresh)
        elif not fresh.isEmpty():
            roots = components(fresh.unionByName(roots.select(F.col("node").alias("a"), F.col("root").alias("b"))))

        stays = members.join(first.select("bucket", F.col("pivot_node").alias("node")), ["bucket", "node"], "left_anti")
        stays = stays.drop("root").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        spread = stays.groupBy("bucket").agg(F.min("root").alias("least"), F.max("root").alias("most"))
        open_ = spread.where("least < most").select("bucket")
        kept = ["bucket", "node", "n", "common", "marks", "by_run", "root"]
        members = stored(stays.join(open_, "bucket").select(*kept), "near-open")
        if members.isEmpty():
            return roots
        pivots *= MORE_PIVOTS


def hung_on_smallest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) that link the same nodes: each other node of a component with its smallest, ``EDGES_A_TASK`` edges at a time."""
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.setdefault(x, x)) != x:
            root[x] = x = root[up]
        return x

    def trees() -> pa.RecordBatch:
        out = [(u, v) for u, v in ((x, find(x)) for x in list(root)) if u != v]
        return pa.RecordBatch.from_arrays([pa.array([edge[i] for edge in out], pa.int64()) for i in (0, 1)], ["u", "v"])

    for batch in batches:
        # A component's edges may come in several parts, so its nodes may be hung on several.
        if len(root) > 2 * EDGES_A_TASK:
            yield trees()
            root.clear()
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = find(u), find(v)
            root[max(u, v)] = min(u, v)
    yield trees()


def components(links: DataFrame) -> DataFrame:
    """(node, root): the smallest node of each connected component of the links (a, b), for nodes that have links.

    Tasks first replace their edges by trees. That is all if one task holds the edges, as it does if they are few: every round
    of the steps below costs the driver plans, threads and results of tasks, however small it is. Else alternates two steps until
    nothing changes: a node's larger neighbours are hung on its smallest neighbour, then its smaller ones. Rows that repeat are
    dropped before each shuffle. Edges that are few by their count are not shuffled for the joins, as the smallest neighbours
    are sent to them, and are written as a few files.
    """
    ship(links.sparkSession)
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v"), "edges")
    one = edges.count() <= EDGES_A_TASK
    dealt = edges.coalesce(1) if one else edges.distinct()
    edges = stored(dealt.mapInArrow(hung_on_smallest, "u long, v long"), "edges")
    if one:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))

    def digest() -> Row:
        return edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("sum")).first()

    before = digest()
    while True:
        few = 2 * before["n"] <= BROADCAST_ROWS

        def sent(least: DataFrame, few: bool = few) -> DataFrame:
            return F.broadcast(least) if few else least

        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
        large = both.join(sent(least), "u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        large = large.where("u > v")
        large = large if few else large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("least"))
        small = large.join(sent(least), "u")
        small = small.select("u", F.col("least").alias("v")).unionByName(
            small.where(F.col("v") > F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
        )
        small = small.distinct()
        edges = stored(small.repartition(math.ceil(before["n"] / EDGES_A_TASK) or 1) if few else small, "edges")
        sums = digest()
        if sums == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = sums


def near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """One row per document: doc_id, class_id (smallest doc_id of its class) and class_size (its doc_ids).

    Documents with the same text are one class. A text that is null or has no words is alike to nothing, and a row without a
    doc_id is in no class: its class_id is null. Rows that share a doc_id count as one document; each is returned.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"))
    known = class_table(documents, similarity, words).withColumnRenamed("doc_id", "_id")
    return rows.join(known, F.col("doc_id") == F.col("_id"), "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def class_table(documents: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """(doc_id, class_id, class_size), one row per doc_id that has words, stored."""
    found = stored(sketched(documents, similarity, words), "near-sketched")
    # Of several texts of a repeated doc_id, the one with the smallest digest stands for it.
    one_text = F.struct("digest", "n", "sketches", "labels")
    nodes = found.groupBy("digest").agg(F.min("doc_id").alias("node"), F.first(one_text).alias("text"))
    nodes = nodes.groupBy("node").agg(F.min_by("text", "digest").alias("text")).select("node", "text.*")
    nodes = stored(nodes, "near-nodes")
    members = nodes.where("sketches IS NOT NULL").select("node", F.explode("sketches").alias("bucket"))
    shared = members.groupBy("bucket").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    shared = shared.where("least < most").select("bucket")
    by_sketch = stored(members.join(shared, "bucket").select("node").distinct(), "near-wanted")
    short = stored(short_members(nodes, similarity), "near-short-members")
    wanted = small_side(stored(by_sketch.unionByName(short.select("node")).distinct(), "near-wanted"))

    own = documents.select(F.col("doc_id").cast("long").alias("node"), "text").where("text IS NOT NULL")
    texts = own.join(wanted, "node").groupBy("node").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    texts = stored(texts, "near-texts")
    by_sketch = small_side(by_sketch)
    long = linkable(nodes.join(by_sketch, "node"), texts.join(by_sketch, "node"), similarity, words)
    members = long.withColumn("by_run", F.lit(False)).unionByName(short.withColumn("by_run", F.lit(True)))
    roots = _links(stored(members, "near-members"), texts, similarity, words)

    # Which node a document's text is; a document with several texts (a repeated doc_id) joins the classes of all of them.
    by_text = found.select("doc_id", "digest").distinct()
    copies = by_text.join(by_text.groupBy("digest").agg(F.min("doc_id").alias("node")), "digest")
    spread = stored(copies.groupBy("doc_id").agg(F.min("node").alias("node"), F.max("node").alias("most")), "near-copies")
    several = spread.where("node < most")
    if not several.isEmpty():
        bridges = copies.join(several.select("doc_id", F.col("node").alias("b")), "doc_id").select(F.col("node").alias("a"), "b")
        roots = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(bridges))
    classed = spread.join(roots, "node", "left").select("doc_id", F.coalesce("root", "node").alias("root"))
    sizes = classed.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    return stored(classed.join(sizes, "root").select("doc_id", "class_id", "class_size"), "near-classes")


def without_near_duplicates(documents: DataFrame, similarity: float = SIMILARITY, words: int = WORDS) -> DataFrame:
    """The documents less all but one of each class: the smallest doc_id stays, once if its row repeats.

    Documents without a doc_id, and those without words, stay.
    """
    classes = class_table(documents, similarity, words)
    own, times = unused("_id", documents.columns), unused("_n", documents.columns)
    dropped = stored(classes.where("doc_id <> class_id").select(F.col("doc_id").alias(own)), "near-dropped")
    kept = documents.join(small_side(dropped), F.col("doc_id") == F.col(own), "left_anti")
    known = documents.where("doc_id IS NOT NULL")
    repeated = known.groupBy(F.col("doc_id").alias(own)).agg(F.count("*").alias(times)).where(F.col(times) > 1).select(own)
    repeated = stored(repeated, "near-repeated")
    if repeated.isEmpty():
        return kept
    repeated = small_side(repeated)
    several = kept.join(repeated, F.col("doc_id") == F.col(own), "left_semi").dropDuplicates(["doc_id"])
    return kept.join(repeated, F.col("doc_id") == F.col(own), "left_anti").unionByName(several)
