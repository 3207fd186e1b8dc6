"""Approximate nearest neighbours over learned partitions.

On a bounded sample the neighbour graph is built and cut into parts of nearly equal size with few neighbours apart. A small
classifier learns to tell a vector's part. Every vector goes to its most probable part; a query is sent to its several most
probable ones and compared there with every vector. How many, is measured on the sample: as few as find ``TARGET_RECALL`` of
the sample's own nearest neighbours.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martlens.llm.shared import ship, stored

#: The graph and the classifier are fitted on at most so many vectors; all vectors are indexed.
SAMPLE = 4096
#: At most so many parts, so that each has sixteen vectors of a full sample; larger parts are searched in more blocks.
MOST_PARTS = 256
PART_ROWS = 2048
BLOCK_ROWS = 2048
GRAPH_DEGREE = 10
TARGET_RECALL = 0.97
QUERY_STEP = 50
NEAREST = 5


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def neighbour_graph(rows: np.ndarray, degree: int) -> np.ndarray:
    """The ``degree`` nearest other rows of each row."""
    out = []
    for begin in range(0, len(rows), 512):
        cosines = rows[begin : begin + 512] @ rows.T
        cosines[np.arange(len(cosines)), np.arange(begin, begin + len(cosines))] = -2
        out.append(np.argpartition(-cosines, degree - 1, axis=1)[:, :degree])
    return np.concatenate(out)


def balanced_parts(rows: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8) -> np.ndarray:
    """A part for each row, of sizes that differ by 5 % at most, with few graph neighbours apart.

    Starts from halving along the widest direction again and again, then moves rows to where most of their neighbours are, those
    with the largest gain first and only into parts with room.
    """
    part = np.zeros(len(rows), dtype=np.int64)
    todo, fresh = [(np.arange(len(rows)), parts)], 0
    while todo:
        own, count = todo.pop()
        if count == 1:
            part[own] = fresh
            fresh += 1
            continue
        centred = rows[own] - rows[own].mean(axis=0)
        direction = np.linalg.eigh(centred.T @ centred)[1][:, -1]
        order = own[np.argsort(centred @ direction, kind="stable")]
        cut = len(own) * (count // 2) // count
        todo += [(order[:cut], count // 2), (order[cut:], count - count // 2)]
    most = -(-len(rows) * 21 // (20 * parts))
    least = len(rows) * 19 // (20 * parts)
    sizes = np.bincount(part, minlength=parts)
    sources = np.concatenate([np.repeat(np.arange(len(rows)), graph.shape[1]), graph.ravel()])
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(len(rows)), graph.shape[1])])
    for _ in range(rounds):
        votes = np.zeros((len(rows), parts), dtype=np.int64)
        np.add.at(votes, (sources, part[ends]), 1)
        gain = votes.max(axis=1) - votes[np.arange(len(rows)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable"):
            if gain[i] <= 0:
                break
            to = int(votes[i].argmax())
            if sizes[to] < most and sizes[part[i]] > least:
                sizes[part[i]] -= 1
                sizes[to] += 1
                part[i] = to
                moved += 1
        if not moved:
            break
    return part


@dataclass
class Router:
    """A softmax classifier over parts, and how many parts a query is sent to."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def scores(self, rows: np.ndarray) -> np.ndarray:
        return rows @ self.weights + self.bias

    def ranked(self, rows: np.ndarray) -> np.ndarray:
        """The parts of each row, most probable first."""
        return np.argsort(-self.scores(rows), axis=1, kind="stable")


def fit_router(rows: np.ndarray, parts: int, nearest: int = NEAREST, target: float = TARGET_RECALL) -> Router:
    """Learn the parts of a sample and measure how many of them a query needs.

    The measure takes every row as a query whose neighbours are the other rows, and the place of each neighbour's indexed part
    in the query's ranking of parts.
    """
    dimension = rows.shape[1]
    parts = max(1, min(parts, len(rows) // 16))
    weights, bias = np.zeros((dimension, parts)), np.zeros(parts)
    if parts == 1:
        return Router(weights, bias, 1)
    graph = neighbour_graph(rows, min(GRAPH_DEGREE, len(rows) - 1))
    part = balanced_parts(rows, graph, parts)
    wanted = np.eye(parts)[part]
    pace = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(150):
        scores = rows @ weights + bias
        chance = np.exp(scores - scores.max(axis=1, keepdims=True))
        chance /= chance.sum(axis=1, keepdims=True)
        error = (chance - wanted) / len(rows)
        steps = rows.T @ error + 1e-5 * weights, error.sum(axis=0)
        pace = 0.9 * pace[0] - 20.0 * steps[0], 0.9 * pace[1] - 2.0 * steps[1]
        weights, bias = weights + pace[0], bias + pace[1]
    router = Router(weights, bias, parts)
    ranked = router.ranked(rows)
    place = np.empty_like(ranked)
    place[np.arange(len(rows))[:, None], ranked] = np.arange(parts)
    close = graph[:, : min(nearest, graph.shape[1])]
    if graph.shape[1] > nearest:
        cosines = np.einsum("id,ijd->ij", rows, rows[graph])
        close = np.take_along_axis(graph, np.argsort(-cosines, axis=1)[:, :nearest], axis=1)
    reached = np.sort(place[np.arange(len(rows))[:, None], ranked[close, 0]].ravel())
    router.probes = int(reached[min(len(reached) - 1, int(np.ceil(target * len(reached))) - 1)]) + 1
    return router


def taking_part(table: DataFrame) -> DataFrame:
    """(vec_id, embedding) of the rows that can be compared.

    Left out are rows whose id or vector is null, whose vector is empty, zero or holds null or non-finite components, and those
    of another length than the most frequent one (the shorter of two).
    """
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = table.select(F.col("vec_id").cast("long").alias("vec_id"), vector.cast("array<double>").alias("embedding"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False)))
    lengths = rows.groupBy(F.size("embedding").alias("length")).agg(F.count("*").alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").select("length").first()
    return rows.where(F.size("embedding") == (usual["length"] if usual else 0))


def search(
    table: DataFrame,
    query_step: int = QUERY_STEP,
    nearest: int = NEAREST,
    sample: int = SAMPLE,
    target: float = TARGET_RECALL,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest rows of every row whose vec_id is a multiple of ``query_step``.

    The score is the cosine in double precision; ties go to the smaller vec_id. Rows with the same vector are searched as one:
    as candidates they stand for their ``nearest + 1`` smallest ids, of which a query drops its own. Repeated rows count once.
    """
    spark = table.sparkSession
    ship(spark)
    rows = stored(taking_part(table), "vectors")
    keep = nearest + 1
    place = F.row_number().over(Window.partitionBy("embedding").orderBy("vec_id"))
    few = rows.distinct().withColumn("place", place).where(F.col("place") <= keep)
    vectors = few.groupBy("embedding").agg(F.min("vec_id").alias("node"), F.array_sort(F.collect_list("vec_id")).alias("ids"))
    vectors = stored(vectors, "distinct-vectors")
    asked = rows.where(F.col("vec_id") % query_step == 0).distinct()
    queries = stored(
        asked.join(vectors.select("embedding", "node"), "embedding").select(F.col("vec_id").alias("query_id"), "node"), "queries"
    )

    count = vectors.count()
    drawn = vectors.orderBy(F.xxhash64(F.lit(3), "node"), "node").limit(sample).select("embedding").collect()
    router = Router(np.zeros((1, 1)), np.zeros(1), 1)
    if drawn:
        parts = max(4, min(MOST_PARTS, -(-count // part_rows)))
        router = fit_router(unit(np.array([r["embedding"] for r in drawn])), parts, nearest, target)
    weights, bias, probes = router.weights, router.bias, router.probes

    @F.pandas_udf("array<int>")
    def likely_parts(embedding):
        import pandas as pd

        found = Router(weights, bias, probes).ranked(unit(np.stack(embedding.to_numpy())))
        return pd.Series(list(found[:, :probes].astype(np.int32)))

    indexed = stored(vectors.withColumn("parts", likely_parts("embedding")), "indexed-vectors")
    held = indexed.withColumn("part", F.get("parts", F.lit(0)))
    sizes = held.groupBy("part").agg(F.count("*").alias("n"))
    blocks = sizes.select("part", F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("blocks"))
    searched = indexed.join(queries.select("node").distinct(), "node").select(
        "node", "embedding", F.explode("parts").alias("part")
    )
    query_sizes = searched.groupBy("part").agg(F.count("*").alias("n"))
    query_blocks = query_sizes.select("part", F.ceil(F.col("n") / BLOCK_ROWS).cast("long").alias("query_blocks"))
    tiles = blocks.join(query_blocks, "part")
    number = F.xxhash64(F.lit(5), "node")
    # Every block of a part's vectors meets every block of its queries.
    left = held.join(tiles, "part").select(
        "part",
        F.pmod(number, "blocks").alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("query_block"),
        "node",
        "embedding",
        "ids",
    )
    right = searched.join(tiles, "part").select(
        "part",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.pmod(number, "query_blocks").alias("query_block"),
        F.col("node").alias("asker"),
        F.col("embedding").alias("vector"),
    )

    def compare(candidates, asked_here):
        import pandas as pd

        out = []
        if len(candidates) and len(asked_here):
            theirs = np.stack(candidates["embedding"].to_numpy())
            ids = candidates["ids"].tolist()
            norms = np.sqrt((theirs * theirs).sum(axis=1))
            for begin in range(0, len(asked_here), 256):
                some = asked_here.iloc[begin : begin + 256]
                own = np.stack(some["vector"].to_numpy())
                scores = (own @ theirs.T) / (np.sqrt((own * own).sum(axis=1))[:, None] * norms[None, :])
                for node, row in zip(some["asker"], scores):
                    # All that reach the score of the last place, so that ties are settled by id.
                    cut = np.partition(row, -keep)[-keep] if len(row) > keep else -np.inf
                    hits = [(-row[i], int(v)) for i in np.flatnonzero(row >= cut) for v in ids[i]]
                    out += [(int(node), vec_id, -score) for score, vec_id in sorted(hits)[:keep]]
        return pd.DataFrame(out, columns=["node", "vec_id", "score"])

    tile = ["part", "block", "query_block"]
    met = left.groupBy(*tile).cogroup(right.groupBy(*tile)).applyInPandas(compare, "node long, vec_id long, score double")
    order = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "vec_id"))
    best = met.withColumn("place", order).where(F.col("place") <= keep)
    best = best.groupBy("node").agg(F.collect_list(F.struct("place", "vec_id", "score")).alias("hits"))
    others = F.filter(F.array_sort("hits"), lambda h: h["vec_id"] != F.col("query_id"))
    return (
        queries.join(best, "node")
        .select("query_id", F.posexplode(F.slice(others, 1, nearest)))
        .select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), "col.vec_id", "col.score")
    )
