"""The declared many-to-one joins of the star schema, and joins that look for missing partners."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """``left.key = right.key``; ``right`` has at most one row per key."""

    left: str
    right: str
    key: str


# The joins of the schema.
EDGES = [
    Edge("fact_orders", "dim_products", "product_id"),
    Edge("fact_orders", "dim_geography", "geo_id"),
    Edge("fact_orders", "dim_customers", "customer_id"),
    Edge("fact_orders", "fact_transactions", "order_id"),
    Edge("fact_orders", "fact_shipments", "order_id"),
    Edge("fact_transactions", "fact_shipments", "order_id"),
    Edge("fact_shipments", "dim_geography", "geo_id"),
]


def edge_between(left: str, right: str) -> Edge:
    for edge in EDGES:
        if (edge.left, edge.right) == (left, right):
            return edge
    raise LookupError(f"no join declared from {left} to {right}")


def without_partner(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not occur in ``other``."""
    return df.join(other.select(key), key, "left_anti")


def with_partner(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``other``."""
    return df.join(other.select(key), key, "left_semi")


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once. Empty for a table that is the 'one' side of a join."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def require_single_match(df: DataFrame, key: str) -> None:
    """Fail when a declared many-to-one join would multiply rows."""
    if not repeated_keys(df, key).isEmpty():
        raise ValueError(f"{key} repeats on the 'one' side of a join")


def edge_counts(table: Callable[[str], DataFrame], edges: list[Edge]) -> DataFrame:
    """Per edge: rows of the 'many' side, those with a partner, and keys that repeat on the 'one' side.

    Every table is read once, for all edges it takes part in. A row counts on a side of an edge under its key; sides meet in
    one aggregation per edge and key, which is reduced in each task first, so no table is joined. A null key has no partner.
    """
    sides: dict[str, list] = defaultdict(list)
    for number, edge in enumerate(edges):
        for name, many in ((edge.left, 1), (edge.right, 0)):
            key = F.col(edge.key).cast("bigint").alias("key")
            sides[name].append(F.struct(F.lit(number).alias("edge"), key, F.lit(many).alias("many")))
    seen = reduce(DataFrame.unionByName, [table(name).select(F.inline(F.array(*found))) for name, found in sides.items()])
    per_key = seen.groupBy("edge", "key").agg(F.sum("many").alias("many"), F.sum(1 - F.col("many")).alias("one"))
    partnered = F.col("key").isNotNull() & (F.col("one") > 0)
    names = [F.array(*[F.lit(getattr(edge, side)) for edge in edges]) for side in ("left", "right")]
    return (
        per_key.groupBy("edge")
        .agg(
            F.sum("many").alias("rows"),
            F.sum(F.when(partnered, F.col("many")).otherwise(F.lit(0))).alias("matched_rows"),
            F.count(F.when(F.col("one") > 1, 1)).alias("repeated_keys"),
        )
        .select(
            F.get(names[0], "edge").alias("left_table"),
            F.get(names[1], "edge").alias("right_table"),
            "rows",
            "matched_rows",
            "repeated_keys",
        )
    )


def bucket_imbalance(df: DataFrame, key: str, buckets: int) -> float:
    """Rows in the fullest of ``buckets`` hash buckets of a key, as a multiple of an even share; 0 for an empty table.

    One row per bucket and task is shuffled, however many keys there are.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets)).alias("bucket")
    per_bucket = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("rows"))
    (found,) = per_bucket.agg((F.max("rows") * buckets / F.sum("rows")).alias("imbalance")).collect()
    return found.imbalance or 0.0
