"""Session settings the plans rely on."""

from __future__ import annotations

import math
import re

from pyspark.sql import SparkSession

# Joins on order_id and customer_id may meet a key that holds a large share of all rows. Adaptive execution splits such
# a partition; forcing it keeps the split even when it costs one more shuffle of the (already reduced) join output.
SCALE_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


# Bytes of raw files that one shuffle partition stands for at first, and bytes up to which adaptive execution joins small
# partitions again. Rows are some ten times as large in a task's sort as in the shuffle: larger partitions would spill.
RAW_PER_PARTITION = 4 << 20
SHUFFLED_PER_TASK = 16 << 20

_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "p": 1 << 50}


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) * _UNITS[unit]


def apply_scale_settings(spark: SparkSession, raw_bytes: int = 0) -> None:
    """Set the caller's session to them; opening or building the star schema does so.

    Shuffles get as many partitions as the raw files ask for, so that a task's share stays the same however large they are. More
    partitions, or smaller ones, that the caller has set stay.
    """
    for key, value in SCALE_SETTINGS.items():
        spark.conf.set(key, value)
    partitions = math.ceil(raw_bytes / RAW_PER_PARTITION)
    if partitions > int(spark.conf.get(_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(_PARTITIONS, str(partitions))
    if _bytes(spark.conf.get(_ADVISORY)) > SHUFFLED_PER_TASK:
        spark.conf.set(_ADVISORY, str(SHUFFLED_PER_TASK))
