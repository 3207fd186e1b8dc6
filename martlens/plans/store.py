"""The star schema as files: built once, published whole, and read by any session as long as its raw files are unchanged.

    <folder>/<digest of the raw folder>/<version>/<table>/…
    <folder>/<digest of the raw folder>/<version>/published.json

A build writes a version of its own and publishes it last, so builds never mix and readers never see half of one. What is
published names the raw files with size and time of change and a digest of the code that derives the tables: a version that
does not fit both is not opened. Older versions stay until someone removes them.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import date
from functools import cache
from weakref import WeakKeyDictionary

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from martlens.operators import cleaning
from martlens.operators.values import value_index
from martlens.plans import gold as gold_tables
from martlens.plans import silver
from martlens.plans.gold import (
    INDEXED_COLUMNS,
    ORDER_TOTALS,
    TABLE_COMMENTS,
    Gold,
    derive_dimensions,
    derive_lines,
    derive_order_totals,
    derive_paid_lines,
    derive_roll_ups,
    plain_lines,
)
from martlens.session import apply_scale_settings
from martlens.sources import files, landing, raw
from martlens.sources.catalog import overwrite_files
from martlens.sources.raw import RAW_SCHEMAS, read_raw

INDEX = "value_index"

# Clean lines on their way: payments are rolled up from them, and they are stored for good with what their payment says.
UNPAID = "unpaid_lines"

# What each session has opened, by version. A version never changes, and a session's frames are its own.
_read: WeakKeyDictionary[SparkSession, dict[str, Store]] = WeakKeyDictionary()


class StaleStore(RuntimeError):
    """No published version fits the raw files as they are now."""


@dataclass(frozen=True)
class Store:
    """A published version: the tables, the value index, and the rows that were counted while each was written."""

    gold: Gold
    index: DataFrame
    written_rows: dict[str, int]
    comments: dict[str, str]


def store_folder(spark: SparkSession) -> str:
    """Where the registered queries keep their tables: the shared folder of the cluster, else the warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/martlens"


@cache
def _definition() -> str:
    modules = [cleaning, gold_tables, landing, raw, silver]
    return hashlib.sha256("".join(inspect.getsource(m) for m in modules).encode()).hexdigest()


def _raw_files(spark: SparkSession, raw_dir: str) -> dict[str, list]:
    return {name: files.data_files(spark, f"{raw_dir}/{name}.parquet") for name in RAW_SCHEMAS}


def _size(sources: dict[str, list]) -> int:
    return sum(size for found in sources.values() for _, size, _ in found)


def _versions(folder: str, raw_dir: str) -> str:
    return f"{folder}/{hashlib.sha256(raw_dir.encode()).hexdigest()[:16]}"


def open_store(spark: SparkSession, raw_dir: str, folder: str) -> Store:
    """The latest published version that was built from the raw files as they are now, read by this session."""
    sources, definition = _raw_files(spark, raw_dir), _definition()
    versions = _versions(folder, raw_dir)
    opened = _read.setdefault(spark, {})
    for version in reversed(files.names_in(spark, versions)):
        path = f"{versions}/{version}"
        text = files.read_text(spark, f"{path}/published.json")
        published = json.loads(text) if text else {}
        if published.get("sources") == sources and published.get("definition") == definition:
            apply_scale_settings(spark, _size(sources))
            if path in opened:
                return opened[path]
            frames = {
                name: spark.read.schema(T.StructType.fromJson(schema)).parquet(f"{path}/{name}")
                for name, schema in published["schemas"].items()
            }
            # A column kept in folder names comes back without its comment.
            for name in gold_tables.MONTHS:
                frames[name] = gold_tables.documented(name, frames[name])
            index, latest = frames.pop(INDEX), published["latest_month"]
            if not published["single_orders"]:
                del frames[ORDER_TOTALS]
            paid = frames.pop("fact_orders")
            lines = plain_lines(paid)
            gold = Gold(fact_orders=lines, paid_lines=paid, **frames, latest_month=latest and date.fromisoformat(latest))
            opened[path] = Store(gold, index, published["rows"], published["comments"])
            return opened[path]
    raise StaleStore(f"nothing under {versions} was built from the files of {raw_dir} as they are now")


def build_store(spark: SparkSession, raw_dir: str, folder: str) -> Store:
    """Build a version from the raw folder, publish and open it.

    Clean lines are written first; payments and shipments are rolled up from the written lines, so the join and clean-up of the
    line table run once, and the order totals from all three. The lines are then stored by month with their payment's columns, and
    the first writing is removed. Tables that do not depend on each other are written by concurrent jobs.
    """
    sources = _raw_files(spark, raw_dir)
    apply_scale_settings(spark, _size(sources))
    version = f"{_versions(folder, raw_dir)}/{time.time_ns()}-{uuid.uuid4().hex[:8]}"
    rows: dict[str, int] = {}
    schemas: dict[str, dict] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        ready, month = gold_tables.in_storage_order(name, df)
        rows[name] = overwrite_files(ready, f"{version}/{name}", month)
        schemas[name] = df.schema.jsonValue()
        return spark.read.schema(df.schema).parquet(f"{version}/{name}")

    def job(name: str, df: DataFrame) -> Callable[[], DataFrame]:
        return inheritable_thread_target(spark)(lambda: write(name, df))

    tables = read_raw(spark, raw_dir)
    with ThreadPoolExecutor() as pool:
        lines = pool.submit(job(UNPAID, derive_lines(tables)))
        running = {name: pool.submit(job(name, df)) for name, df in derive_dimensions(tables).items()}
        running |= {name: pool.submit(job(name, df)) for name, df in derive_roll_ups(lines.result()).items()}
        stored = {name: written.result() for name, written in running.items()}
        facts = [lines.result(), stored["fact_transactions"], stored["fact_shipments"]]
        totals = pool.submit(job(ORDER_TOTALS, derive_order_totals(*facts)))
        paid = pool.submit(job("fact_orders", derive_paid_lines(*facts[:2])))
        index = value_index([(stored[name], columns) for name, columns in INDEXED_COLUMNS.items()])
        for written in (totals, paid, pool.submit(job(INDEX, index))):
            written.result()
    if rows.pop(UNPAID) != rows["fact_orders"]:
        raise ValueError("an order has more than one payment, so its lines would be repeated")
    del schemas[UNPAID]
    files.remove(spark, f"{version}/{UNPAID}")
    latest = gold_tables.latest_month(files.names_in(spark, f"{version}/fact_orders"))
    published = {
        "sources": sources,
        "definition": _definition(),
        "schemas": schemas,
        "rows": rows,
        "comments": TABLE_COMMENTS,
        # Every order has one payment, so as many totals as payments means one row for every order.
        "single_orders": rows[ORDER_TOTALS] == rows["fact_transactions"],
        "latest_month": latest and latest.isoformat(),
    }
    files.publish_text(spark, f"{version}/published.json", json.dumps(published))
    return open_store(spark, raw_dir, folder)


def ready_store(spark: SparkSession, raw_dir: str, folder: str | None = None) -> Store:
    """The published version for the raw files, built first if there is none. For the registered queries."""
    folder = folder or store_folder(spark)
    try:
        return open_store(spark, raw_dir, folder)
    except StaleStore:
        return build_store(spark, raw_dir, folder)


def open_gold(spark: SparkSession, raw_dir: str, folder: str | None = None) -> Gold:
    return ready_store(spark, raw_dir, folder).gold


def open_index(spark: SparkSession, raw_dir: str, folder: str | None = None) -> DataFrame:
    return ready_store(spark, raw_dir, folder).index
