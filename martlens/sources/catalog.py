"""Catalog side: layer names, the overwriting sink with its row count, comments, and inspection."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Layout:
    """Table names of one schema: ``bronze_<n>``, ``silver_<n>`` and plain ``dim_<n>`` / ``fact_<n>`` for gold."""

    schema: str
    catalog: str | None = None

    def __post_init__(self) -> None:
        for part in (self.schema, *([] if self.catalog is None else [self.catalog])):
            if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", part):
                raise ValueError(f"{part!r} is no plain identifier: letters, digits and underscores only")

    @property
    def full_schema(self) -> str:
        return f"{self.catalog}.{self.schema}" if self.catalog else self.schema

    def bronze(self, name: str) -> str:
        return f"{self.full_schema}.bronze_{name}"

    def silver(self, name: str) -> str:
        return f"{self.full_schema}.silver_{name}"

    def gold(self, name: str) -> str:
        return f"{self.full_schema}.{name}"

    def ensure_schema(self, spark: SparkSession) -> None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {self.full_schema}")


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; they are stored with the table the frame is written to."""
    return df.select(
        *[F.col(name).alias(name, metadata={"comment": comments[name]}) if name in comments else name for name in df.columns]
    )


@dataclass(frozen=True)
class Buckets:
    """Storage in ``number`` buckets of one key, each sorted: tables alike in this join on the key without a shuffle."""

    number: int
    key: str
    sorted_by: tuple[str, ...]


def overwrite_table(
    df: DataFrame,
    table: str,
    comment: str | None = None,
    buckets: Buckets | None = None,
    folders: str | None = None,
) -> int:
    """Replace a table, schema included, and return its row count, counted while the rows are written.

    ``folders`` names a column whose values get a folder each. A frame to be bucketed should be partitioned on the key
    already, one task per bucket, so that a bucket is one file of each folder.
    """
    counted = Observation()
    writer = (
        df.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("overwriteSchema", "true")
    )
    if folders:
        writer = writer.partitionBy(folders)
    if buckets:
        writer = writer.bucketBy(buckets.number, buckets.key).sortBy(*buckets.sorted_by)
    writer.saveAsTable(table)
    if comment:
        text = comment.replace("\\", "\\\\").replace("'", "\\'")
        df.sparkSession.sql(f"COMMENT ON TABLE {table} IS '{text}'")
    return counted.get["rows"]


def overwrite_files(df: DataFrame, path: str, folders: str | None = None) -> int:
    """Replace a parquet folder and return its row count, counted while the rows are written."""
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    (writer.partitionBy(folders) if folders else writer).parquet(path)
    return counted.get["rows"]


def list_tables(spark: SparkSession, layout: Layout) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {layout.full_schema}")


def preview(df: DataFrame, rows: int = 10) -> DataFrame:
    return df.limit(rows)


def describe(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {table}")


def column_comments(df: DataFrame) -> dict[str, str | None]:
    return {field.name: field.metadata.get("comment") for field in df.schema.fields}
