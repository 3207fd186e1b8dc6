"""Scans of the raw parquet tables, with explicit schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


_LONG, _INT, _DOUBLE, _STRING, _TIME = (
    T.LongType(),
    T.IntegerType(),
    T.DoubleType(),
    T.StringType(),
    T.TimestampNTZType(),
)

RAW_SCHEMAS = {
    "customer": _schema(
        c_custkey=_LONG, c_name=_STRING, c_nationkey=_INT, c_acctbal=_DOUBLE, c_mktsegment=_STRING
    ),
    "orders": _schema(
        o_orderkey=_LONG,
        o_custkey=_LONG,
        o_orderstatus=_STRING,
        o_totalprice=_DOUBLE,
        o_orderdate=_TIME,
        o_orderpriority=_STRING,
    ),
    "lineitem": _schema(
        l_orderkey=_LONG,
        l_partkey=_LONG,
        l_suppkey=_LONG,
        l_linenumber=_INT,
        l_quantity=_DOUBLE,
        l_extendedprice=_DOUBLE,
        l_discount=_DOUBLE,
        l_tax=_DOUBLE,
        l_returnflag=_STRING,
        l_linestatus=_STRING,
        l_shipdate=_TIME,
    ),
    "part": _schema(
        p_partkey=_LONG, p_name=_STRING, p_brand=_STRING, p_type=_STRING, p_size=_INT, p_retailprice=_DOUBLE
    ),
    "nation": _schema(n_nationkey=_INT, n_name=_STRING, n_regionkey=_INT),
    "region": _schema(r_regionkey=_INT, r_name=_STRING),
}


@dataclass(frozen=True)
class Raw:
    customer: DataFrame
    orders: DataFrame
    lineitem: DataFrame
    part: DataFrame
    nation: DataFrame
    region: DataFrame


def read_raw(spark: SparkSession, raw_dir: str) -> Raw:
    return Raw(
        **{
            name: spark.read.schema(schema).parquet(f"{raw_dir}/{name}.parquet")
            for name, schema in RAW_SCHEMAS.items()
        }
    )
