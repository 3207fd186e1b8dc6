"""Run registered queries beside their SQL and compare the rows."""

from __future__ import annotations

import math

import duckdb

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels
conversations""".split()


def oracle_connection(raw_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{raw_dir}/{table}.parquet')")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((v is not None, float(f"{v:.9g}") if isinstance(v, float) else v) for v in row)


def differences(spark_df, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs in names, types or rows, in any order; empty when all agree."""
    relation = connection.sql(sql)
    names = sorted(relation.columns)
    if names != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {names}"]
    found = []
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR"}
    kinds |= {"date": "DATE", "boolean": "BOOLEAN"}
    oracle_kinds = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in spark_df.dtypes:
        if kinds.get(kind) != oracle_kinds[name]:
            found.append(f"{name}: {kind} != {oracle_kinds[name]}")
    mine = sorted((tuple(r[n] for n in names) for r in spark_df.collect()), key=_sortable)
    at = [relation.columns.index(n) for n in names]
    theirs = sorted((tuple(r[i] for i in at) for r in relation.fetchall()), key=_sortable)
    if len(mine) != len(theirs):
        return [*found, f"{len(mine)} rows != {len(theirs)}"]
    for left, right in zip(mine, theirs):
        for a, b in zip(left, right):
            same = math.isclose(a, b, rel_tol=1e-12) if isinstance(a, float) and isinstance(b, float) else a == b
            if not same:
                return [*found, f"{left} != {right}"]
    return found
