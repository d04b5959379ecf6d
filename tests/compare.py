"""Compare a Spark result with a SQL result as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _row(values) -> tuple:
    return tuple("NaN" if isinstance(v, float) and math.isnan(v) else v for v in values)


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when columns, types and rows agree."""
    result = con.execute(sql)
    expected_types = {d[0]: KINDS.get(str(d[1]), str(d[1])) for d in result.description}
    found_types = dict(df.dtypes)
    if found_types != expected_types:
        return [f"columns: {found_types} expected {expected_types}"]
    names = sorted(expected_types)
    positions = [[d[0] for d in result.description].index(n) for n in names]
    expected = Counter(_row(r[p] for p in positions) for r in result.fetchall())
    found = Counter(_row(r[n] for n in names) for r in df.collect())
    problems = []
    for title, bag in (("missing", expected - found), ("unexpected", found - expected)):
        if bag:
            problems.append(f"{title} {bag.total()}: {list(bag)[:3]}")
    return problems
