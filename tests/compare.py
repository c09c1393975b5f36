"""Order-free comparison of a Spark result with DuckDB on the same tables."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

DUCK_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "FLOAT": "float",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def _plain(value):
    if isinstance(value, (float, decimal.Decimal)):
        number = float(value)
        return "NaN" if math.isnan(number) else round(number, 4)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def _bag(rows, order) -> Counter:
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, connection, sql: str) -> list[str]:
    """What differs in names, types or rows; empty if nothing does."""
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    types = [DUCK_TYPES.get(str(column[1]), str(column[1])) for column in result.description]
    rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"names: {sorted(df.columns)} against {sorted(names)}"]
    found = dict(df.dtypes)
    problems = [
        f"type of {n}: {found[n]} against {t}" for n, t in zip(names, types) if found[n] != t
    ]
    ours = _bag(df.collect(), [df.columns.index(n) for n in sorted(names)])
    theirs = _bag(rows, [names.index(n) for n in sorted(names)])
    if ours != theirs:
        extra, lacking = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
        problems.append(
            f"rows: {ours.total()} against {theirs.total()}; extra {extra}; lacking {lacking}"
        )
    return problems
