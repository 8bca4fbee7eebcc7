"""Spark against DuckDB on the driver tables."""

import datetime
import decimal
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = f"{sf_dir}/{table}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and value == int(value):
        return value
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(names: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(frame, con, sql: str, show: int = 3) -> str | None:
    """None when both give the same columns and rows, else what differs."""
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    theirs = rows_of(theirs_names, result.fetchall())
    ours = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(theirs_names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(theirs_names)}"
    if [tuple(map(type, r)) for r in ours[:1]] != [tuple(map(type, r)) for r in theirs[:1]] and ours and theirs:
        kinds = [(type(a).__name__, type(b).__name__) for a, b in zip(ours[0], theirs[0]) if type(a) is not type(b)]
        kinds = [k for k in kinds if "NoneType" not in k]
        if kinds:
            return f"types differ: {kinds}"
    if ours == theirs:
        return None
    a, b = set(ours), set(theirs)
    return f"rows {len(ours)} != {len(theirs)} or values; only ours {list(a - b)[:show]}; only theirs {list(b - a)[:show]}"
