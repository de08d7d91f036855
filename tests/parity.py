"""Compare registered queries with their SQL in DuckDB, whatever the order of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def plain(value):
    """One spelling per value: whole numbers as int, moments as date where they are one."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return int(value) if value == value.to_integral_value() else round(float(value), 6)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() else round(value, 6)
    if isinstance(value, datetime.datetime) and value.time() == datetime.time():
        return value.date()
    return value


def counted(names, rows) -> tuple[list[str], Counter]:
    order = sorted(range(len(names)), key=lambda i: names[i].lower())
    return [names[i].lower() for i in order], Counter(
        tuple(plain(row[i]) for i in order) for row in rows
    )


# Spark type -> DuckDB type; both sides must agree, not only in value.
_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "date": "DATE", "double": "DOUBLE",
}


def type_difference(frame, connection, sql: str) -> dict[str, tuple[str, str]]:
    """Columns whose types differ."""
    theirs = {r[0].lower(): r[1] for r in connection.execute(f"DESCRIBE {sql}").fetchall()}
    ours = {name.lower(): _TYPES.get(kind, kind) for name, kind in frame.dtypes}
    return {c: (ours[c], theirs.get(c)) for c in ours if ours[c] != theirs.get(c)}


def difference(frame, connection, sql: str) -> str | None:
    """What differs, or ``None``."""
    names, ours = counted(frame.columns, frame.collect())
    cursor = connection.execute(sql)
    sql_names, theirs = counted([column[0] for column in cursor.description], cursor.fetchall())
    if names != sql_names:
        return f"columns {names} against {sql_names}"
    if ours == theirs:
        return None
    extra, lacking = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; {sum(extra.values())} extra such as "
        f"{list(extra)[:2]}; {sum(lacking.values())} lacking such as {list(lacking)[:2]}"
    )
