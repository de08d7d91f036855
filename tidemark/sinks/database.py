"""History in a relational database, through Spark's JDBC writer."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tidemark.contract import Contract, safe_identifier
from tidemark.errors import TidemarkError
from tidemark.functions.text import lower_columns

_CATALOG_CLASS = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"

# Contract mode -> Spark save mode.
_SAVE_MODES = {"fail": "errorifexists", "append": "append", "replace": "overwrite"}


def catalog_name(url: str, properties: dict[str, str]) -> str:
    """One catalog per target: Spark keeps what it has opened under a name for the whole session."""
    target = "\x1f".join([url, *(f"{key}={properties[key]}" for key in sorted(properties))])
    return f"tidemark_{hashlib.md5(target.encode()).hexdigest()[:16]}"


@contextmanager
def open_catalog(spark: SparkSession, url: str, properties: dict[str, str]) -> Iterator[str]:
    """The target as a catalog; address and password leave the settings afterwards."""
    name = catalog_name(url, properties)
    settings = {f"spark.sql.catalog.{name}": _CATALOG_CLASS}
    settings |= {f"spark.sql.catalog.{name}.{key}": value for key, value in {"url": url, **properties}.items()}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield name
    finally:
        for key in settings:
            spark.conf.unset(key)


def write_database(
    history: DataFrame,
    url: str,
    contract: Contract,
    properties: dict[str, str] | None = None,
    connections: int | None = None,
) -> str:
    """Write the history to ``schema.table`` and return that name.

    Each task writes its rows in one transaction, in batches of the contract's size. ``connections`` bounds how many
    write at a time, by bounding the tasks; without it the history's own partitions write.
    Replacing loads a staging table first, counts it, and swaps the names afterwards:
    readers never see half of the new table, and a task that was lost after its commit
    and ran again is noticed. When appending, the key of the table has to do that.
    """
    spark, properties = history.sparkSession, properties or {}
    schema = safe_identifier(contract.database_schema)
    table = safe_identifier(contract.database_table)
    mode = contract.database_mode
    with open_catalog(spark, url, properties) as catalog:
        spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {catalog}.{schema}")
        target = f"{table}_staging" if mode == "replace" else table
        options = {"url": url, "dbtable": f"{schema}.{target}", "batchsize": str(contract.database_batch_rows), **properties}
        if connections:
            options["numPartitions"] = str(connections)
        writer = lower_columns(history).write.format("jdbc").options(**options)
        writer.mode(_SAVE_MODES[mode]).save()
        if mode == "replace":
            loaded = spark.read.format("jdbc").options(**options).load().count()
            expected = history.count()
            if loaded != expected:
                raise TidemarkError(f"{schema}.{target} holds {loaded} rows instead of {expected}.")
            swap(spark, catalog, schema, table, target)
    return f"{schema}.{table}"


def swap(spark: SparkSession, catalog: str, schema: str, table: str, staging: str) -> None:
    """Put the staging table in the place of the table, which stays until the new one stands.

    A database without transactions over names shows no table for a moment, between two changes of name. If the
    second change fails, the old table gets its name back. A table set aside by an earlier run
    that was cut off there counts as the old one.
    """
    old = f"{table}_old"

    def rename(source: str, name: str) -> None:
        spark.sql(f"ALTER TABLE {catalog}.{schema}.{source} RENAME TO {schema}.{name}")

    if spark.catalog.tableExists(f"{catalog}.{schema}.{table}"):
        spark.sql(f"DROP TABLE IF EXISTS {catalog}.{schema}.{old}")
        rename(table, old)
    try:
        rename(staging, table)
    except Exception:
        if spark.catalog.tableExists(f"{catalog}.{schema}.{old}"):
            rename(old, table)
        raise
    spark.sql(f"DROP TABLE IF EXISTS {catalog}.{schema}.{old}")
