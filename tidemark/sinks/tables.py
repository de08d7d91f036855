"""Result tables on storage, published all at once.

A run writes its tables to a folder of its own, and its part of the history to ``history/run_id=…``. Publishing
appends one small manifest row; readers follow the newest row. Until then nobody sees the tables of the run, and
a run that fails leaves the published ones untouched.

The row names the parts of the history: a run and the first date it holds, until the first date of the next part. A run over
everything is one part; a run that adds days writes these days only and is one part more.
"""

from __future__ import annotations

import json
from datetime import date, datetime
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.contract import Contract, safe_identifier
from tidemark.errors import TidemarkError

HISTORY, LATEST, SUMMARY = "history", "latest_position", "summary"
ISSUES, REPORT, REPORT_ISSUES = "quality_issues", "quality_report", "quality_report_issues"
REPORT_TABLE = "report"
TABLES = (HISTORY, LATEST, SUMMARY, ISSUES)
RUN = "run_id"
_MANIFEST_SCHEMA = (
    "run_id STRING, published_at TIMESTAMP, schemas MAP<STRING, STRING>, "
    "parts ARRAY<STRUCT<run_id: STRING, first: DATE>>, contract STRING"
)
_CATALOG_SCHEMA = "schema STRING, history STRING"


class Part(NamedTuple):
    """A part of the published history: the dates of a run from ``first`` on (all, if null) to the next part's first."""

    run_id: str
    first: date | None = None


def parts_after(parts: list[Part], added: Part) -> list[Part]:
    """The parts of a history after a run has written all dates from ``added.first`` on."""
    if added.first is None:
        return [added]
    return [*(part for part in parts if part.first is None or part.first < added.first), added]


def part_conditions(parts: list[Part]) -> list[str]:
    """Per part, which dates of its run count; plain comparisons, by which Spark passes over folders."""
    conditions = []
    for part, after in zip(parts, [*parts[1:], None], strict=True):
        found = [f"snapshot_date >= DATE'{part.first}'"] if part.first else []
        if after:
            before = f"snapshot_date < DATE'{after.first}'"
            found.append(before if part.first else f"({before} OR snapshot_date IS NULL)")
        conditions.append(" AND ".join(found) or "TRUE")
    return conditions


def _join(*parts: str) -> str:
    first, *rest = parts
    return "/".join([first.rstrip("/"), *rest])


def run_folder(output: str, run_id: str) -> str:
    return _join(output, "runs", run_id)


def write_history(history: DataFrame, folder: str, contract: Contract, run_id: str | None = None) -> DataFrame:
    """History partitioned by snapshot date and sorted by process inside each file; a run's part of it, if one is named.

    The rebalance hint brings the rows of a date together and lets adaptive execution
    split a date that is too large for one task and merge dates that are small, so
    neither a hot date nor many small files result. Columns keep their order.
    """
    path = _join(folder, HISTORY, *([f"{RUN}={run_id}"] if run_id else []))
    (
        history.hint("rebalance", F.col("snapshot_date"))
        .sortWithinPartitions("snapshot_date", contract.id_column)
        .write.mode("overwrite")
        .partitionBy("snapshot_date")
        .parquet(path)
    )
    return read_table(history.sparkSession, path, history.schema)


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_history(spark: SparkSession, output: str, parts: list[Part], schema: StructType | None) -> DataFrame:
    """The parts of a history as one table; only the folders of their dates are read."""
    reader = spark.read if schema is None else spark.read.schema(StructType([*schema.fields, StructField(RUN, StringType())]))
    table = reader.parquet(_join(output, HISTORY))
    held = " OR ".join(f"({RUN} = '{part.run_id}' AND {test})" for part, test in zip(parts, part_conditions(parts), strict=True))
    return table.filter(held).drop(RUN) if schema is None else table.filter(held).select(*schema.names)


def write_table(table: DataFrame, folder: str, name: str) -> DataFrame:
    path = _join(folder, name)
    table.hint("rebalance").write.mode("overwrite").parquet(path)
    return read_table(table.sparkSession, path, table.schema)


def write_csv(table: DataFrame, folder: str, name: str) -> str:
    """Text copy of a table for people; nested columns become JSON text."""
    nested = {f.name for f in table.schema.fields if f.dataType.typeName() in ("map", "array", "struct")}
    flat = table.select(
        *[F.to_json(c).alias(c) if c in nested else F.col(c) for c in table.columns]
    )
    path = _join(folder, f"{name}_csv")
    flat.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_report(report: DataFrame, issues: DataFrame, folder: str) -> dict[str, str]:
    """The quality report as JSON: one row of totals, and one line per issue beside it."""
    paths = {name: _join(folder, name) for name in (REPORT, REPORT_ISSUES)}
    report.coalesce(1).write.mode("overwrite").json(paths[REPORT])
    issues.write.mode("overwrite").json(paths[REPORT_ISSUES])
    return paths


def publish(
    spark: SparkSession,
    output: str,
    run_id: str,
    published_at: datetime,
    tables: dict[str, DataFrame] | None = None,
    parts: list[Part] | None = None,
    contract: Contract | None = None,
) -> None:
    """Make a finished run the current one; views that were registered on the output follow it.

    The manifest row keeps the columns of the tables, because files that are partitioned by
    date would give the date as the last one. Without ``parts`` the run holds the whole history.
    """
    schemas = {name: table.schema.json() for name, table in (tables or {}).items()}
    row = (run_id, published_at, schemas, parts or [Part(run_id)], contract and repr(contract))
    spark.createDataFrame([row], _MANIFEST_SCHEMA).coalesce(1).write.mode("append").json(_join(output, "manifest"))
    for schema, history in _registered(spark, output):
        _create_views(spark, output, schema, history)


class Published(NamedTuple):
    """What the newest manifest row says."""

    run_id: str
    schemas: dict[str, StructType]
    parts: list[Part]
    contract: str | None


def newest(spark: SparkSession, output: str) -> Published:
    """The newest published run."""
    try:
        manifest = spark.read.schema(_MANIFEST_SCHEMA).json(_join(output, "manifest"))
        row = F.struct("run_id", "schemas", "parts", "contract")
        found = manifest.agg(F.max_by(row, F.struct("published_at", "run_id")).alias("row")).first()["row"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise TidemarkError(f"Nothing has been published in {output}.") from error
        raise
    schemas = {name: StructType.fromJson(json.loads(text)) for name, text in (found["schemas"] or {}).items()}
    parts = [Part(part["run_id"], part["first"]) for part in found["parts"] or []]
    return Published(found["run_id"], schemas, parts or [Part(found["run_id"])], found["contract"])


def current_run(spark: SparkSession, output: str) -> str:
    """Folder of the newest published run."""
    return run_folder(output, newest(spark, output).run_id)


def open_published(spark: SparkSession, output: str) -> dict[str, DataFrame]:
    """The current tables by name, from one and the same run, columns in the order of the run."""
    current = newest(spark, output)
    folder, known = run_folder(output, current.run_id), current.schemas
    found = {name: read_table(spark, _join(folder, name), known.get(name)) for name in TABLES if name != HISTORY}
    return {HISTORY: read_history(spark, output, current.parts, known.get(HISTORY)), **found}


def remove_unused(spark: SparkSession, output: str) -> list[str]:
    """Delete the folders of runs that the newest manifest row does not need; names them.

    Readers that opened an older run lose it, so call this when none can be left. Runs are as many as there were
    publications, so their names are listed by the driver.
    """
    current = newest(spark, output)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    wanted = {"runs": {current.run_id}, HISTORY: {f"{RUN}={part.run_id}" for part in current.parts}}
    removed = []
    for folder, kept in wanted.items():
        root = hadoop.Path(_join(output, folder))
        system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in system.listStatus(root):
            name = status.getPath().getName()
            if status.isDirectory() and name not in kept:
                system.delete(status.getPath(), True)
                removed.append(f"{folder}/{name}")
    return sorted(removed)


def register_catalog(spark: SparkSession, output: str, contract: Contract) -> None:
    """Catalog views on the current run, in the contract's schema; :func:`publish` moves them on.

    SQL written against the database table, ``schema.table``, runs on them unchanged. Sessions that share the
    catalog of the publishing session see the new run at once; another catalog registers again.
    """
    schema, history = safe_identifier(contract.database_schema), safe_identifier(contract.database_table)
    _create_views(spark, output, schema, history)
    if (schema, history) not in _registered(spark, output):
        row = spark.createDataFrame([(schema, history)], _CATALOG_SCHEMA)
        row.coalesce(1).write.mode("append").json(_join(output, "catalog"))


def _registered(spark: SparkSession, output: str) -> list[tuple[str, str]]:
    """Schema and name of the history of every registration, a handful of names."""
    try:
        known = spark.read.schema(_CATALOG_SCHEMA).json(_join(output, "catalog")).distinct().collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return [tuple(row) for row in known]


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _has_dates(spark: SparkSession, path: str) -> bool:
    """Whether a part of the history has any date; days that were only taken away leave none."""
    dates = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/snapshot_date=*")
    return len(dates.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(dates)) > 0


def _create_views(spark: SparkSession, output: str, schema: str, history: str) -> None:
    current = newest(spark, output)
    folder = run_folder(output, current.run_id)
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    for name, table in open_published(spark, output).items():
        columns = ", ".join(map(_quoted, table.columns))
        paths, tests = [_join(folder, name)], ["TRUE"]
        if name == HISTORY:
            paths = [_join(output, HISTORY, f"{RUN}={part.run_id}") for part in current.parts]
            held = [(path, test) for path, test in zip(paths, part_conditions(current.parts), strict=True) if _has_dates(spark, path)]
            paths, tests = zip(*held, strict=True)
        parts = [f"SELECT {columns} FROM parquet.{_quoted(path)} WHERE {test}" for path, test in zip(paths, tests, strict=True)]
        view = history if name == HISTORY else name
        spark.sql(f"CREATE OR REPLACE VIEW {schema}.{view} AS {' UNION ALL '.join(parts)}")


def register_views(tables: dict[str, DataFrame], contract: Contract) -> None:
    """Temporary views for SQL; the history goes by the contract's table name."""
    for name, table in tables.items():
        table.createOrReplaceTempView(contract.database_table if name == HISTORY else name)
