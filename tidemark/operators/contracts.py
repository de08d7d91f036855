"""Contract checks over workbooks, worksheets and headers.

``workbooks`` holds one row per workbook with its sheet names, ``sheets`` one row per
worksheet with its headers. Both are small beside the rows and are checked with array
functions inside each row, without a join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import ROW_PATH, ROW_SHEET, Contract
from tidemark.functions.text import canonical_label
from tidemark.operators.cleaning import SHEET_SCOPE


def texts(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(value) for value in values]).cast("array<string>")


def repeated(labels: Column) -> Column:
    """Sorted labels that occur more than once in an array."""
    return F.array_sort(
        F.filter(
            F.array_distinct(labels),
            lambda label: F.size(F.filter(labels, lambda other: other == label)) > 1,
        )
    )


def sheets_of_workbooks(present: DataFrame, workbook: str = "source_file") -> DataFrame:
    """Sheet names of every workbook, from rows that name workbook and sheet.

    Distinct first: a workbook has few sheets however many rows it holds.
    """
    named = present.select(workbook, F.col("source_sheet").alias("name")).distinct()
    keyed = named.withColumn("key", canonical_label(F.col("name")))
    listed = keyed.groupBy(workbook).agg(
        F.array_sort(F.collect_list(F.struct("key", "name"))).alias("listed")
    )
    return listed.select(
        workbook, F.col("listed.name").alias("sheets"), F.col("listed.key").alias("sheet_keys")
    )


def sheet_collisions(workbooks: DataFrame) -> DataFrame:
    """Worksheets of one workbook whose names are equal in canonical form."""
    clash = F.explode(repeated(F.col("sheet_keys"))).alias("sheet_key")
    names = F.filter(
        F.arrays_zip("sheets", "sheet_keys"), lambda sheet: sheet["sheet_keys"] == F.col("sheet_key")
    )
    return workbooks.select("*", clash).select(
        "source_file", "sheet_key", F.array_sort(names["sheets"]).alias("colliding_sheets")
    )


def missing_sheets(workbooks: DataFrame, contract: Contract) -> DataFrame:
    """Expected worksheets a workbook lacks, one row each."""
    keys = texts(contract.sheet_keys)
    absent = workbooks.select(
        "source_file", F.explode(F.array_except(keys, "sheet_keys")).alias("sheet_key")
    )
    order = F.array_position(keys, F.col("sheet_key")).cast("int")
    return absent.select(
        "source_file",
        F.element_at(texts(contract.expected_sheets), order).alias("source_sheet"),
        order.alias("sheet_order"),
    )


def unexpected_sheets(workbooks: DataFrame, contract: Contract) -> DataFrame:
    """Worksheets outside the contract, listed in canonical order, per workbook."""
    named = F.arrays_zip(F.col("sheet_keys").alias("key"), F.col("sheets").alias("name"))
    extra = F.array_sort(
        F.filter(named, lambda sheet: ~F.array_contains(texts(contract.sheet_keys), sheet["key"]))
    )
    return (
        workbooks.select("source_file", extra.alias("extra"))
        .filter(F.size("extra") > 0)
        .select(
            "source_file",
            F.size("extra").alias("sheet_count"),
            F.transform("extra", lambda sheet: sheet["name"]).alias("worksheets"),
        )
    )


def header_collisions(sheets: DataFrame) -> DataFrame:
    """Headers of one worksheet that are equal in canonical form."""
    clash = repeated(F.col("header_keys"))
    return (
        sheets.select(*SHEET_SCOPE, clash.alias("colliding_columns"))
        .filter(F.size("colliding_columns") > 0)
    )


def filled_cells(
    rows: DataFrame, columns: Sequence[str], scope: Sequence[str] = SHEET_SCOPE
) -> DataFrame:
    """Number of non-null cells by column, as one map per worksheet."""
    if not columns:
        empty = F.create_map().cast("map<string,bigint>")
        return rows.select(*scope).distinct().withColumn("filled_cells", empty)
    counts = [F.count(F.col(name)).alias(name) for name in columns]
    entries = [part for name in columns for part in (F.lit(name), F.col(name))]
    counted = rows.groupBy(*scope).agg(*counts)
    return counted.select(*scope, F.create_map(*entries).alias("filled_cells"))


def column_fill(
    rows: DataFrame, columns: Sequence[str], scope: Sequence[str] = SHEET_SCOPE
) -> DataFrame:
    """Worksheet, column and number of non-null cells; zero marks an absent column."""
    return filled_cells(rows, columns, scope).select(
        *scope, F.explode("filled_cells").alias("column_name", "filled_cells")
    )


def missing_required(contract: Contract) -> Column:
    """Sorted required columns without a value, in a row of :func:`filled_cells`."""
    filled = F.col("filled_cells")
    absent = [
        F.when(F.coalesce(filled[name], F.lit(0)) == 0, name)
        for name in sorted(contract.required_columns)
    ]
    return F.array_compact(F.array(*absent))


def contract_failures(
    filled: DataFrame, contract: Contract, scope: Sequence[str] = SHEET_SCOPE
) -> DataFrame:
    """Worksheets that lack a required column, with the missing columns."""
    return (
        filled.select(*scope, missing_required(contract).alias("missing_columns"))
        .filter(F.size("missing_columns") > 0)
    )


def sheet_lineage(contract: Contract, sheet_key: Column) -> tuple[Column, Column]:
    """Contract label and 1-based contract position of a canonical sheet name."""
    order = F.array_position(texts(contract.sheet_keys), sheet_key).cast("int")
    label = F.element_at(texts(contract.expected_sheets), F.nullif(order, F.lit(0)))
    return label, F.nullif(order, F.lit(0))


def stamp_lineage(rows: DataFrame, files: DataFrame, contract: Contract) -> DataFrame:
    """Snapshot date and order, file, contract sheet label and position on every row.

    Rows name their workbook and worksheet in ``ROW_PATH`` and ``ROW_SHEET``; rows of
    unexpected sheets drop out. How the files table is joined is left to Spark, or to
    a caller who knows its size.
    """
    label, position = sheet_lineage(contract, F.col(ROW_SHEET))
    stamped = rows.withColumn("source_sheet", label).withColumn("sheet_order", position)
    stamped = stamped.filter(F.col("sheet_order").isNotNull())
    dated = files.select(
        F.col("path").alias(ROW_PATH), "snapshot_date", "snapshot_order", "source_file"
    )
    return stamped.join(dated, ROW_PATH)
