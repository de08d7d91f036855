"""Row cleaning over many worksheets at once, scoped by their lineage columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import BLANK_ROW, COPIES, DIGEST, FORMATS, LINEAGE_COLUMNS, ROW_NUMBER, Contract
from tidemark.functions.text import trim_text, whole_identifier
from tidemark.functions.values import best_format, calendar_date, date_in_format, fitting_values, whole_number

SHEET_SCOPE = ("source_file", "source_sheet")


def is_blank_row(columns: Sequence[str]) -> Column:
    """True when every named column is null (white space is a value here)."""
    return reduce(lambda left, right: left & right, [F.col(name).isNull() for name in columns])


def drop_blank_rows(rows: DataFrame, contract: Contract) -> DataFrame:
    return rows.dropna(how="all", subset=contract.business_columns(rows.columns))


def typed_value(name: str, contract: Contract) -> Column:
    """The typed form of one source column whose text is already clean."""
    text = F.col(name)
    if name in (contract.id_column, contract.request_column):
        return whole_identifier(text.cast("string"))
    if name in contract.number_columns:
        return whole_number(text)
    if name in contract.date_columns:
        if contract.date_format_by_worksheet:
            return date_in_format(text, contract.date_formats, F.col(FORMATS).getField(name))
        return calendar_date(text, contract.date_formats)
    return text


def clean_values(rows: DataFrame, contract: Contract) -> DataFrame:
    """Trim, blank to null, and type every source column; other columns unchanged.

    Three projections rather than one: each names a value that the next one uses
    several times, so that it is computed once. Where the contract asks for one date format per worksheet, the
    values are read once more before, for the vote.
    """
    business = set(contract.business_columns(rows.columns))

    def projected(frame: DataFrame, change: Callable[[str], Column]) -> DataFrame:
        return frame.select(
            *[change(c).alias(c) if c in business else F.col(c) for c in frame.columns]
        )

    trimmed = projected(rows, lambda name: trim_text(F.col(name)))
    filled = projected(trimmed, lambda name: F.when(F.col(name) != "", F.col(name)))
    if contract.date_format_by_worksheet:
        return projected(with_date_formats(filled, contract), lambda name: typed_value(name, contract)).drop(FORMATS)
    return projected(filled, lambda name: typed_value(name, contract))


def date_formats(rows: DataFrame, contract: Contract) -> DataFrame:
    """Per worksheet (the lineage columns there are) the place of the format of every date column.

    The format that most values fit wins. Values are counted where they lie, so a worksheet of any size reaches its
    reduce task as one row per map task.
    """
    scope = [name for name in LINEAGE_COLUMNS if name in rows.columns]
    columns = [name for name in contract.date_columns if name in rows.columns]
    counts = rows.groupBy(*scope).agg(*[fitting_values(F.col(name), contract.date_formats).alias(name) for name in columns])
    places = F.struct(F.lit(0).alias("_"), *[best_format(F.col(name)).alias(name) for name in columns])
    return counts.select(*scope, places.alias(FORMATS))


def with_date_formats(rows: DataFrame, contract: Contract) -> DataFrame:
    """``rows`` with the formats of their worksheet; there is one row per worksheet, whose real size decides how Spark joins it."""
    formats = date_formats(rows, contract)
    scope = [name for name in formats.columns if name != FORMATS]
    renamed = formats.withColumnsRenamed({name: f"_of_{name}" for name in scope})
    same = reduce(lambda left, right: left & right, [F.col(name).eqNullSafe(F.col(f"_of_{name}")) for name in scope], F.lit(True))
    return rows.join(renamed, same, "left").select(*rows.columns, FORMATS)


def drop_null_ids(rows: DataFrame, contract: Contract) -> DataFrame:
    """Rows whose id holds more than white space.

    Decided on the id as it is, so the filter may come before the values are typed.
    """
    return rows.filter(trim_text(F.col(contract.id_column)) != "")


def collapse_copies(rows: DataFrame) -> DataFrame:
    """One row per distinct content, with the last row number and the number of copies.

    A grouped maximum rather than a window: copies are combined before the shuffle,
    so a group that holds a third of the table reaches one task as a handful of rows.
    """
    content = [name for name in rows.columns if name != ROW_NUMBER]
    collapsed = rows.groupBy(*content).agg(
        F.max(ROW_NUMBER).alias(ROW_NUMBER), F.count(F.lit(1)).alias(COPIES)
    )
    return collapsed.select(*rows.columns, COPIES)


def drop_exact_duplicates(rows: DataFrame) -> DataFrame:
    """Keep the last of the rows that agree on everything but the row number."""
    return collapse_copies(rows).drop(COPIES)


def clean(rows: DataFrame, contract: Contract) -> DataFrame:
    """All cleaning steps, for every worksheet in one plan."""
    kept = drop_null_ids(drop_blank_rows(rows, contract), contract)
    return drop_exact_duplicates(clean_values(kept, contract))


def marked_values(rows: DataFrame, contract: Contract) -> DataFrame:
    """Typed rows, those without any raw value marked instead of dropped."""
    blank = is_blank_row(contract.business_columns(rows.columns))
    return clean_values(rows.withColumn(BLANK_ROW, blank), contract)


def collapse_sheets(rows: DataFrame, contract: Contract) -> DataFrame:
    """Cleaned rows collapsed to distinct content, blank and id-less rows still marked.

    The clean rows and the cleaning counters both follow from this one frame
    (:func:`clean_rows`, :func:`clean_metrics`).
    """
    return collapse_copies(marked_values(rows, contract))


def content_digest(columns: Sequence[str]) -> Column:
    """128-bit digest of the named columns; lengths keep neighbouring texts apart."""
    parts = []
    for name in columns:
        text = F.col(name).cast("string")
        parts += [F.coalesce(F.length(text).cast("string"), F.lit("-")), F.coalesce(text, F.lit(""))]
    return F.md5(F.concat_ws(":", *parts))


def digested_values(rows: DataFrame, contract: Contract) -> DataFrame:
    """:func:`marked_values` with the digest of every row's content, for counting copies later."""
    business = contract.business_columns(rows.columns)
    return marked_values(rows, contract).withColumn(DIGEST, content_digest(business))


def collapse_digests(digested: DataFrame, contract: Contract, scope: Sequence[str]) -> DataFrame:
    """:func:`collapse_sheets` for counting only: content is grouped by its digest.

    Only the worksheet, the id, the mark and the digest are read and shuffled, not the rows.
    """
    narrow = digested.select(*scope, contract.id_column, BLANK_ROW, DIGEST)
    return narrow.groupBy(*narrow.columns).agg(F.count(F.lit(1)).alias(COPIES))


def clean_rows(marked: DataFrame, contract: Contract) -> DataFrame:
    """The rows that hold a value and an id, without their marks."""
    kept = marked.filter(~F.col(BLANK_ROW) & F.col(contract.id_column).isNotNull())
    return kept.drop(BLANK_ROW, COPIES, DIGEST)


def clean_metrics(
    collapsed: DataFrame, contract: Contract, scope: Sequence[str] = SHEET_SCOPE
) -> DataFrame:
    """Rows read, rows without id, exact duplicates and clean rows per worksheet."""
    has_id = F.col(contract.id_column).isNotNull()
    kept = ~F.col(BLANK_ROW) & has_id
    return collapsed.groupBy(*scope).agg(
        F.sum(COPIES).alias("raw_rows"),
        F.sum(F.when(~F.col(BLANK_ROW) & ~has_id, F.col(COPIES)).otherwise(0)).alias(
            "rows_without_id"
        ),
        F.sum(F.when(kept, F.col(COPIES) - 1).otherwise(0)).alias("exact_duplicates"),
        F.count_if(kept).alias("clean_rows"),
    )
