"""History operators: daily state, derived columns, latest position, summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import NOTE_CELL_DATE, STATE_ORDER, Contract
from tidemark.functions.values import age_in_days, record_hash, with_follow_up_date


def newest_first(order: Sequence[str]) -> list[Column]:
    """Descending order in which a null counts as the newest value."""
    return [F.col(name).desc_nulls_first() for name in order]


def last_per_key(
    rows: DataFrame, keys: Sequence[str], order: Sequence[str], rank: str | None = None
) -> DataFrame:
    """The last row of every key under ``order``; null keys form one group.

    Filtering a row number to one lets Spark keep a single candidate per key in
    every map task before the shuffle, so a key that holds a third of the rows
    reaches its reduce task as at most one row per map task.
    """
    position = rank or "_position"
    deciding = [name for name in order if name not in keys]  # a key is equal within its group
    window = Window.partitionBy(*keys).orderBy(*newest_first(deciding))
    last = rows.withColumn(position, F.row_number().over(window)).filter(F.col(position) == 1)
    return last if rank else last.drop(position)


def daily_state(rows: DataFrame, contract: Contract, order: Sequence[str] = STATE_ORDER) -> DataFrame:
    """One row per process and snapshot date: its last appearance that day."""
    return last_per_key(rows, ("snapshot_date", contract.id_column), order)


def latest_position(
    history: DataFrame, contract: Contract, order: Sequence[str] = STATE_ORDER
) -> DataFrame:
    """The most recent row of every process."""
    return last_per_key(history, (contract.id_column,), order)


def add_follow_up(history: DataFrame, contract: Contract) -> DataFrame:
    """Follow-up date found in the note, and its age at the snapshot.

    A note cell that holds a date rather than text is that date.
    """
    snapshot, found = F.col("snapshot_date"), F.col("follow_up_date")
    note = F.col(contract.follow_up_notes_column).cast("string")
    dated = with_follow_up_date(history, note, snapshot, "follow_up_date")
    if NOTE_CELL_DATE in history.columns:
        cell_date = F.when(snapshot.isNotNull(), F.col(NOTE_CELL_DATE))
        dated = dated.withColumn("follow_up_date", F.coalesce(cell_date, found))
    return dated.withColumn("follow_up_age_days", age_in_days(snapshot, found)).drop(NOTE_CELL_DATE)


def add_record_hash(
    history: DataFrame, contract: Contract, columns: Sequence[str] | None = None
) -> DataFrame:
    """Content hash over the business columns, or over ``columns``."""
    hashed = columns or contract.hash_columns(history.columns)
    return history.withColumn("record_hash", record_hash(hashed))


def add_derived(
    history: DataFrame, contract: Contract, columns: Sequence[str] | None = None
) -> DataFrame:
    """Follow-up date, follow-up age and content hash; one narrow projection."""
    return add_record_hash(add_follow_up(history, contract), contract, columns)


def merged_latest(
    latest: DataFrame, before: DataFrame, added: DataFrame, first: object, contract: Contract, order: Sequence[str] = STATE_ORDER
) -> DataFrame:
    """The latest position after all dates from ``first`` on were written anew as ``added``.

    ``latest`` is the position before that, and ``before`` the history of the earlier dates. A process keeps its position unless
    ``added`` has a later row. One whose position lay in the dates written anew falls back on ``added`` or, if it is no longer
    there, on ``before``, which is read for such processes only.
    """
    early = F.col("snapshot_date") < F.lit(first)
    kept = latest.filter(early)
    candidates = kept.unionByName(added, allowMissingColumns=True)
    lost = latest.filter(~early | F.col("snapshot_date").isNull()).select(contract.id_column)
    if not lost.isEmpty():
        candidates = candidates.unionByName(before.join(lost, contract.id_column, "left_semi"), allowMissingColumns=True)
    return latest_position(candidates, contract, order)


def merged_summary(totals: DataFrame, added: DataFrame, first: object, contract: Contract) -> DataFrame:
    """The summary after all dates from ``first`` on were written anew as ``added``."""
    return totals.filter(F.col("snapshot_date") < F.lit(first)).unionByName(summary(added, contract))


def summary(history: DataFrame, contract: Contract) -> DataFrame:
    """Rows and distinct processes per snapshot date, file and worksheet."""
    return history.groupBy("snapshot_date", "source_file", "source_sheet").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_distinct(F.col(contract.id_column)).alias("unique_processes"),
    )


def union_snapshots(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of several worksheets or snapshots, matched by column name, gaps null."""
    first, *others = frames
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
