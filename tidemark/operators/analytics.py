"""Questions asked of a published history (one row per process and snapshot date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.contract import STATE_ORDER, Contract
from tidemark.operators.history import last_per_key

STALE_AFTER_DAYS = 3
NO_STAGE = "NO STAGE"


def processes_by_date(history: DataFrame, contract: Contract) -> DataFrame:
    """Distinct processes on every snapshot date."""
    return (
        history.groupBy("snapshot_date")
        .agg(F.count_distinct(F.col(contract.id_column)).alias("unique_processes"))
        .orderBy("snapshot_date")
    )


def ranked_position(history: DataFrame, contract: Contract) -> DataFrame:
    return last_per_key(history, (contract.id_column,), STATE_ORDER, rank="position_rank")


def current_position(history: DataFrame, contract: Contract) -> DataFrame:
    """The current row of every process, its rank kept."""
    return ranked_position(history, contract).orderBy(
        F.col("snapshot_date").desc_nulls_first(), F.col(contract.id_column).asc_nulls_last()
    )


def overdue_by_stage(
    history: DataFrame, contract: Contract, stage_column: str = "current_stage"
) -> DataFrame:
    """Processes whose current position is overdue, counted per stage."""
    overdue = ranked_position(history, contract).filter(F.col(contract.sla_column) < 0)
    return (
        overdue.groupBy(F.coalesce(F.col(stage_column), F.lit(NO_STAGE)).alias(stage_column))
        .agg(F.count(F.lit(1)).alias("overdue_processes"))
        .orderBy(F.col("overdue_processes").desc(), F.col(stage_column))
    )


def stale_follow_ups(
    history: DataFrame,
    contract: Contract,
    days: int = STALE_AFTER_DAYS,
    stage_column: str = "current_stage",
) -> DataFrame:
    """Current positions whose last follow-up is older than ``days``."""
    age = F.col("follow_up_age_days")
    return (
        ranked_position(history, contract)
        .filter(age > days)
        .select(
            contract.id_column, contract.request_column, stage_column, "follow_up_date", age
        )
        .orderBy(age.desc(), F.col(contract.id_column))
    )


def state_changes(
    history: DataFrame, contract: Contract, stage_column: str = "current_stage"
) -> DataFrame:
    """Rows whose content differs from the process's previous appearance.

    The window holds one process. In a history that is one row per snapshot date
    (checked by ``DUPLICATE_DAILY_PROCESS``), so a window never outgrows the number
    of dates, whatever the number of raw rows behind it.
    """
    timeline = Window.partitionBy(contract.id_column).orderBy(
        *[F.col(name).asc_nulls_last() for name in STATE_ORDER]
    )
    compared = history.select(
        "snapshot_date",
        contract.id_column,
        stage_column,
        "record_hash",
        F.lag("record_hash").over(timeline).alias("previous_hash"),
    )
    return (
        compared.filter(F.col("record_hash") != F.col("previous_hash"))
        .select("snapshot_date", contract.id_column, stage_column)
        .orderBy("snapshot_date", contract.id_column)
    )
