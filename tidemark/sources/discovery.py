"""Snapshot files: listing, dating, numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.contract import Contract
from tidemark.functions.values import file_name, snapshot_date_from_name
from tidemark.sources.listing import list_folder, matching
from tidemark.staging import Stage, cut_lineage

# Fixed value: names of the lock files an office program leaves beside an open workbook.
LOCK_FILE_PREFIX = "~$"

FILE_ORDER = ("snapshot_date", "file_sort_name", "path")
_ROW_BITS = 33  # monotonically_increasing_id keeps the partition above this many bits


def list_files(source: str | DataFrame, spark: SparkSession, stage: Stage | None = None) -> DataFrame:
    """``path``, ``relative`` and ``length`` of the files of a folder, or of an inventory that names them.

    An inventory is a table with ``path`` and ``length``, for stores whose listing is kept anyway; its patterns match
    the end of the path.
    """
    if isinstance(source, str):
        return list_folder(spark, source, stage)
    return source.select("path", F.col("path").alias("relative"), F.col("length").cast("bigint").alias("length"))


def snapshot_files(paths: DataFrame, contract: Contract) -> DataFrame:
    """The snapshot files among ``paths``, each with its name and date (null if undated).

    Patterns match the path below the folder (``relative``), or ``path`` where nothing else is known.
    """
    below = F.col("relative" if "relative" in paths.columns else "path")
    named = paths.withColumn("source_file", file_name(F.col("path")))
    wanted = named.filter(
        matching(below, contract.file_patterns) & ~F.col("source_file").startswith(LOCK_FILE_PREFIX)
    )
    return wanted.drop("relative").withColumn(
        "snapshot_date", snapshot_date_from_name(F.col("source_file"))
    )


def undated_files(files: DataFrame) -> DataFrame:
    """Files whose name holds no date, or an impossible one; they are skipped."""
    return files.filter(F.col("snapshot_date").isNull())


def number_in_order(frame: DataFrame, keys: tuple[str, ...], name: str) -> DataFrame:
    """Number the rows 1, 2, 3 … over the whole table in key order.

    A global window would bring every row to one task. Instead the rows are range
    partitioned and sorted, each partition numbers its own rows, and the sizes of
    the partitions before it are added. The sorted rows are checkpointed, so both
    steps see the same partitions. Only one row per partition is broadcast.
    """
    ordered = cut_lineage(
        frame.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", _ROW_BITS)
    in_part = F.col("place").bitwiseAND((1 << _ROW_BITS) - 1)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy(part.alias("part"))
        .agg(F.count(F.lit(1)).alias("size"))
        .select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    )
    return (
        ordered.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn(name, (F.col("offset") + in_part + 1).cast("int"))
        .drop("part", "offset", "place")
    )


def snapshot_order(files: DataFrame) -> DataFrame:
    """Dated files numbered by date, then name regardless of case, then path."""
    dated = files.filter(F.col("snapshot_date").isNotNull())
    named = dated.withColumn("file_sort_name", F.lower("source_file"))
    return number_in_order(named, FILE_ORDER, "snapshot_order").drop("file_sort_name")
