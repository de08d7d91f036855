"""Ranks by a distributed radix sort, least significant digit first.

Keys are cut into digits. A pass is one stable counting sort: every block of rows counts its digits; prefix sums of
the counts, over digits and then over blocks, say where the first row of each digit of each block goes; the rows of
the same digit follow in their order. The destination of a row is its place in the next pass, and blocks are cut anew from
places, so all blocks have the same size whatever the keys are. After the last pass the place is the rank.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

DIGIT_BITS = 10
BLOCK_ROWS = 1 << 14
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def digits_of(rows: DataFrame, keys: list[str], bits: int = DIGIT_BITS) -> list[Column]:
    """Digits of the composite key, the least significant first; bits that no row needs are left out."""
    ends = rows.agg(*[f(key).alias(f"{name}_{i}") for i, key in enumerate(keys) for name, f in (("low", F.min), ("high", F.max))]).first()
    digits = []
    for i, key in reversed([*enumerate(keys)]):
        low, high = ends[f"low_{i}"], ends[f"high_{i}"]
        if low is None or low == high:
            continue
        if high - low < 1 << 63:
            number, size = F.col(key) - F.lit(low), (high - low).bit_length()
        else:  # as unsigned numbers
            number, size = F.col(key).bitwiseXOR(F.lit(-1 << 63)), 64
        passes = -(-size // bits)
        width = -(-size // passes)
        mask = F.lit((1 << width) - 1).cast("bigint")
        digits += [F.shiftrightunsigned(number, shift).bitwiseAND(mask).cast("int") for shift in range(0, size, width)]
    return digits


def counting_pass(rows: DataFrame, digit: Column) -> DataFrame:
    """``rows`` with ``_place`` replaced by the place of a stable sort by ``digit``.

    ``_block`` and ``_place`` say where a row stands: blocks in their order, rows by place within a block.
    """
    dealt = rows.withColumn("_digit", digit)
    counts = staged(dealt.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_count")), "radix-counts")
    totals = sorted(counts.groupBy("_digit").agg(F.sum("_count").alias("n")).collect())  # 2 ** DIGIT_BITS rows at most
    starts = accumulate((row["n"] for row in totals[:-1]), initial=0)
    starts = [(row["_digit"], start) for row, start in zip(totals, starts, strict=False)]
    base = rows.sparkSession.createDataFrame(starts, "_digit INT, _base BIGINT")
    blocks = Window.partitionBy("_digit").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("_base") + F.coalesce(F.sum("_count").over(blocks), F.lit(0))
    offsets = counts.join(F.broadcast(base), "_digit").select("_digit", "_block", offset.alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_block", "_digit").orderBy("_place")) - 1
    placed = dealt.withColumn("_own", own).join(offsets, ["_block", "_digit"])
    return placed.withColumn("_place", F.col("_offset") + F.col("_own")).drop("_block", "_digit", "_own", "_offset")


def radix_ranks(
    rows: DataFrame, keys: list[str], name: str, bits: int = DIGIT_BITS, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``rows`` with their rank, from 0, by the ``BIGINT`` columns ``keys`` (most significant first, ascending).

    Keys must not be null. Rows that agree in all keys keep the order in which they were read. ``name`` and columns
    ``_block``, ``_place`` must not be columns of ``rows``. Each pass writes its rows, so plans stay short and a lost executor
    repeats tasks of one pass. A task of a pass holds the rows of one digit of one block: ``block_rows`` at most.
    An empty table stays empty.
    """
    rows = staged(rows.withColumn("_place", F.monotonically_increasing_id()), "radix-read")
    digits = digits_of(rows, keys, bits)
    block, constant = F.shiftright("_place", _PLACE_BITS), F.lit(0)
    for digit in digits or [constant]:
        rows = staged(counting_pass(rows.withColumn("_block", block), digit), "radix-pass")
        block = F.floor(F.col("_place") / block_rows)
    return rows.withColumnRenamed("_place", name)
