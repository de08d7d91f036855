"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to N - 1 in key order. A keyed Feistel network on a grid just larger than N permutes
the numbers; a number that leaves the range walks on through the same permutation until it is back (cycle
walking). The permuted number modulo the shards is the shard, the quotient the slot: shuffle, shard
and slot of a row follow from its number alone, and every permuted number is used once.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import packed, staged, unpacked
from tidemark.llm.tokens import mixed

ROUNDS = 6
SEED = 11
_PLACE_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def sides(n: int) -> tuple[int, int]:
    """Sides of the smallest nearly square grid with at least ``n`` cells."""
    left = max(1, math.isqrt(max(0, n - 1)) + 1)
    return left, max(1, -(-n // left))


def round_keys(seed: int) -> np.ndarray:
    return mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mixed(np.array([seed], np.uint64))[0])


def _once(numbers: np.ndarray, left: int, right: int, keys: np.ndarray) -> np.ndarray:
    high, low = numbers // right, numbers % right
    for i, key in enumerate(keys):
        if i % 2:
            low = (low + (mixed(high.astype(np.uint64) + key) % np.uint64(right)).astype(np.int64)) % right
        else:
            high = (high + (mixed(low.astype(np.uint64) + key) % np.uint64(left)).astype(np.int64)) % left
    return high * right + low


def permuted(numbers: np.ndarray, n: int, seed: int = SEED) -> np.ndarray:
    """The permutation of 0 to n - 1 at ``numbers``."""
    (left, right), keys = sides(n), round_keys(seed)
    found = _once(numbers.astype(np.int64), left, right, keys)
    outside = np.flatnonzero(found >= n)
    while len(outside):
        found[outside] = _once(found[outside], left, right, keys)
        outside = outside[found[outside] >= n]
    return found


def _permutation(n: int, seed: int) -> Callable:
    @F.pandas_udf("bigint")
    def permute(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), n, seed))

    return permute


def numbered(frame: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``frame``, written, with row numbers from 0 in key order (nulls first).

    Rows are range partitioned and sorted; each partition numbers its own rows and adds the sizes of
    the partitions before it. Only one row per partition is broadcast. Rows that agree in all keys may lie
    in any order; keys that tell rows apart make the numbers reproducible. Columns ``_part``, ``_place`` and ``_offset`` are its own.
    """
    ordered = frame.repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = staged(ordered.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", _PLACE_BITS)
    sizes = ordered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    joined = ordered.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    number = F.col("_offset") + F.col("_place").bitwiseAND((1 << _PLACE_BITS) - 1)
    return joined.withColumn(name, number).drop("_part", "_offset", "_place")


def shard(docs: DataFrame, shards: int, keys: list[str], seed: int = SEED) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Shards differ by one row at most. ``keys`` number the rows: give enough of them to tell rows apart, then
    reruns agree whatever the partitioning; rows that agree in every key are interchangeable. Nulls in
    keys come first. Other columns pass through, whatever their names; input columns named like a result give way. An
    empty table stays empty.
    """
    keyed = packed(docs, **{f"key_{i}": F.col(f"`{key}`") for i, key in enumerate(keys)})
    rows = numbered(keyed, [f"key_{i}" for i in range(len(keys))], "number")
    n = rows.count()
    placed = rows.withColumn("placed", _permutation(n, seed)("number"))
    results = {
        "shard": (F.col("placed") % shards).cast("int"),
        "slot": F.floor(F.col("placed") / shards).cast("long"),
    }
    return unpacked(placed, docs.columns, results)
