"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged


def _towards_least(pairs: DataFrame) -> DataFrame:
    """Every ``u`` of the pairs with the least of itself and its partners."""
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("least"))


def _large_star(links: DataFrame) -> DataFrame:
    """Partners above a node are linked to the least node around it."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.join(_towards_least(both), "u")
    return joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its partners below are linked to the least of them."""
    joined = links.join(_towards_least(links), "u")
    moved = joined.filter(F.col("v") != F.col("least")).select(F.col("v").alias("u"), F.col("least").alias("v"))
    own = joined.select("u", F.col("least").alias("v"))
    return moved.unionByName(own).distinct()


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def stars(links: DataFrame) -> DataFrame:
    """``u, v``: every linked node (but the least of its component) with the least node of its component.

    ``links`` has columns ``u`` and ``v`` of any ordered type, in any direction, and may repeat.
    Each round writes its links, so neither plans nor lineage grow; rounds grow with the logarithm of the
    component's diameter. Only a count and a checksum reach the driver.
    """
    high, low = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    links = staged(links.filter(F.col("u") != F.col("v")).select(high, low).distinct(), "links")
    state = _state(links)
    while True:
        links = staged(_small_star(staged(_large_star(links), "large-star")), "small-star")
        state, before = _state(links), state
        if state == before:
            return links
