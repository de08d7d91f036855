"""Mixing sources to target weights by Sainte-Laguë apportionment.

Targets are cut into blocks of equal token counts. Blocks are seats: sources get them by the highest quotients
target / 1, target / 3, target / 5 …, and the blocks of a source go to its shards in the same way, so that
every shard has a whole quota. A shard is a stream of its documents in seeded order; its quota takes
whole passes over the stream, and the rest as the stream's first blocks.

The highest quotients are found by their divisor: weights divided by it and rounded add up to the seats. Sums over all parties
narrow the divisor down; only quotients that are left within its bounds are ranked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import packed, staged, unpacked
from tidemark.llm.feistel_shards import numbered

BLOCK = 16  # tokens
DOCS_PER_SHARD = 5_000
CROWDED = 4  # times as many documents make a shard be cut
SEED = 17
# Fixed values of the mix: weights by turns, tokens taken per token there is, passes over a source at most.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
PASSES = 2
_DIVISORS = 16  # steps between the bounds of a divisor


def _seats_at(divisor: Column) -> Column:
    return F.floor(F.col("weight") / divisor + 0.5)


def _with_divisors(parties: DataFrame) -> DataFrame:
    """Parties with the divisors ``low`` and ``high`` that deal at least and at most the seats of their group.

    Rounding moves a party by half a seat at most, which bounds the divisor at once. One scan counts the seats at
    ``_DIVISORS`` steps between the bounds and leaves one step.
    """
    whole, half = F.sum("weight"), F.count_if(F.col("weight") > 0) / 2
    wanted = F.any_value("seats")
    bounds = parties.groupBy("group").agg(
        F.coalesce(F.try_divide(whole, wanted + half), F.lit(0.0)).alias("low"),
        F.when(wanted > half, whole / F.greatest(wanted - half, F.lit(0.5))).otherwise(F.max("weight") * 2.5).alias("high"),
    )
    bounds = bounds.select("group", *[F.when(F.col(c) > 0, F.col(c)).otherwise(1.0).cast("double").alias(c) for c in ("low", "high")])
    steps = [F.col("low") + (F.col("high") - F.col("low")) * (i / _DIVISORS) for i in range(_DIVISORS + 1)]
    sums = parties.join(bounds, "group").groupBy("group", "low", "high", "seats").agg(
        *[F.sum(_seats_at(step)).alias(f"at{i}") for i, step in enumerate(steps)]
    )
    # The ends are known to deal enough and not too much, whatever their sums round to.
    enough = [F.when(F.col(f"at{i}") >= F.col("seats"), step) for i, step in enumerate(steps)]
    fits = [F.when(F.col(f"at{i}") <= F.col("seats"), step) for i, step in enumerate(steps)]
    found = sums.select("group", F.greatest("low", *enough).alias("low"), F.least("high", *fits).alias("high"))
    return parties.join(found, "group")


def apportioned(parties: DataFrame, weight: str, seats: Column, group: list[str], order: list[str]) -> DataFrame:
    """``parties`` with ``quota``: ``seats`` of their group (the same for all of it) dealt by the highest quotients.

    Equal quotients go by ``order``, which tells the parties of a group apart. Weights and seats are not negative; a party without
    weight gets no seat, and nor does a group of such parties. Nulls in ``group`` and ``order`` are values like others.
    The window of a group holds the quotients between two close divisors, not its parties.
    """
    keys = {"group": F.struct(F.lit(0), *[F.col(c) for c in group]), "order": F.struct(*[F.col(c) for c in order])}
    keyed = packed(parties, **keys, weight=F.col(weight), seats=seats.cast("long"))
    met = _with_divisors(keyed)
    # A divisor that deals exactly the seats leaves no quotient open.
    sure, most = _seats_at(F.greatest("low", "high")), _seats_at(F.least("low", "high"))
    met = staged(met.withColumns({"sure": sure.cast("long"), "most": most.cast("long")}).drop("low", "high"), "parties")
    left = met.groupBy("group").agg((F.any_value("seats") - F.sum("sure")).alias("left"))
    offered = met.filter(F.col("most") > F.col("sure")).select(
        "group", "order", "weight", F.explode(F.sequence("sure", F.col("most") - 1)).alias("next")
    )
    ranked = Window.partitionBy("group").orderBy((F.col("weight") / (2 * F.col("next") + 1)).desc(), "order", "next")
    dealt = offered.withColumn("rank", F.row_number().over(ranked)).join(left, "group").filter(F.col("rank") <= F.col("left"))
    won = dealt.groupBy("group", "order").agg(F.count(F.lit(1)).alias("won"))
    quota = F.col("sure") + F.coalesce("won", F.lit(0))
    return unpacked(met.join(won, ["group", "order"], "left"), parties.columns, {"quota": quota})


def source_targets(sources: DataFrame) -> DataFrame:
    """``sources`` (``source, n_docs, source_size``) with ``source_rank`` and ``target``.

    Sources in code point order, null last, weigh 5, 2, 1 by turns. A target stops at twice the source; what it gives up goes
    to the others by weight: targets are the lesser of cap and level times weight, and add up to the tokens wanted. The level rises
    from the one without caps: each step takes the sources that are full at it for full, and never passes the right one.
    """
    keyed = sources.withColumn("last", F.col("source").isNull().cast("int"))
    ranked = numbered(keyed, ["last", "source"], "place").withColumn("source_rank", F.col("place") + 1).drop("last", "place")
    turn = F.col("source_rank") % len(WEIGHTS)
    weight = F
    for i, value in enumerate(WEIGHTS):
        weight = weight.when(turn == (i + 1) % len(WEIGHTS), F.lit(float(value)))
    weighed = staged(ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * float(PASSES)), "weighed")
    tokens = SHARE * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    level, full = 0.0, None
    while True:
        is_full = F.col("cap") < level * F.col("weight")
        row = weighed.agg(
            F.coalesce(F.sum(F.when(is_full, F.col("cap"))), F.lit(0.0)).alias("cap"),
            F.coalesce(F.sum(F.when(~is_full, F.col("weight"))), F.lit(0.0)).alias("weight"),
            F.count_if(is_full).alias("full"),
        ).first()
        if row["full"] == full or not row["weight"]:
            break
        full, level = row["full"], (tokens - row["cap"]) / row["weight"]
    return weighed.select("source", "n_docs", "source_size", "source_rank", F.least("cap", level * F.col("weight")).alias("target"))


def plain_columns(frame: DataFrame) -> list[str]:
    """Columns whose values can be hashed."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType, T.NullType)
    return [f.name for f in frame.schema.fields if not isinstance(f.dataType, nested)]


def with_shards(placed: DataFrame, docs_per_shard: int) -> tuple[DataFrame, DataFrame]:
    """``placed`` with ``shard``, and size and quota of every shard.

    The hash of the id deals a source's documents to shards. Many rows with one id (or none) would crowd a
    shard: one with ``CROWDED`` times its documents is cut by the hash of all plain columns.
    """
    number = F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
    dealt = placed.withColumn("shard", number % F.col("shards")).withColumn("part", F.lit(0).cast("long"))
    keys = ["source_rank", "shard", "part"]
    sums = (F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("shard_size"), F.any_value("quota").alias("source_quota"))
    shards = staged(dealt.groupBy(*keys).agg(*sums), "shards")
    many = F.ceil(F.col("n_docs") / (CROWDED * docs_per_shard))
    crowded = shards.filter(many > 1).select("source_rank", "shard", many.alias("parts"))
    if not crowded.isEmpty():
        cut = dealt.join(crowded, ["source_rank", "shard"], "left")
        dealt = cut.withColumn("part", F.pmod("tie", F.coalesce("parts", F.lit(1)))).drop("parts")
        shards = staged(dealt.groupBy(*keys).agg(*sums), "shards")
    return dealt, shards


def mix(
    docs: DataFrame,
    source: str = "source",
    size: str = "size",
    doc_id: str = "doc_id",
    block: int = BLOCK,
    docs_per_shard: int = DOCS_PER_SHARD,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``source_size``, ``target`` (of its source) and ``taken`` (tokens the mix takes of the document).

    A document is taken whole as often as its shard's quota passes over the stream, plus the first tokens of
    it that the last, partial pass reaches; never more than twice. A source's taken tokens differ from its target by at
    most a block per shard and rounding. Some ``docs_per_shard`` documents are sorted together, however large a source is.

    Null sources are one source, the last; null sizes count as 0, and documents of size 0 are never taken. Rows that repeat an id
    (or have none) lie near each other in the stream, by size and by the hash of their plain columns, or in shards of
    their own if there are many; only rows that agree in all plain columns cannot be told apart, and stay together. Other
    columns pass through, whatever their names; input columns named like a result give way. Empty tables stay empty.
    """
    id_ = F.col(f"`{doc_id}`")
    frame = packed(
        docs,
        id=id_,
        source=F.col(f"`{source}`"),
        size=F.coalesce(F.col(f"`{size}`"), F.lit(0)).cast("long"),
        order=F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))),
        tie=F.xxhash64(*[F.col(f"`{c}`") for c in plain_columns(docs)]),
    )
    sums = frame.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").cast("long").alias("source_size"))
    targets = source_targets(sums)
    seats = round_half_up(targets.agg(F.sum("target")).first()[0] or 0.0, block)
    shards = F.ceil(F.col("n_docs") / docs_per_shard).cast("long")
    sources = apportioned(targets, "target", F.lit(seats), [], ["source_rank"]).select(
        F.col("source").alias("of"), "source_size", "target", "source_rank", "quota", shards.alias("shards")
    )
    # Sources and quotas are written first: their real size then decides whether the documents move to meet them.
    sources = staged(sources, "sources")
    placed = frame.join(sources, F.col("source").eqNullSafe(F.col("of")))
    placed, shards = with_shards(placed, docs_per_shard)
    keys = ["source_rank", "shard", "part"]
    quotas = apportioned(shards, "shard_size", F.col("source_quota"), ["source_rank"], ["shard", "part"])
    quotas = staged(quotas.select(*keys, "shard_size", F.col("quota").alias("shard_quota")), "quotas")
    streamed = placed.join(quotas, keys)
    stream = Window.partitionBy(*keys).orderBy("order", "id", "size", "tie")
    begin = F.sum("size").over(stream.rowsBetween(Window.unboundedPreceding, -1))
    blocks = F.ceil(F.col("shard_size") / block)
    quota = F.least(F.col("shard_quota"), PASSES * blocks)
    passes = F.when(blocks > 0, F.floor(quota / blocks)).otherwise(0)
    reach = (quota - passes * blocks) * block
    rest = F.least(F.greatest(reach - F.coalesce(begin, F.lit(0)), F.lit(0)), F.col("size"))
    results = {"source_size": F.col("source_size"), "target": F.col("target"), "taken": (passes * F.col("size") + rest).cast("long")}
    return unpacked(streamed, docs.columns, results)


def round_half_up(tokens: float, block: int) -> int:
    return int(tokens / block + 0.5)
