"""Column helpers and staged tables that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.staging import Stage

# The white space between words, as characters and as a class.
WHITE = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(frame: DataFrame, name: str) -> DataFrame:
    """Written below the cluster's shared folder and read back: computed once, and it survives lost executors."""
    return Stage(frame.sparkSession).write(frame, name)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body or a lambda in it uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE))


def words(text: Column) -> Column:
    """Words of a text, in order; no words for null, empty and blank texts."""
    trimmed = strip(F.coalesce(text, F.lit("")))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, WORD_GAP))


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as keep it apart from the columns of ``frame``."""
    taken = {c.lower() for c in frame.columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        found.append(name)
    return found


ROW = "_row"


def packed(frame: DataFrame, **working: Column) -> DataFrame:
    """The columns of ``frame`` as one struct, and working columns beside it that no input name can meet."""
    return frame.select(F.struct(*[F.col(f"`{c}`") for c in frame.columns]).alias(ROW), *[v.alias(k) for k, v in working.items()])


def unpacked(frame: DataFrame, columns: list[str], results: dict[str, Column]) -> DataFrame:
    """The ``columns`` that were packed, and result columns; a packed column of the same name (in any case) gives way."""
    taken = {name.lower() for name in results}
    # Results are computed before any name of the caller stands beside them, which Spark could take for an alias.
    found = frame.select(ROW, *[value.alias(f"result_{i}") for i, value in enumerate(results.values())])
    kept = [F.col(ROW).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return found.select(*kept, *[F.col(f"result_{i}").alias(name) for i, name in enumerate(results)])


_SCAN_BLOCK = 64


def running(values: Column, combine: Callable[[Column, Column], Column], start: int) -> Column:
    """Running results of ``combine`` over an array of longs, the own value included; ``start`` changes no value.

    Arrays can only grow by a copy, so the running results of short blocks are found first, and then what stands before each.
    """
    kind = "struct<last:bigint,found:array<bigint>>"
    begin = F.struct(F.lit(start).cast("bigint").alias("last"), F.array().cast("array<bigint>").alias("found")).cast(kind)

    def of_block(block: Column) -> Column:
        def step(seen: Column, value: Column) -> Column:
            now = combine(seen["last"], value)
            return F.struct(now.alias("last"), F.array_append(seen["found"], now).alias("found"))

        return F.aggregate(block, begin, step, lambda seen: seen["found"])

    def before(blocks: Column) -> Column:
        def step(seen: Column, block: Column) -> Column:
            now = combine(seen["last"], F.element_at(block, -1))
            return F.struct(now.alias("last"), F.array_append(seen["found"], seen["last"]).alias("found"))

        return F.aggregate(blocks, begin, step, lambda seen: seen["found"])

    def joined(blocks: Column) -> Column:
        return let(before(blocks), lambda offsets: F.flatten(
            F.transform(blocks, lambda block, i: F.transform(block, lambda value: combine(F.get(offsets, i), value)))
        ))

    def all_of(found: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _SCAN_BLOCK).cast("int"))
        blocks = F.transform(numbers, lambda i: of_block(F.slice(found, i * _SCAN_BLOCK + 1, F.lit(_SCAN_BLOCK))))
        return F.when(F.size(found) > 0, let(blocks, joined)).otherwise(F.array().cast("array<bigint>"))

    return let(values, all_of)


_PIECE_BITS = 8


def pieces_of(text: Column) -> Column:
    """A text in pieces of 256 characters, for :func:`cut`."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % (1 << _PIECE_BITS)), F.lit(0))


def cut(pieces: Column, begin: Column, end: Column) -> Column:
    """Characters ``begin`` to ``end`` (exclusive) of a text in pieces; the work does not grow with what stands before them."""
    first = F.shiftright(begin, _PIECE_BITS)
    many = F.shiftright(end - 1, _PIECE_BITS) - first + 1
    whole = F.array_join(F.slice(pieces, (first + 1).cast("int"), F.greatest(many, F.lit(0)).cast("int")), "")
    own = F.substring(whole, (begin - F.shiftleft(first, _PIECE_BITS) + 1).cast("int"), (end - begin).cast("int"))
    return F.when(end > begin, own).otherwise(F.lit(""))


def with_results(frame: DataFrame, results: dict[str, Column]) -> DataFrame:
    """``frame`` with result columns; an input column of the same name (in any case) gives way."""
    taken = {name.lower() for name in results}
    kept = [F.col(f"`{c}`") for c in frame.columns if c.lower() not in taken]
    return frame.select(*kept, *[value.alias(name) for name, value in results.items()])
