"""Quality rules as a short-circuit cascade.

Each rule is a condition that rejects a text. On a bounded sample the seconds and the
rejections of every rule are measured; rules then stand in the order of rejections per second, and
a text that one rule rejects is not shown to the next. The order changes the work, never the verdict.

The sample is taken by a seeded hash over all texts, and held with its counts, which every row needs anyway. A rule's cost is what it
adds to a pass over copies of the sample: the median of several timings, less that of a pass without a rule, after a pass to
warm up. So neither reading, counting nor starting a job is taken for the cost of a rule.
"""

from __future__ import annotations

import time
from dataclasses import dataclass
from statistics import median

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_names, let, with_results, words

SAMPLE_ROWS = 256  # texts on which cost and selectivity are estimated
SAMPLE_CHARS = 20_000  # of each such text
SAMPLE_SEED = 29
COPIES = 32  # of the sample in a timed pass
TIMINGS = 5  # of every rule; the median counts
_LEAST_COST = 1e-9  # seconds a row, for rules whose cost cannot be told from none
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column  # true: the text goes


def _packed(found: Column, bits: Column) -> Column:
    """Sorted hashes of all windows, each with its place in the low bits."""

    def hashed(w: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(w) - WINDOW),
            lambda i: F.call_function(
                "shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)), bits
            ).bitwiseOR(i.cast("long")),
        )

    none = F.array().cast("array<bigint>")
    return F.sort_array(F.when(F.size(found) >= WINDOW, let(found, hashed)).otherwise(none))


def _covered(packed: Column, bits: Column, found: Column) -> Column:
    """Words in windows that have a twin; twins are neighbours in the sorted array, and their words are compared."""

    def place_of(value: Column) -> Column:
        return value.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

    def same(one: Column, other: Column) -> Column:
        equal = F.call_function("shiftright", one, bits) == F.call_function("shiftright", other, bits)
        for word in range(WINDOW):
            equal &= F.get(found, place_of(one) + word) == F.get(found, place_of(other) + word)
        return equal

    def twin(s: Column, value: Column, i: Column) -> Column:
        before = (i > 0) & same(F.get(s, i - 1), value)
        after = (i < F.size(s) - 1) & same(F.get(s, i + 1), value)
        return before | after

    def count(s: Column) -> Column:
        twins = F.filter(s, lambda value, i: twin(s, value, i))
        places = F.sort_array(F.transform(twins, place_of))
        return F.aggregate(
            places,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last")),
            lambda seen, at: F.struct((seen["n"] + F.least(F.lit(WINDOW), at - seen["last"])).alias("n"), at.alias("last")),
            lambda seen: seen["n"],
        )

    return let(packed, count)


def with_repeated_words(frame: DataFrame, found: str, result: str) -> DataFrame:
    """``frame`` with the number of words in windows of three words found twice or more in the array ``found``.

    Windows are hashed and sorted with their places in the low bits, so equal
    windows are neighbours: n log n steps for n words, without a shuffle. The upper bits of the hashes find them and
    their words confirm them. Each step is a projection of its own, because a lambda would compute an expression again for
    every element.
    """
    bits, packed = free_names(frame, "_bits", "_packed")
    sized = frame.withColumn(bits, F.length(F.bin(F.size(found))))
    sorted_ = sized.withColumn(packed, _packed(F.col(found), F.col(bits)))
    return with_results(sorted_, {result: _covered(F.col(packed), F.col(bits), F.col(found))}).drop(bits, packed)


def base_counts(text: Column, found: Column) -> dict[str, Column]:
    """The counts that the rules use, of a text and its words; null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return {
        "n_words": F.size(found).cast("long"),
        "word_chars": F.length(F.array_join(found, "")).cast("long"),
        "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": let(lines, lambda kept: F.size(kept) - F.size(F.array_distinct(kept))).cast("long"),
    }


def with_counts(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with the base counts; the words stand in a projection of their own, split once."""
    (found,) = free_names(docs, "_words")
    split = docs.withColumn(found, words(F.col(text)))
    counted = with_results(split, base_counts(F.col(text), F.col(found)))
    return with_repeated_words(counted, found, "n_repeat_words").drop(found)


def standard_rules(text: str) -> list[Rule]:
    """Rules on the counts and the text; all of them are ratios of whole numbers."""
    whole = F.coalesce(F.col(text), F.lit(""))
    letters = F.length(F.regexp_replace(whole, r"[^\p{L}]+", ""))
    n_lines = F.size(F.split(whole, "\n"))
    bullets = F.regexp_count(whole, F.lit(r"(^|\n)[\x20\x09]*[-•*][\x20\x09]"))
    dots = F.regexp_count(whole, F.lit(r"(\.\.\.|…)[\x20\x09\x0D]*(\n|$)"))
    n_words, chars = F.col("n_words"), F.col("word_chars")
    return [
        Rule("symbols", 10 * F.col("n_symbols") > n_words),
        Rule("word_length", (chars < 2 * n_words) | (chars > 15 * n_words)),
        Rule("repeated_lines", 10 * F.col("n_dup_lines") > 3 * n_lines),
        Rule("letters", 10 * letters < 6 * chars),
        Rule("bullet_lines", 10 * bullets > 9 * n_lines),
        Rule("open_lines", 10 * dots > 3 * n_lines),
    ]


def seconds_of(copies: DataFrame, condition: Column) -> float:
    """Of one pass over a held table that evaluates a condition for every row."""
    started = time.perf_counter()
    copies.agg(F.count_if(condition)).first()
    return time.perf_counter() - started


def measured(counted: DataFrame, rules: list[Rule]) -> dict[str, tuple[float, float]]:
    """Seconds a row and share of rejections of every rule, on a small table that is held in memory meanwhile."""
    (copy,) = free_names(counted, "_copy")
    held = counted.coalesce(1).persist()
    try:
        rows = held.count()
        copies = held.withColumn(copy, F.explode(F.sequence(F.lit(1), F.lit(COPIES))))  # a condition is evaluated for each
        passes = {"": F.col(copy) < 0, **{rule.name: F.coalesce(rule.rejects, F.lit(False)) for rule in rules}}
        times = [{name: seconds_of(copies, condition) for name, condition in passes.items()} for _ in range(1 + TIMINGS)]
        usual = {name: median(turn[name] for turn in times[1:]) for name in passes}
        rejected = held.agg(*[F.count_if(rule.rejects).alias(f"r{i}") for i, rule in enumerate(rules)]).first() if rules else []
        return {
            rule.name: (max((usual[rule.name] - usual[""]) / max(1, rows * COPIES), _LEAST_COST), found / max(1, rows))
            for rule, found in zip(rules, rejected, strict=True)
        }
    finally:
        held.unpersist()


def in_order(rules: list[Rule], costs: dict[str, tuple[float, float]]) -> list[Rule]:
    """Most rejections per second first; rules that tie keep their order."""
    return sorted(rules, key=lambda rule: -costs[rule.name][1] / costs[rule.name][0])


def cascade(rules: list[Rule]) -> Column:
    """Name of the first rule, in the order given, that rejects a row; null if none does."""
    rejected_by = F
    for rule in rules:
        rejected_by = rejected_by.when(F.coalesce(rule.rejects, F.lit(False)), F.lit(rule.name))
    return rejected_by if rules else F.lit(None).cast("string")


def sample_of(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """A bounded sample over all rows, by a seeded hash; it only decides the order of the rules.

    Every task keeps its candidates alone, and the sample is read back from the driver.
    """
    plain = [f.name for f in docs.schema.fields if f.dataType.typeName() in ("string", "long", "integer", "double")]
    seeded = F.xxhash64(F.lit(SAMPLE_SEED), *[F.col(f"`{name}`") for name in plain])
    (order,) = free_names(docs, "_order")
    cut = [F.substring(F.col(f"`{f.name}`"), 1, SAMPLE_CHARS).alias(f.name) if f.dataType.typeName() == "string" else F.col(f"`{f.name}`") for f in docs.schema.fields]
    taken = docs.select(*cut, seeded.alias(order)).orderBy(order).limit(rows).drop(order)
    return docs.sparkSession.createDataFrame(taken.collect(), taken.schema)


def judge(docs: DataFrame, text: str = "text", rules: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the base counts, ``base_failed`` and ``kept``.

    ``base_failed``: fewer than 50 words, or more than half of the words in repeated windows of three.
    Texts that pass go through the cascade of ``rules``; ``kept`` says that nothing rejected them.
    Null and empty texts have no words and fail. Rows are judged one by one, so ties
    and repeated rows are judged alike and an empty table stays empty. Other columns
    pass through, whatever their names, and rules may use them; input columns named like a result give way.
    """
    rules = standard_rules(text) if rules is None else rules
    if len(rules) > 1:
        rules = in_order(rules, measured(with_counts(sample_of(docs), text), rules))
    counted = with_counts(docs, text)
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = with_results(counted, {"base_failed": base_failed})
    verdict = cascade([Rule("base", F.col("base_failed")), *rules])
    return with_results(judged, {"kept": verdict.isNull()})
