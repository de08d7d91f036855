"""From raw documents to shuffled training shards: five stages, each over all that the one before it kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result is written and read again as
the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import apportioned_mix, cgk_leaks, feistel_shards, hypervectors, minmax_dedup
from tidemark.llm.common import ROW, WHITE, WORD_GAP, packed, staged, table, unpacked, words

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
LEAST_COSINE = 0.15  # a text below it is in none of the learned languages, however long
PART = 0.5  # of the cosine to expect of its number of trigrams that a text has at least
NOISES = 3  # standard deviations of a cosine in so many dimensions by which a text may fall short
SHARDS = 40

# Language models, banded signatures and permutations cannot be expressed in SQL; tests/llm checks every stage.
ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus.

    Those without letters go, and those that resemble no language. The cosine to expect of a clean text grows with the
    root of its number of trigrams, the slower the more different trigrams its language has, and chance moves it by
    ``1 / sqrt(DIMENSIONS)``: a text needs ``PART`` of it less ``NOISES`` times that, and never more than ``LEAST_COSINE``.
    Fewer than eight trigrams tell nothing, so letters are enough for them. Languages are learned from all documents that
    name theirs; a null one teaches nothing. Null and empty texts go, rows with a null id and repeated rows are judged like others.
    """
    own = {name: f"column_{i}" for i, name in enumerate(docs.columns)}  # no result is named like them
    plain = docs.toDF(*own.values())
    judged = hypervectors.predict_language(plain, plain, own["text"], own["lang"], expected="expected")
    needed = PART * F.col("expected") - NOISES / hypervectors.DIMENSIONS**0.5
    strange = F.col("score") < F.least(F.lit(LEAST_COSINE), needed)
    kept = judged.filter((F.col("lang_pred") != hypervectors.UNKNOWN) & ~strange)
    return kept.select(*[F.col(number).alias(name) for name, number in own.items()])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares four fifths of its runs of five words, the one with the least id.

    Texts without words are alike with nothing and stay; a text under five words is one run. Rows with a null id stay. Rows
    that repeat id and text become one row; a repeated id with another text is a document of its own. Whole texts are read.
    """
    return minmax_dedup.drop_near_duplicates(docs, width=5, percent=80).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none. Rows with a null id stay, because a leak cannot name them; rows that repeat an id go
    together if one of them holds an item. Whole texts are read.
    """
    return cgk_leaks.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def first_words(text: Column, many: Column) -> Column:
    """The text up to the end of its word number ``many``; it has more words than that."""
    begun = F.ltrim(text, F.lit(WHITE))
    rest = F.element_at(F.split(begun, WORD_GAP, many + 1), -1)
    return F.rtrim(F.substring(text, F.lit(1), F.length(text) - F.length(rest)), F.lit(WHITE))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; the last copy may be their first words only.

    Null and empty texts have no words and are not taken. A null source is a source. Rows with a null id are taken like
    others; rows that repeat an id are documents of their own, rows equal in all plain columns cannot be told apart. All columns
    stay as they are, but for ``text`` and ``n_chars`` of a copy that is cut.
    """
    sized = packed(docs, doc_id=F.col("doc_id"), source=F.col("source"), size=F.size(words(F.col("text"))).cast("int"), text=F.xxhash64("text"))
    mixed = apportioned_mix.mix(sized).filter(F.col("taken") > 0)
    passes, rest = F.floor(F.col("taken") / F.col("size")).cast("int"), (F.col("taken") % F.col("size")).cast("int")
    counted = mixed.select(ROW, passes.alias("passes"), rest.alias("rest"))
    number = F.explode(F.sequence(F.lit(1), F.col("passes") + (F.col("rest") > 0).cast("int")))
    copies = counted.select(ROW, "passes", "rest", number.alias("number"))
    whole = F.col(ROW).getField("text")
    copies = copies.withColumn("text", F.when(F.col("number") > F.col("passes"), first_words(whole, F.col("rest"))).otherwise(whole))
    results = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return unpacked(copies, docs.columns, results).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot.

    Rows are numbered by id (null first), length and hash of the text; rows that agree in all three are
    interchangeable. Columns ``shard`` and ``slot`` of the input give way.
    """
    keyed = packed(docs, id=F.col("doc_id"), length=F.length("text"), version=F.xxhash64("text"))
    placed = feistel_shards.shard(keyed, SHARDS, ["id", "length", "version"])
    return unpacked(placed, docs.columns, {"shard": F.col("shard"), "slot": F.col("slot")})


STAGES = [
    ("identify_language", identify_language),
    ("drop_near_duplicates", drop_near_duplicates),
    ("drop_leaks", drop_leaks),
    ("mix_sources", mix_sources),
    ("shard", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
