"""Documents drawn by their likeness to a target, with weights of hashed runs of words.

Runs of one and two words fall into buckets by their CRC-32. Two arrays of bucket counts, of the corpus and of the target,
give an array of gains: the logarithm of how much likelier a bucket is in the target. A document's weight is the mean gain
of its runs, looked up in that array. Weight plus seeded Gumbel noise is its score; the highest scores
are drawn, in proportion to the weights' exponentials and without replacement. Scores are ranked by a
distributed radix sort.

Checksums are computed for all words of a piece of text at once: one array step per byte position, over the words that
are so long.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.radix_sort import radix_ranks
from tidemark.llm.tokens import LOWER, Texts, pieces

BUCKETS = 10_000
WIDTH = 2  # words of a run, at most
LEAST_WORDS = 20  # a document with fewer is never drawn
DRAWN = 25  # of 100 documents with enough words
UNIT = 1000  # gains, weights and scores are whole numbers of so many parts
SEED = 7
_LONG_WORD = 64  # bytes; the rest of a longer word is one call of zlib
_POLYNOMIAL = 0xEDB88320  # fixed value: CRC-32, bits reversed

_IN_WORD = np.ones(256, bool)
_IN_WORD[[*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, table >> 1 ^ np.uint32(_POLYNOMIAL), table >> 1)
    return table


_TABLE = _crc_table()


def spans_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """First byte, length and text of every word of lower-cased texts."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _IN_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    begin = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return begin, end - begin, np.searchsorted(bounds, begin, "right") - 1


def continued(state: np.ndarray, data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Inner states of CRC-32 after the bytes ``begin`` to ``begin + length`` were read in each ``state``."""
    order = np.argsort(-length, kind="stable")
    state, begin, length = state[order], begin[order], length[order]
    steps = min(int(length[0]), _LONG_WORD) if len(length) else 0
    longer = np.searchsorted(-length, -np.arange(steps))  # words with more bytes than so many
    for step, n in enumerate(longer.tolist()):
        state[:n] = _TABLE[(state[:n] ^ data[begin[:n] + step]) & 0xFF] ^ state[:n] >> np.uint32(8)
    for i in range(int(np.searchsorted(-length, -_LONG_WORD))):
        rest = data[begin[i] + _LONG_WORD : begin[i] + length[i]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    found = np.empty_like(state)
    found[order] = state
    return found


def runs_of(texts: Texts, width: int = WIDTH, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and text of every run of 1 to ``width`` words, and the number of words of every text."""
    data = LOWER[texts.data]
    begin, length, text = spans_of(data, texts.bounds)
    state = continued(np.full(len(begin), 0xFFFFFFFF, np.uint32), data, begin, length)  # by first word of a run
    found, of = [state], [text]
    for more in range(1, width):
        first = np.flatnonzero(text[: max(0, len(text) - more)] == text[more:])
        spaced = _TABLE[(state[first] ^ 0x20) & 0xFF] ^ state[first] >> np.uint32(8)
        state = np.zeros_like(state)
        state[first] = continued(spaced, data, begin[first + more], length[first + more])
        found.append(state[first])
        of.append(text[first])
    hashes = np.concatenate(found) ^ np.uint32(0xFFFFFFFF)
    return (hashes % np.uint32(buckets)).astype(np.int64), np.concatenate(of), np.bincount(text, minlength=len(texts))


def counter(width: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``bucket, n`` of a task's batches of texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for _, texts in pieces(batches, 0):
            counts += np.bincount(runs_of(texts, width, buckets)[0], minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["bucket", "n"])

    return count


def bucket_counts(docs: DataFrame, text: str, width: int = WIDTH, buckets: int = BUCKETS) -> np.ndarray:
    """Runs of all texts per bucket; ``buckets`` numbers reach the driver."""
    parts = docs.select(F.col(f"`{text}`").alias("text")).mapInArrow(counter(width, buckets), "bucket INT, n BIGINT")
    counts = [0] * buckets
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return np.array(counts, np.int64)


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Whole parts of the logarithm by which each bucket is likelier in the target; one is added to every count."""
    n, own, whole = len(corpus), float(target.sum()), float(corpus.sum())
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(UNIT * math.log((t + 1.0) * (whole + n) / ((s + 1.0) * (own + n)))) for s, t in pairs], np.int64)


def weigher(gains: np.ndarray, width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``id, version, n_words, n_features, weight`` of (id, version, text) batches."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in pieces(batches, 2):
            found, of, words = runs_of(texts, width, len(gains))
            features = np.bincount(of, minlength=len(texts))
            order = np.argsort(of, kind="stable")
            sums = np.concatenate(([0], np.cumsum(gains[found[order]])))
            ends = np.cumsum(features)
            weight = (sums[ends] - sums[ends - features]) // np.maximum(features, 1)
            columns = [batch.column(0), batch.column(1), pa.array(words), pa.array(features), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "version", "n_words", "n_features", "weight"])

    return weigh


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in whole parts, from the SHA-256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-float(UNIT) * F.log(-F.log((number + 0.5) / float(1 << 32)))).cast("bigint")


def resample(
    docs: DataFrame,
    target: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    target_text: str = "text",
    drawn: int = DRAWN,
    least_words: int = LEAST_WORDS,
    seed: int = SEED,
    width: int = WIDTH,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Per row of ``docs``: ``doc_id, version, n_features, weight, score, rank``; ``version`` is a hash of the text.

    ``n_features`` counts the runs of 1 to ``width`` words, ``weight`` is the floored mean of their gains (none: 0), ``score``
    adds the noise of the id. ``drawn`` of 100 documents with ``least_words`` words or more get a ``rank``, from 1, by
    score; equal scores go to the smaller id. The others have a null rank.

    Null and empty texts have no words. A null id has noise of its own (of an empty id) and stands after the other ids of its
    score. Rows that repeat an id have the same noise and are ranked one by one: equal scores by the hash of the text; rows
    equal in that too are interchangeable. Other columns are not read; :func:`drawn_documents` keeps them. An empty table
    gives an empty table, an empty target gives gains that only count against the corpus.
    """
    kind = docs.select(F.col(f"`{doc_id}`")).schema[0].dataType.simpleString()
    gains = gains_of(bucket_counts(docs, text, width, buckets), bucket_counts(target, target_text, width, buckets))
    read = docs.select(
        F.col(f"`{doc_id}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("version"), F.col(f"`{text}`").alias("text")
    )
    schema = f"id {kind}, version BIGINT, n_words BIGINT, n_features BIGINT, weight BIGINT"
    weighed = read.mapInArrow(weigher(gains, width), schema)
    scored = staged(weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scores")
    enough = F.col("n_words") >= least_words
    able = scored.filter(enough)
    keys = {"_down": -F.col("score"), "_none": F.col("id").isNull().cast("bigint"), "_id": F.coalesce(F.col("id").cast("bigint"), F.lit(0))}
    repeated = able.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    if not repeated.isEmpty():  # further passes, which distinct ids do not need
        keys["_text"] = F.col("version")
    ranked = radix_ranks(able.withColumns(keys), list(keys), "_rank")
    n = ranked.count()
    rank = F.when(F.col("_rank") < n * drawn // 100, F.col("_rank") + 1).alias("rank")
    outside = scored.filter(~enough).withColumn("rank", F.lit(None).cast("bigint"))
    results = ["id", "version", "n_features", "weight", "score", "rank"]
    both = ranked.select(*results[:-1], rank).unionByName(outside.select(*results))
    return both.withColumnRenamed("id", doc_id)


def drawn_documents(docs: DataFrame, ranks: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` that were drawn, all columns kept; a text that repeats with its id stays once per drawn row's id and text."""
    version = F.xxhash64(F.col(f"`{text}`"))
    names = {c.lower() for c in docs.columns}
    own = next(f"_drawn{i or ''}" for i in range(len(names) + 1) if f"_drawn{i or ''}_id" not in names and f"_drawn{i or ''}_version" not in names)
    chosen = ranks.filter(F.col("rank").isNotNull()).select(
        F.col(f"`{doc_id}`").alias(f"{own}_id"), F.col("version").alias(f"{own}_version")
    ).distinct()
    same = F.col(f"`{doc_id}`").eqNullSafe(F.col(f"{own}_id")) & (version == F.col(f"{own}_version"))
    return docs.join(chosen, same, "left_semi")
