"""Quality classifier on learned subword embeddings.

Words and character n-grams are hashed to rows of a table of learned vectors; a document is the mean of its
vectors, and a softmax over two outputs gives its score. Vectors and outputs are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import with_results
from tidemark.llm.hypervectors import held_out
from tidemark.llm.tokens import IS_SPACE, LOWER, Texts, mixed, pieces, words_of

BUCKET_BITS = 15
SIZES = (3, 4)  # bytes of an n-gram; only its ends may be white space
VECTOR = 16
SAMPLE_PER_LABEL = 1_500  # labelled documents that training reads, per label
EPOCHS = 12
RATE = 4.0  # of the first step; it falls to zero in a straight line
SEED = 5
_GRAM_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_AGAIN = 1  # the word that a word equal to the one before it adds


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int32)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Number of the text and bucket, for every word and n-gram of whole texts."""
    words = words_of(texts)
    again = np.flatnonzero((words.hashes[1:] == words.hashes[:-1]) & (words.text[1:] == words.text[:-1])) + 1
    owners = [words.text, words.text[again]]
    buckets = [_bucket(words.hashes), np.full(len(again), _AGAIN, np.int32)]
    space = IS_SPACE[texts.data]
    folded = np.where(space, np.uint8(32), LOWER[texts.data]).astype(np.uint64)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(texts.bounds))
    for size in SIZES:
        n = len(folded) - size + 1
        if n <= 0:
            continue
        inside = owner[:n] == owner[size - 1 :]
        packed = np.full(n, np.uint64(size))
        for i in range(size):
            packed = packed << np.uint64(8) | folded[i : i + n]
            if 0 < i < size - 1:
                inside &= ~space[i : i + n]
        owners.append(owner[:n][inside])
        buckets.append(_bucket(packed[inside] * _GRAM_FACTOR))
    return np.concatenate(owners).astype(np.int64), np.concatenate(buckets)


def sparse_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Buckets and their parts of the mean, as bytes, of (label, order, text) batches."""
    for batch, texts in pieces(batches, 2):
        owner, bucket = features(texts)
        found, counts = np.unique(owner << BUCKET_BITS | bucket, return_counts=True)
        bounds = np.searchsorted(found >> BUCKET_BITS, np.arange(len(texts) + 1))
        rows = [slice(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        ids = (found & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
        parts = [(counts[r] / max(1, counts[r].sum())).astype(np.float32).tobytes() for r in rows]
        columns = [batch.column(0), batch.column(1), pa.array([ids[r].tobytes() for r in rows], pa.binary()), pa.array(parts, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "place", "buckets", "parts"])


@dataclass
class Model:
    """``worth`` of every bucket: what its vector adds to the difference of the two outputs."""

    worth: np.ndarray
    bias: float


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = SEED) -> Model:
    """Vectors, outputs and bias by stochastic gradient descent; rows are label, buckets, parts of the mean.

    The score needs only each vector's product with the difference of the outputs, so that is what the model keeps.
    Without rows of both labels, every score is the share of label 1 (a half without any row).
    """
    labels = [label for label, _, _ in rows]
    if len(set(labels)) < 2:
        share = (sum(labels) + 1) / (len(labels) + 2)
        return Model(np.zeros(1 << BUCKET_BITS, np.float32), float(np.log(share / (1 - share))))
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / VECTOR, 1 / VECTOR, (1 << BUCKET_BITS, VECTOR)).astype(np.float32)
    outputs, bias = np.zeros((VECTOR, 2), np.float32), np.zeros(2, np.float32)
    steps, step = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in random.permutation(len(rows)):
            label, buckets, parts = rows[i]
            rate = RATE * (1 - step / steps)
            step += 1
            own = vectors[buckets]
            mean = parts @ own
            logits = mean @ outputs + bias
            chances = np.exp(logits - logits.max())
            error = chances / chances.sum()
            error[label] -= 1
            back = outputs @ error
            outputs -= rate * np.outer(mean, error)
            bias -= 0.01 * rate * error
            vectors[buckets] = own - rate * np.outer(parts, back)
    return Model(vectors @ (outputs[:, 1] - outputs[:, 0]), float(bias[1] - bias[0]))


def scores_of(texts: Texts, model: Model) -> np.ndarray:
    owner, bucket = features(texts)
    total = np.bincount(owner, weights=model.worth[bucket], minlength=len(texts))
    counts = np.bincount(owner, minlength=len(texts))
    logits = np.clip(total / np.maximum(counts, 1) + model.bias, -700, 700)
    return 1 / (1 + np.exp(-logits))


def scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Score, in place of the text, of batches whose last column is the text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.num_columns - 1
            for part, texts in pieces(iter([batch]), text):
                columns = [part.column(i) for i in range(text)] + [pa.array(scores_of(texts, model))]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:-1], "score"])

    return score


def sample(labelled: DataFrame, text: str, label: str, order: str) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """Training rows: per label the ``SAMPLE_PER_LABEL`` documents whose hashed ``order`` column comes first."""
    rows = labelled.select(
        F.col(label).cast("int").alias("label"), F.xxhash64(order).alias("place"), F.col(text).alias("text")
    )
    found = []
    for value in (0, 1):
        limit = rows.filter(F.col("label") == value).select("place").orderBy("place").limit(SAMPLE_PER_LABEL).agg(F.max("place")).first()[0]
        if limit is None:
            continue
        taken = rows.filter((F.col("label") == value) & (F.col("place") <= limit))
        sparse = taken.mapInArrow(sparse_rows, "label INT, place BIGINT, buckets BINARY, parts BINARY")
        found += sparse.orderBy("place", "buckets", "parts").limit(SAMPLE_PER_LABEL).collect()
    return [
        (row["label"], np.frombuffer(row["buckets"], np.int32), np.frombuffer(row["parts"], np.float32)) for row in found
    ]


def score_quality(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from 0.5 on).

    Whole texts are read. Null and empty texts have no features, so their score is the bias alone. Rows are judged
    one by one: repeated rows alike, empty tables stay empty. Input columns named like a result give way.
    """
    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted", text.lower())]
    rows = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)], F.col(text).alias("text"))
    fields = [f"c{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(kept)]
    scored = rows.mapInArrow(scorer(model), ", ".join([*fields, "score DOUBLE"]))
    named = scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(kept)], "score")
    return with_results(named, {"score": F.col("score"), "predicted": (F.col("score") >= 0.5).cast("int")})


def held_out_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per document; learned from labelled rows not held out.

    Labels that are null, or whose document is missing, teach nothing; an id with several labels teaches each of them.
    """
    marked = with_results(docs.select("doc_id", "text"), {"held_out": held_out("doc_id", folds, fold)})
    known = labels.filter(F.col("quality").isNotNull()).select("doc_id", "quality")
    known = known.filter(~held_out("doc_id", folds, fold))
    learned = marked.filter(~F.col("held_out")).join(known, "doc_id")
    model = train(sample(learned, "text", "quality", "doc_id"))
    return score_quality(marked, model)
