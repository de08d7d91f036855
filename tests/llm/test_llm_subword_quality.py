from __future__ import annotations

import itertools
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash

from tidemark.llm.subword_quality import BUCKET_BITS, Model, features, held_out_quality, score_quality, scores_of, train
from tidemark.llm.tokens import texts_of, words_of

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    rows = held_out_quality(docs, labels).collect()
    quality = {r.doc_id: r.quality for r in labels.collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in quality]
    assert len(held) > 80 and np.mean([r.predicted == quality[r.doc_id] for r in held]) > 0.95


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet") for name in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 3 = 1, 1 - quality, quality) AS quality")
    assert sorted(held_out_quality(docs, labels).collect()) == sorted(held_out_quality(docs, turned).collect())


def test_features_count_words_grams_and_repetitions():
    texts = texts_of(pa.array(["ab cd ab ab", None, "", "x"]))
    owner, bucket = features(texts)
    # 4 words, 1 repetition, and the n-grams without a gap inside; nothing crosses into another text.
    threes = ["ab ", "b c", " cd", "cd ", "d a", " ab", "ab ", "b a", " ab"]
    fours = [" cd ", " ab "]
    kept = [g for g in threes if g[1] != " "] + fours
    assert (owner == 0).sum() == 4 + 1 + len(kept) and (owner == 3).sum() == 1
    assert bucket.max() < 1 << BUCKET_BITS and set(owner.tolist()) == {0, 3}


def test_the_score_is_that_of_the_mean_vector():
    model = Model(np.random.default_rng(1).normal(size=1 << BUCKET_BITS).astype(np.float32), 0.3)
    texts = texts_of(pa.array(["some text here", ""]))
    owner, bucket = features(texts)
    logit = model.worth[bucket[owner == 0]].astype(float).mean() + 0.3
    assert np.allclose(scores_of(texts, model), [1 / (1 + np.exp(-logit)), 1 / (1 + np.exp(-0.3))])


def test_training_without_both_labels_gives_the_share():
    row = (1, np.array([3], np.int32), np.array([1.0], np.float32))
    assert train([]).bias == 0 and train([row]).bias > 0 and not train([row]).worth.any()


def test_edges(spark):
    model = Model(np.ones(1 << BUCKET_BITS, np.float32), -0.5)
    rows = [(1, "good"), (1, "good"), (None, None), (2, ""), (3, "word " * 100_000)]
    docs = spark.createDataFrame([(*r, "x", "y") for r in rows], "doc_id INT, text STRING, score STRING, label STRING")
    found = score_quality(docs, model)
    assert found.columns == ["doc_id", "label", "score", "predicted"]
    assert sorted((str(r.doc_id), r.predicted) for r in found.collect()) == [("1", 1), ("1", 1), ("2", 0), ("3", 1), ("None", 0)]
    assert score_quality(docs.limit(0), model).collect() == []
    labels = spark.createDataFrame([(1, None), (None, 1), (99, 0)], "doc_id INT, quality INT")
    assert {r.score for r in held_out_quality(docs, labels).collect()} == {0.5}


def plain_features(text):
    """Buckets of the words, of repeated words and of the byte n-grams of one text, one by one."""
    data = (text or "").encode()
    folded = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in data)
    words = [w for w in folded.split(b" ") if w]
    found = [int(words_of(texts_of(pa.array([w.decode()]))).hashes[0]) >> (64 - BUCKET_BITS) for w in words]
    found += [1 for before, word in itertools.pairwise(words) if word == before]
    for size in (3, 4):
        for i in range(len(folded) - size + 1):
            gram = folded[i : i + size]
            if b" " not in gram[1:-1]:
                packed = int.from_bytes(bytes([size]) + gram, "big")
                found.append((packed * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> (64 - BUCKET_BITS))
    return Counter(found)


def test_the_whole_query_against_plain_descent(spark):
    """Some forty labelled rows: features, order, descent and scores in Python."""
    chance = random.Random(31)
    docs = []
    for i in range(70):
        words = [chance.choice(["good", "Prose", "été", "日本"] if i % 2 else ["buy", "CLICK", "now", "now"]) for _ in range(chance.randrange(0, 30))]
        docs.append((i, " ".join(words)))
    docs += [(70, None), (71, "")]
    labels = [(i, None if i % 9 == 0 else i % 2) for i in range(72)]
    held = {i for i, _ in docs if zlib.crc32(str(i).encode()) % 3 == 1}
    frame = spark.createDataFrame(docs, "doc_id BIGINT, text STRING").repartition(3)
    found = {r.doc_id: r for r in held_out_quality(frame, spark.createDataFrame(labels, "doc_id BIGINT, quality INT")).collect()}

    texts = dict(docs)
    learned = [(label, i) for i, label in labels if label is not None and i not in held]
    learned.sort(key=lambda row: (row[0], xxhash.xxh64_intdigest(struct.pack("<q", row[1]), 42) - (1 << 64 if xxhash.xxh64_intdigest(struct.pack("<q", row[1]), 42) >> 63 else 0)))
    draw = np.random.default_rng(5)
    vectors = draw.uniform(-1 / 16, 1 / 16, (1 << BUCKET_BITS, 16))
    outputs, bias, step = np.zeros((16, 2)), np.zeros(2), 0
    for _ in range(12):
        for at in draw.permutation(len(learned)):
            label, doc = learned[at]
            rate = 4.0 * (1 - step / (12 * len(learned)))
            step += 1
            counts = plain_features(texts[doc])
            parts = {b: n / counts.total() for b, n in counts.items()}
            mean = sum((p * vectors[b] for b, p in parts.items()), np.zeros(16))
            chances = np.exp(mean @ outputs + bias)
            error = chances / chances.sum() - np.eye(2)[label]
            back = outputs @ error
            outputs = outputs - rate * np.outer(mean, error)
            bias = bias - 0.01 * rate * error
            for b, p in parts.items():
                vectors[b] -= rate * p * back
    worth = vectors @ (outputs[:, 1] - outputs[:, 0])
    for i, text in docs:
        counts = plain_features(text)
        logit = sum(n * worth[b] for b, n in counts.items()) / max(1, counts.total()) + bias[1] - bias[0]
        assert found[i].held_out == (i in held) and abs(found[i].score - 1 / (1 + np.exp(-logit))) < 1e-3, i
