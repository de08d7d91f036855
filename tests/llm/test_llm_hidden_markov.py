from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hidden_markov
from tidemark.llm.hidden_markov import Model, expected, log_chances, next_model, score_texts


def model_of(states, classes, seed):
    random_ = np.random.default_rng(seed)
    emit = random_.dirichlet(np.full(classes, 0.3), states).T
    return Model(random_.dirichlet(np.ones(states)), random_.dirichlet(np.ones(states), states), np.vstack([emit, np.zeros(states)]))


def plain_forward(seen, model):
    """Chances of states and what was seen so far, by step; no scaling."""
    now = [model.start[k] * model.emit[seen[0], k] for k in range(len(model.start))]
    steps = [now]
    for c in seen[1:]:
        now = [sum(now[i] * model.step[i, k] for i in range(len(now))) * model.emit[c, k] for k in range(len(now))]
        steps.append(now)
    return steps


def plain_counts(seen, model):
    """Expected counts by forward and backward chances, one step at a time."""
    states = range(len(model.start))
    ahead = plain_forward(seen, model)
    back = [[1.0 for _ in states]]
    for c in reversed(seen[1:]):
        back.insert(0, [sum(model.step[i, k] * model.emit[c, k] * back[0][k] for k in states) for i in states])
    whole = sum(ahead[-1])
    start, step, emit = np.zeros(len(states)), np.zeros((len(states), len(states))), np.zeros(model.emit.shape)
    for t, c in enumerate(seen):
        for k in states:
            belief = ahead[t][k] * back[t][k] / whole
            emit[c, k] += belief
            start[k] += belief if t == 0 else 0
            for i in states:
                step[i, k] += ahead[t - 1][i] * model.step[i, k] * model.emit[c, k] * back[t][k] / whole if t else 0
    return start, step, emit


@pytest.mark.parametrize("block", [1, 3, 7, 100])
def test_chances_and_counts_as_one_step_at_a_time(block):
    model, chance = model_of(3, 5, 1), np.random.default_rng(2)
    texts = [chance.integers(0, 5, n).tolist() for n in (1, 2, 3, 9, 30, 6, 1, 21, 7)]
    classes, sizes = np.concatenate(texts), np.array([len(t) for t in texts])
    likely = [math.log(sum(plain_forward(t, model)[-1])) for t in texts]
    assert np.allclose(log_chances(classes, sizes, model, block), likely, rtol=1e-12)
    found = expected(classes, sizes, model, block)
    for ours, theirs in zip(found, zip(*[plain_counts(t, model) for t in texts], strict=True), strict=True):
        assert np.allclose(ours, sum(theirs), rtol=1e-9)


def test_chances_of_all_texts_add_up_to_one():
    model = model_of(2, 3, 4)
    every = np.array([[a, b, c] for a in range(3) for b in range(3) for c in range(3)])
    assert math.isclose(np.exp(log_chances(every.ravel(), np.full(27, 3), model)).sum(), 1)


def test_each_round_makes_the_texts_likelier():
    model, shares = model_of(3, 6, 5), np.full(6, 1 / 6)
    classes, sizes = np.random.default_rng(6).integers(0, 6, 400) // 2, np.full(8, 50)
    before = -math.inf
    for _ in range(5):
        now = log_chances(classes, sizes, model, 16).sum()
        assert now >= before - 1e-9
        before, model = now, next_model(expected(classes, sizes, model, 16), shares, 1e-9)


def docs_of(seed, n=150):
    """Two languages that never mix, so that states have something to learn."""
    chance = random.Random(seed)
    known = [["un", "deux", "trois", "quatre", "cinq"], ["One", "two", "three", "four", "FIVE"]]
    rows = [(i, " ".join(chance.choice(known[i % 2]) for _ in range(chance.choice([3, 10, 40])))) for i in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n\t "), (n + 3, "never seen"), (None, "one two"), (4, "one"), (n + 4, "deux\x0bTWO " * 3000)]


def test_scores_and_base(spark):
    rows = docs_of(1)
    held = [i is not None and zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in rows]
    frame = spark.createDataFrame([(*r, h, 3) for r, h in zip(rows, held, strict=True)], "doc_id BIGINT, text STRING, score BOOLEAN, chunk INT")
    found = score_texts(frame.repartition(3), ~F.col("score"), states=3, classes=64, rounds=3).collect()
    tokens = [[*(t or "").lower().split(), None] for _, t in rows]
    counts = Counter(t for own, h in zip(tokens, held, strict=True) if not h for t in own)
    n, kinds = counts.total(), len(counts)
    expected_rows = sorted(
        (str(i), h, len(own), sum(t in counts for t in own), n, round(sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (kinds + 1))) for t in own), 6))
        for (i, _), h, own in zip(rows, held, tokens, strict=True)
    )
    ours = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found)
    assert ours == expected_rows
    out = [r for r in found if r.held_out and r.n_tokens == r.n_known and 5 < r.n_tokens < 100]
    assert out and sum(r.score for r in out) > sum(r.base_score for r in out) + 0.1 * sum(r.n_tokens for r in out)
    assert all(r.score < 0 for r in found)


def test_the_whole_query_against_plain_rounds(spark, monkeypatch):
    """Classes that hold one word each, all rows: the model of a plain Baum-Welch in Python."""
    rows = docs_of(3, 12)[:12]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)
    seen = {}
    monkeypatch.setattr(hidden_markov, "scorer", lambda model, words, real=hidden_markov.scorer: (seen.update(model=model, words=words), real(model, words))[1])
    found = {r.doc_id: r.score for r in score_texts(frame, F.lit(True), states=2, classes=1 << 12, rounds=2, prior=5.0, seed=9).collect()}
    model = hidden_markov.first_model(seen["words"].shares, 2, 9)
    number = hidden_markov.classes_of(np.array([hidden_markov.END]), 1 << 12)[0]
    batch = next(hidden_markov.encoder(iter(frame.select("doc_id", F.lit(True), "text").toArrow().to_batches())))
    kinds = hidden_markov.classes_of(hidden_markov._values(batch.column(4), 0), 1 << 12)
    assert len(set(kinds.tolist())) == 11 and number == 1 << 12
    codes, sizes = hidden_markov.codes_of(batch.column(3), 0), hidden_markov._values(batch.column(2), 0)
    texts = np.split(kinds[codes], np.cumsum(sizes)[:-1])
    for _ in range(2):
        start, step, emit = (sum(part) for part in zip(*[plain_counts(t.tolist(), model) for t in texts], strict=True))
        model = next_model(hidden_markov.Counts(start, step, emit), seen["words"].shares, 5.0)
    assert np.allclose(model.step, seen["model"].step, rtol=1e-3) and np.allclose(model.emit, seen["model"].emit, rtol=1e-3, atol=1e-6)
    counts = Counter(t for own in texts for t in own.tolist())
    for (doc, _), own in zip(rows, texts, strict=True):
        within = sum(math.log10((counts[t] + 0.5) / (counts[t] + 1)) for t in own.tolist() if t != number)
        assert math.isclose(found[doc], math.log10(sum(plain_forward(own.tolist(), seen["model"])[-1])) + within, rel_tol=1e-9)


def test_codes_come_back():
    codes = np.array([0, 1, 65535, 65536, 70_000, (1 << 31) - 1], np.int32)
    column = hidden_markov.pa.array([hidden_markov.packed_codes(codes)])
    assert hidden_markov.codes_of(column, 0).tolist() == codes.tolist()


def test_empty_tables_and_nothing_to_learn(spark):
    schema = "doc_id INT, text STRING"
    assert score_texts(spark.createDataFrame([], schema), F.lit(True), rounds=1, classes=16).collect() == []
    rows = score_texts(spark.createDataFrame([(1, "a b"), (2, None)], schema), F.lit(None).cast("boolean"), rounds=1, classes=16).collect()
    assert sorted((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in rows) == [(1, True, 3, 0, 0), (2, True, 1, 0, 0)]
    assert all(math.isfinite(r.score) and r.score < 0 for r in rows)
