from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm.importance_resampling import bucket_counts, drawn_documents, resample, runs_of
from tidemark.llm.radix_sort import radix_ranks
from tidemark.llm.tokens import texts_of

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return _WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def runs(text, width=2):
    words = words_of(text)
    return [" ".join(words[i : i + n]) for n in range(1, width + 1) for i in range(len(words) - n + 1)]


def bucket(run):
    return zlib.crc32(run.encode()) % 10_000


def plain(docs, target):
    corpus, aimed = (Counter(bucket(r) for t in texts for r in runs(t)) for texts in ([t for _, t in docs], target))
    s, t = corpus.total(), aimed.total()
    rows = []
    for i, text in docs:
        found = [math.floor(1000 * math.log((aimed[b] + 1) * (s + 10_000) / ((corpus[b] + 1) * (t + 10_000)))) for b in map(bucket, runs(text))]
        weight = sum(found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((i, len(found), weight, score, len(words_of(text)) >= 20))
    able = sorted((-r[3], r[0] is None, r[0] or 0) for r in rows if r[4])
    place = {(key[2], key[0]): n for n, key in enumerate(able[: 25 * len(able) // 100], 1)}
    return sorted(((*r[:4], place.get((r[0] or 0, -r[3])) if r[4] else None) for r in rows), key=str)


def corpus_of(seed, n=120):
    chance = random.Random(seed)
    known = [*"abcdefgh", "Straße", "ÉTÉ", "x1", "z" * 70, "y" * 300, "Über", "日本語"]
    gaps = [" ", "\n", ", ", "-", "\x00", "\x7f"]
    docs = [(i, "".join(chance.choice(known) + chance.choice(gaps) for _ in range(chance.choice([0, 5, 19, 20, 60])))) for i in range(n)]
    docs += [(n, None), (n + 1, ""), (n + 2, "... --"), (n + 3, "w " * 30_000), (n + 4, "q" * 100_000), (n + 5, docs[3][1])]
    return docs, ["a b Straße a b", "x1 x1 日本語", None, ""]


def test_as_one_document_at_a_time(spark):
    docs, target = corpus_of(1)
    rows = [(i, t, "u", 5, 6) for i, t in docs]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, rank STRING, id INT, _place INT")
    aim = spark.createDataFrame([(t, 1) for t in target], "text STRING, id INT")
    found = resample(frame.repartition(5), aim)
    expected = plain(docs, target)
    ours = found.select("doc_id", "n_features", "weight", "score", "rank").collect()
    assert sorted((tuple(r) for r in ours), key=str) == expected
    drawn = drawn_documents(frame, found)
    assert drawn.columns == frame.columns
    assert sorted(r.doc_id for r in drawn.collect()) == sorted(r[0] for r in expected if r[4] is not None)


def test_repeated_and_missing_ids_get_ranks_of_their_own(spark):
    text = " ".join("abcdefghijklmnopqrstuvwxyz")
    rows = [(1, text)] * 40 + [(1, text + " more")] * 4 + [(None, text)] * 20 + [(2, text.upper())] * 16
    frame = spark.createDataFrame(rows, "doc_id INT, text STRING")
    aim = spark.createDataFrame([("a b",)], "text STRING")
    one, other = (sorted(map(tuple, resample(frame.repartition(n), aim).collect()), key=str) for n in (1, 7))
    assert one == other
    assert sorted(r[-1] for r in one if r[-1]) == list(range(1, 21))


def test_empty_tables(spark):
    empty, aim = spark.createDataFrame([], "doc_id INT, text STRING"), spark.createDataFrame([("a",)], "text STRING")
    assert resample(empty, aim).collect() == []
    assert len(resample(spark.createDataFrame([(1, "b c")], "doc_id INT, text STRING"), empty).collect()) == 1
    assert bucket_counts(empty, "text").sum() == 0


def test_runs_of_any_width():
    docs, _ = corpus_of(2)
    texts = [t for _, t in docs if len(t or "") < 10_000]
    for width in (1, 2, 3):
        found, of, words = runs_of(texts_of(pa.array(texts, pa.string())), width)
        for i, text in enumerate(texts):
            assert Counter(found[of == i].tolist()) == Counter(bucket(r) for r in runs(text, width))
        assert words.tolist() == [len(words_of(t)) for t in texts]


def test_radix_ranks_are_those_of_a_sort(spark):
    chance = random.Random(4)
    ends = [(1 << 63) - 1, -(1 << 63), 0, 1, -1]
    rows = [(chance.choice(ends), chance.choice([5, 6, chance.randrange(-9999, 9999)]), i) for i in range(900)]
    for keys, bits in ((["a", "b"], 10), (["b", "a"], 16), (["b"], 3), (["c"], 10)):
        frame = spark.createDataFrame([(*r, 1) for r in rows], "a BIGINT, b BIGINT, i BIGINT, c BIGINT").coalesce(1)
        found = radix_ranks(frame, keys, "rank", bits=bits, block_rows=100).orderBy("rank").collect()
        assert [r["rank"] for r in found] == list(range(len(rows)))
        ordered = sorted(frame.collect(), key=lambda r: [r[k] for k in keys])
        assert [[r[k] for k in keys] for r in found] == [[r[k] for k in keys] for r in ordered]
        assert [r.i for r in found] == [r.i for r in ordered]  # stable
    assert radix_ranks(frame.limit(0), ["a"], "rank").collect() == []


def test_gains_are_whole_numbers(spark):
    frame = spark.createDataFrame([("a b c",)], "text STRING")
    counts = bucket_counts(frame, "text")
    assert counts.dtype == np.int64 and counts.sum() == 5
