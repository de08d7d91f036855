from __future__ import annotations

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa

from tidemark.llm import cgk_leaks
from tidemark.llm.cgk_leaks import TARGET, allowed_edits, edit_distances, find_leaks, finder, index_items, sample_keys, walks_for, walks_tried, without_leaks

VOCABULARY = [f"{a}{b}" for a in "bcdfghklmnprst" for b in ("a", "e", "io", "unt", "ald")]


def distance(item, text):
    """Least edit distance between an item and any stretch of a text, word by word."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edited(words, edits, chance):
    words = list(words)
    for _ in range(edits):
        at, kind = chance.randrange(len(words)), chance.randrange(3)
        if kind == 0:
            words[at] = chance.choice(VOCABULARY)
        elif kind == 1:
            words.insert(at, chance.choice(VOCABULARY))
        elif len(words) > 1:
            del words[at]
    return words


def test_against_all_windows_of_all_documents(spark):
    chance = random.Random(3)
    items = [[chance.choice(VOCABULARY) for _ in range(chance.choice([3, 5, 9, 16, 30, 45, 70]))] for _ in range(40)]
    texts = []
    for i in range(300):
        words = [chance.choice(VOCABULARY) for _ in range(chance.randrange(1, 80))]
        if i % 2:
            item = chance.choice(items)
            at = chance.randrange(len(words))
            words[at:at] = edited(item, chance.randrange(0, len(item) // 5 + 2), chance)
        texts.append(words)
    docs = spark.createDataFrame(
        [(i, ", ".join(w.upper() if i % 3 else w for w in t), "x") for i, t in enumerate(texts)], "doc_id INT, text STRING, item STRING"
    )
    benchmark = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id BIGINT, text STRING")
    found = {(r.doc_id, r.item_id): r.distance for r in find_leaks(docs, benchmark).collect()}
    limits = allowed_edits(np.array([len(i) for i in items]), 0.2)
    expected = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(items):
            if (least := distance(item, text)) <= limits[i]:
                expected[d, i] = least
    assert set(found) <= set(expected)  # never a clean document
    assert len(found) >= 0.95 * len(expected)  # sampling may miss a few at the limit
    exact = {pair for pair, least in expected.items() if not least}
    assert exact <= set(found) and len(exact) > 20
    assert sum(found[pair] == expected[pair] for pair in found) >= 0.98 * len(found)


def test_distances_in_bulk():
    chance = random.Random(4)
    for _ in range(30):
        items = [[chance.randrange(1, 6) for _ in range(chance.randrange(1, 9))] for _ in range(5)]
        texts = [[chance.randrange(1, 6) for _ in range(12)] for _ in range(5)]
        lengths = np.array([len(i) for i in items])
        table = np.array([i + [0] * (9 - len(i)) for i in items], np.uint64)
        assert edit_distances(table, lengths, np.array(texts, np.uint64)).tolist() == [
            distance(i, t) for i, t in zip(items, texts, strict=True)
        ]


def test_equal_sequences_share_buckets_and_others_hardly_ever():
    random_ = np.random.default_rng(5)
    sequences = random_.integers(1, 1 << 63, (200, 40), dtype=np.uint64)
    lengths, rows, walk = np.full(200, 40), np.arange(200), np.zeros(200, np.int64)
    mine, other = sample_keys(sequences, lengths, rows, walk), sample_keys(sequences[::-1], lengths, rows, walk)
    assert (mine[::-1] == other).all() and (mine != 0).any(axis=1).all()
    assert ((mine == other) & (mine != 0)).mean() < 0.01


def test_recall_by_number_of_edits():
    """Against brute force, for every number of edits up to the limit, in a vocabulary of few and many words."""
    chance = random.Random(8)
    assert walks_tried(16, 0.2) <= walks_tried(128, 0.2) < 64
    hits, all_ = Counter(), Counter()
    items = [[f"{chance.choice(VOCABULARY)}{chance.randrange(5)}" for _ in range(n)] for n in (15, 20, 30, 45, 59, 90) for _ in range(12)]
    texts = []
    for item in items:
        for k in range(len(item) // 5 + 1):
            texts.append(["before", *edited(item, k, chance), "after", "it"])
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": [" ".join(t) for t in texts]})
    index = index_items(list(range(len(items))), [" ".join(i) for i in items], 0.2)
    found = {(r["doc_id"], r["item"]) for part in finder(index)(iter([batch])) for r in part.to_pylist()}
    at = 0
    for i, item in enumerate(items):
        for _ in range(len(item) // 5 + 1):
            least = distance(item, texts[at])
            all_[least] += 1
            hits[least] += (at, i) in found
            at += 1
    assert all(hits[k] >= 0.9 * n for k, n in all_.items() if n >= 10), (hits, all_)
    assert hits[0] == all_[0] and hits.total() >= (TARGET - 0.02) * all_.total()


def test_a_run_that_many_items_share_names_no_item():
    """A thousand items from one template: a document with the template alone meets none of them, one with an item meets it."""
    items = [f"which of the following is true {' '.join(f'w{i}x{j}' for j in range(12))}" for i in range(1000)]
    texts = ["which of the following is true " + "and so on and on and on it goes today", f"x {items[7]} y"]
    batch = pa.RecordBatch.from_pydict({"doc_id": [0, 1], "text": texts})
    index = index_items(list(range(1000)), items, 0.2)
    assert len(index.size) == 1000 * 12 + 4  # one posting for each run of the template's own words
    assert [tuple(r.values()) for part in finder(index)(iter([batch])) for r in part.to_pylist()] == [(1, 7, 0)]


def test_short_items_and_repeated_items(spark):
    benchmark = spark.createDataFrame([(i, "the whole of one sentence here") for i in range(2000)] + [(-1, "Zorblat"), (-2, "grün plumbus")], "item_id INT, text STRING")
    docs = spark.createDataFrame([(1, "so the whole of one sentence here"), (2, "a zorblat, and a GRÜN plumbus"), (3, "grün zorblats")], "doc_id INT, text STRING")
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark).collect()}
    assert found == {(1, i) for i in range(2000)}
    found = {(r.doc_id, r.item_id) for r in find_leaks(docs, benchmark, short_items=True).collect()}
    assert found == {(1, i) for i in range(2000)} | {(2, -1), (2, -2)}


def test_edges(spark):
    item = "the quick brown fox jumps over the lazy dog again and again today"
    rows = [(1, f"x {item} y"), (1, item), (None, item), (2, None), (3, ""), (4, "lazy dog"), (5, "word " * 30_000 + item), (6, item.upper())]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id BIGINT, text STRING, item_id STRING, distance STRING")
    benchmark = spark.createDataFrame([(10, item), (10, item), (11, None), (12, ""), (13, "lazy dog"), (None, item)], "item_id INT, text STRING")
    found = sorted(((r.doc_id, r.item_id, r.distance) for r in find_leaks(docs, benchmark).collect()), key=str)
    assert found == sorted([(d, i, 0) for d in (1, 5, 6, None) for i in (10, None)], key=str)
    left = without_leaks(docs, benchmark)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted([(None, item), (2, None), (3, ""), (4, "lazy dog")], key=str)
    assert find_leaks(docs.limit(0), benchmark).collect() == []
    none = find_leaks(docs, benchmark.limit(0))
    assert none.columns == ["doc_id", "item_id", "distance"] and none.collect() == []
    assert without_leaks(docs, benchmark.limit(0)).count() == len(rows)


def test_scripts_without_spaces_and_punctuation_beyond_ascii(spark):
    chinese, thai = "春眠不觉晓，处处闻啼鸟。夜来风雨声，花落知多少。", "สวัสดีชาวโลกวันนี้อากาศดีมาก"
    japanese, french = "吾輩は猫である。名前はまだ無いコーヒー", "« L’été — dit-il — n’était pas fini… »"
    items = [chinese, thai, japanese, french]
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id INT, text STRING")
    texts = [f"前文{chinese}后文", chinese.replace("风", "雪"), f"x {thai}{thai}", f"「{japanese}」", "avant L'été dit il n'était pas fini après",
             "春天来了，花都开了", "แมวนอนหลับ", "l’hiver était long", "Été—dit"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id INT, text STRING")
    found = {(r.doc_id, r.item_id, r.distance) for r in find_leaks(docs, benchmark).collect()}
    assert found == {(0, 0, 0), (1, 0, 1), (2, 1, 0), (3, 2, 0), (4, 3, 0)}


def test_one_long_item_among_many_short_ones_in_bounded_memory():
    """A table of all items, as wide as the longest, would take hundreds of megabytes."""
    chance = random.Random(10)
    items = [[f"{chance.choice(VOCABULARY)}{chance.randrange(90)}" for _ in range(12)] for _ in range(10_000)]
    long = [f"{chance.choice(VOCABULARY)}{chance.randrange(90)}" for _ in range(6_000)]
    texts = [" ".join(items[i] + items[i + 1]) for i in range(0, 2_000, 2)] + [" ".join(["x", *edited(long, 5, chance), "y"]), " ".join(long[:4_000])]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    walks_for(np.array([12, 6_000]), 0.2)  # tried once, beforehand
    tracemalloc.start()
    index = index_items(list(range(10_001)), [" ".join(i) for i in [*items, long]], 0.2)
    found = [tuple(r.values()) for part in finder(index)(iter([batch])) for r in part.to_pylist()]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 250 << 20
    assert {(d, i) for d, i, _ in found} >= {(i // 2, j) for i in range(0, 2_000, 2) for j in (i, i + 1)}
    assert {(d, i) for d, i, _ in found if i == 10_000} == {(1_000, 10_000)}
    assert all(least == 0 if i < 10_000 else least <= 5 for _, i, least in found)


def test_postings_and_windows_in_blocks(monkeypatch):
    """Budgets of a few words give what large ones give."""
    chance = random.Random(11)
    items = [" ".join(chance.choice("abcd") for _ in range(chance.randrange(3, 30))) for _ in range(30)]
    texts = [" ".join(chance.choice("abcd") for _ in range(chance.randrange(1, 90))) for _ in range(40)] + items
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})

    def found():
        parts = finder(index_items(list(range(30)), items, 0.2))(iter([batch]))
        return {tuple(r.values()) for part in parts for r in part.to_pylist()}

    expected = found()
    monkeypatch.setattr(cgk_leaks, "_CELLS", 50)
    monkeypatch.setattr(cgk_leaks, "_POSTINGS", 20)
    assert found() == expected and {(40 + i, i, 0) for i in range(30)} <= expected
