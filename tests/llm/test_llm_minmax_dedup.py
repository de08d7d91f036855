from __future__ import annotations

import random

import numpy as np
import pytest

import pyarrow as pa
from pyspark.sql import functions as F

from tidemark.llm import minmax_dedup
from tidemark.llm.components import stars
from tidemark.llm.minmax_dedup import MARKS, _meeting, drop_near_duplicates, marker, min_max, n_bands, near_duplicates, permutations

SCHEMA = "doc_id BIGINT, text STRING, node STRING, kept STRING"


def shingled(text, width):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def brute(rows, width, percent):
    """Component per id, by comparing all pairs."""
    sets = {i: shingled(t, width) for i, t in rows}
    name = {i: i for i in sets}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            common = len(sets[a] & sets[b])
            if a < b and sets[a] and sets[b] and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                high, low = max(root(a), root(b)), min(root(a), root(b))
                name[high] = low
    return {i: root(i) for i in ids}


def edited(words, share, chance, vocabulary):
    return " ".join(chance.choice(vocabulary) if chance.random() < share else w for w in words)


def corpus(seed):
    """Families of copies, some of them so far apart that only a part of their pairs is linked."""
    chance = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(6):
        base = [chance.choice(vocabulary) for _ in range(chance.randint(20, 120))]
        texts += [" ".join(base)] * 3
        texts += [edited(base, chance.choice([0.005, 0.02, 0.04, 0.08]), chance, vocabulary[:40]) for _ in range(40)]
    texts += ["one", "ONE", "one two", "one two three", None, "", " \n", "Éa bc de", "éa bc de"]
    chance.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize(("seed", "width", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_against_all_pairs(spark, seed, width, percent):
    rows = corpus(seed)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    found = {r.doc_id: r for r in near_duplicates(docs, width=width, percent=percent).collect()}
    expected = brute(rows, width, percent)
    assert {i: r.component_id for i, r in found.items()} == expected
    assert {i: r.n_shingles for i, r in found.items()} == {i: len(shingled(t, width)) for i, t in rows}
    assert all(r.kept == (i == r.component_id) for i, r in found.items())


def test_repeated_rows_null_ids_and_one_of_each_group(spark):
    text = " ".join(f"w{i}" for i in range(50))
    rows = [(7, text), (7, text), (3, text), (None, text), (None, text), (9, None), (9, None), (4, "other"), (4, "texts")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    judged = near_duplicates(docs).collect()
    assert len(judged) == len(rows)
    assert all(r.component_id is None and r.kept for r in judged if r.doc_id is None)
    assert {r.component_id for r in judged if r.doc_id in (3, 7)} == {3}
    left = drop_near_duplicates(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(
        [(3, text), (None, text), (None, text), (9, None), (4, "other"), (4, "texts")], key=str
    )


def test_empty_table_and_a_very_long_text(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    long = " ".join(f"w{i}" for i in range(80_000))
    docs = spark.createDataFrame([(1, long, "x", "y"), (2, long + " end", "x", "y")], SCHEMA)
    assert [r.component_id for r in near_duplicates(docs).collect()] == [1, 1]


def test_min_and_max_estimate_the_overlap_without_bias():
    random_ = np.random.default_rng(1)
    factors, shifts = permutations(64)
    errors = []
    for _ in range(60):
        values = random_.integers(0, 1 << 63, 900, dtype=np.uint64)
        (low_a, high_a), (low_b, high_b) = (min_max(v, factors, shifts) for v in (values[:800], values[100:]))
        agree = np.concatenate([low_a == low_b, high_a == high_b])
        errors.append(agree.mean() - 700 / 900)
    assert abs(np.mean(errors)) < 0.01
    assert np.std(errors) < 0.05


def test_bands_miss_almost_nothing():
    assert (1 - 0.85**4) ** n_bands(85) <= 1e-7 and (1 - 0.8**4) ** n_bands(80) <= 1e-7


@pytest.mark.parametrize("seed", [1, 2])
def test_components_against_union_find(spark, seed):
    chance = random.Random(seed)
    links = [(chance.randrange(300), chance.randrange(300)) for _ in range(220)]
    links += [(i, i + 1) for i in range(1000, 1090)] + [(2000, 2000 + i) for i in range(1, 60)] + links[:20]
    name = {i: i for pair in links for i in pair}

    def root(i):
        while name[i] != i:
            i = name[i]
        return i

    for a, b in links:
        high, low = max(root(a), root(b)), min(root(a), root(b))
        name[high] = low
    found = stars(spark.createDataFrame(links, "u BIGINT, v BIGINT")).collect()
    assert {r.u: r.v for r in found} == {i: root(i) for i in name if root(i) != i}
    assert len(found) == len({r.u for r in found})


def beginnings(spark, docs):
    """Beginnings of sets as the join gets them: 86 tokens that all sets hold after some of their own, of a hundred."""
    return spark.range(docs).selectExpr("id AS place", "id AS label", "100L AS n", "explode(sequence(0, 3)) AS t").selectExpr(
        "CAST(t AS BIGINT) AS token", "place", "label", "n", "CAST(15 + t AS BIGINT) AS at"
    )


def test_a_hot_token_of_sets_below_the_threshold_joins_nothing(spark):
    """However many sets hold it: 14 own tokens of 100 leave 86 / 114 of the union, less than 80 %."""
    for docs in (4_000, 64_000):
        begin = beginnings(spark, docs)
        most = F.floor((F.col("n") - F.col("at") + 1) * 180 / 80) - F.col("n")
        assert begin.filter(most >= F.col("n")).isEmpty()  # the left side of the join
        assert _meeting(begin, 80).isEmpty()
    alike = beginnings(spark, 30).withColumn("at", F.col("at") - 4)
    assert _meeting(alike, 80).distinct().count() == 30 * 29 // 2


def test_sets_that_meet_are_all_that_can_reach_the_threshold(spark):
    chance = random.Random(17)
    rows = [(chance.randrange(3), i, i // 2, n := chance.randrange(1, 40), chance.randrange(1, n + 1)) for i in range(150)]
    begin = spark.createDataFrame(rows, "token BIGINT, place BIGINT, label BIGINT, n BIGINT, at BIGINT")
    for percent in (50, 80, 85, 100):
        found = {tuple(sorted(r)) for r in _meeting(begin, percent).collect()}
        expected = set()
        for token, u, label, n, at in rows:
            for other, v, label_v, n_v, at_v in rows:
                common = 1 + min(n - at, n_v - at_v)
                if u < v and token == other and label != label_v and (100 + percent) * common >= percent * (n + n_v) and 100 * min(n, n_v) >= percent * max(n, n_v):
                    expected.add((u, v))
        assert found == expected


@pytest.mark.parametrize("center", [True, False])
def test_a_group_of_edited_copies_makes_few_pairs(spark, monkeypatch, center):
    """Copies edited in places of their own, just too often to be linked: what each lacks, nearly all the others have."""
    chance, judged, confirmed = random.Random(3), [], minmax_dedup._confirmed
    base = [f"w{i}" for i in range(150)]
    rows = [(0, " ".join(base))] if center else []
    while len(rows) < 300:
        words = list(base)
        for place in chance.sample(range(3, 147), 4):
            words[place] = f"x{chance.randrange(1 << 40)}"
        rows.append((len(rows), " ".join(words)))
    rows += [(1_000 + i, rows[i][1].replace("w0 ", "y ")) for i in range(1, 6)]

    def counted(*given):
        found = confirmed(*given)
        judged.append(found.count())
        return found

    monkeypatch.setattr(minmax_dedup, "_confirmed", counted)
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], SCHEMA)
    found = {r.doc_id: r.component_id for r in near_duplicates(docs, width=3, percent=85).collect()}
    assert found == brute(rows, 3, 85)
    assert judged[-1] < 5 * len(rows) and sum(judged) < 2 * n_bands(85) * len(rows)


def test_marks_never_differ_in_more_bits_than_the_sets_in_tokens():
    random_ = np.random.default_rng(2)
    for size, changed in ((1, 1), (40, 3), (40, 40), (5_000, 10), (5_000, 4_000)):
        one = random_.integers(0, 1 << 63, size, dtype=np.uint64)
        other = np.concatenate([one[changed:], random_.integers(0, 1 << 63, changed // 2, dtype=np.uint64)])
        batch = pa.RecordBatch.from_arrays([pa.array([7, 8]), pa.array([one.tobytes(), other.tobytes()], pa.binary())], names=["place", "members"])
        (found,) = marker([batch])
        assert found.schema.names == ["place", *MARKS] and found.column(0).to_pylist() == [7, 8]
        bits = np.array([found.column(c).to_numpy() for c in MARKS]).T.copy().view(np.uint8)
        apart = int(np.unpackbits(bits[0] ^ bits[1]).sum())
        differ = changed + changed // 2
        assert apart <= differ and apart % 2 == differ % 2
        assert apart == differ or differ > 2
