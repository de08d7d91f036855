from __future__ import annotations

import random
from collections import Counter, defaultdict

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.llm.apportioned_mix import BLOCK, apportioned, mix, with_shards


def filled(sizes):
    """Targets by giving the excess of full sources to the others, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, rest, open_ = dict.fromkeys(names, 0.0), 1.5 * sum(sizes.values()), set(names)
    while rest > 1e-9 and open_:
        whole = sum(weights[s] for s in open_)
        target = {s: t + (rest * weights[s] / whole if s in open_ else 0) for s, t in target.items()}
        rest = sum(max(0, target[s] - 2 * sizes[s]) for s in names)
        target = {s: min(t, 2 * sizes[s]) for s, t in target.items()}
        open_ = {s for s in names if target[s] < 2 * sizes[s] - 1e-9}
    return target


def rows_of(seed):
    chance = random.Random(seed)
    sources = [None, "a", "b", "B", "é", "z", "tiny", "none"]
    rows = [(i, chance.choice(sources[:6]), chance.choice([0, 1, 20, 300, 5000]), "x", "y") for i in range(800)]
    return rows + [(900, "tiny", 7, "x", "y"), (901, "none", 0, "x", "y"), (None, "a", 40, "x", "y"), (902, "a", None, "x", "y")]


def test_targets_and_what_is_taken(spark):
    rows = rows_of(1)
    docs = spark.createDataFrame(rows, "doc_id INT, source STRING, size INT, target STRING, weight STRING")
    found = mix(docs, docs_per_shard=60).collect()
    assert len(found) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in found:
        sizes[r.source] += r["size"] or 0
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * (r["size"] or 0)
    expected = filled(sizes)
    for r in found:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - expected[r.source]) < 1e-6 * max(1, r.target)
    for source in sizes:
        assert abs(taken[source] - expected[source]) <= 5 * BLOCK


def test_reruns_agree_whatever_the_partitions(spark):
    rows = [*rows_of(2), (5, "a", 300, "x", "y"), (5, "a", 300, "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id INT, source STRING, size INT, target STRING, weight STRING")
    assert sorted(mix(docs).collect(), key=str) == sorted(mix(docs.repartition(5)).collect(), key=str)
    assert mix(docs).columns == ["doc_id", "source", "size", "weight", "source_size", "target", "taken"]


def test_empty_tables_and_sizes(spark):
    schema = "doc_id INT, source STRING, size INT"
    assert mix(spark.createDataFrame([], schema)).collect() == []
    assert [r.taken for r in mix(spark.createDataFrame([(1, None, 0), (2, "a", None)], schema)).collect()] == [0, 0]


def test_highest_quotients(spark):
    chance = random.Random(3)
    for _ in range(4):
        weights = [chance.choice([0, 1, 3, 50, 1000]) for _ in range(12)]
        seats = chance.randrange(1, 60)
        parties = spark.createDataFrame(list(enumerate(weights)), "name INT, weight BIGINT")
        found = {r.name: r.quota for r in apportioned(parties, "weight", F.lit(seats), [], ["name"]).collect()}
        quotients = sorted((-w / (2 * k + 1), i, k) for i, w in enumerate(weights) if w for k in range(seats))
        expected = dict.fromkeys(range(12), 0)
        for _, i, _ in quotients[:seats]:
            expected[i] += 1
        assert found == expected


def test_a_large_party_beside_many_small_ones(spark):
    parties = spark.createDataFrame([(0, 400.0), *[(i, 0.6) for i in range(1, 1001)]], "name INT, weight DOUBLE")
    found = {r.name: r.quota for r in apportioned(parties, "weight", F.lit(1000), [], ["name"]).collect()}
    quotients = sorted([(-400 / (2 * k + 1), 0) for k in range(1000)] + [(-0.6, i) for i in range(1, 1001)])
    assert found == {i: 0 for i in range(1001)} | Counter(i for _, i in quotients[:1000])
    assert found[0] == 333


def test_many_rows_without_an_id_are_spread_over_shards(spark):
    rows = [(None, "a", 10 + i % 7, f"text {i}") for i in range(3000)] + [(i, "a", 10, "x") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id INT, source STRING, size INT, text STRING")
    placed = docs.select(
        F.col("doc_id").alias("id"), F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("order"),
        F.xxhash64("text").alias("tie"), "size", F.lit(1).alias("source_rank"), F.lit(11).alias("shards"), F.lit(5).alias("quota"),
    )
    dealt, shards = with_shards(placed, 30)
    assert dealt.count() == 3300
    assert max(r.n_docs for r in shards.collect()) < 300
    found = mix(docs, docs_per_shard=30).collect()
    assert abs(sum(r.taken for r in found) - found[0].target) < 30 * BLOCK + 150 * BLOCK


def test_names_of_the_input_never_meet_its_own(spark):
    helpers = ("_quota", "_source", "_row", "quota", "shard", "order", "tie", "source_rank", "weight", "id", "part", "_order")
    frame = spark.createDataFrame([(1, "a", 40), (2, "b", 8)], "doc_id INT, source STRING, size INT")
    frame = frame.withColumns({name: F.lit("mine") for name in helpers})
    found = mix(frame)
    assert found.columns == [*frame.columns, "source_size", "target", "taken"]
    assert all(r[name] == "mine" for r in found.collect() for name in helpers)


def test_groups_are_apportioned_alone(spark):
    rows = [(g, i, 10 + i) for g in ("a", None) for i in range(5)]
    parties = spark.createDataFrame(rows, "g STRING, name INT, weight BIGINT")
    found = apportioned(parties, "weight", F.lit(7), ["g"], ["name"])
    total = F.sum("quota").over(Window.partitionBy("g"))
    assert [r[0] for r in found.select(total).distinct().collect()] == [7]
