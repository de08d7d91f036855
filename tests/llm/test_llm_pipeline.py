"""Each stage on its own input, against a plain version of what it decides."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pytest

import corpus_pipeline as pipeline
from test_llm_cgk_leaks import distance
from test_llm_minmax_dedup import brute

SF = "/root/testdata/sf0.001"
STAGE = dict(pipeline.STAGES)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def results(spark):
    """Rows that each stage read and returned."""
    docs, found = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in pipeline.STAGES:
        before, docs = docs, pipeline.staged(stage(spark, docs, SF), name)
        found[name] = (before.collect(), docs.collect())
        if name != pipeline.STAGES[-1][0]:
            assert docs.columns == list(pipeline.COLUMNS)
    return found


def test_stages():
    assert [name for name, _ in pipeline.STAGES] == [
        "identify_language", "drop_near_duplicates", "drop_leaks", "mix_sources", "shard"
    ]
    assert pipeline.ORACLE_SQL is None


def test_clean_documents_pass_the_language_stage(results):
    before, after = results["identify_language"]
    assert sorted(before) == sorted(after)


def test_text_without_letters_or_language_goes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(-1, None), (-2, "123 456"), (-3, ""), (-4, "qzx xzq vkq " * 200), (-5, "the and")]
    added = spark.createDataFrame([(i, t, None, "s", 0) for i, t in odd], docs.schema)
    found = {r.doc_id for r in STAGE["identify_language"](spark, docs.unionByName(added), SF).collect()}
    assert {i for i, _ in odd} & found == {-5} and len(found) == docs.count() + 1


def test_short_foreign_and_junk_texts_go_and_clean_ones_stay(spark):
    """Letters of another language and random consonants, of 60 characters and more, beside cuts of clean documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chance = random.Random(8)
    russian = "".join(chance.choice("оеаинтсрвлкмдпуяыь      ") for _ in range(448))
    junk = "".join(chance.choice("bcdfghjklmnpqrstvwxz    ") for _ in range(428))
    strange = [t[:n] for t in (russian, junk) for n in (60, 100, 200, 428)] + [russian + russian]
    clean = [r.text[:n] for r in docs.orderBy("doc_id").limit(12).collect() for n in (5, 20, 60, 200)]
    added = [(-1 - i, t, None, "s", 0) for i, t in enumerate(strange)] + [(-101 - i, t, None, "s", 0) for i, t in enumerate(clean)]
    both = docs.unionByName(spark.createDataFrame(added, docs.schema))
    found = {r.doc_id for r in STAGE["identify_language"](spark, both, SF).collect()}
    assert not found & {-1 - i for i in range(len(strange))}
    assert {-101 - i for i, t in enumerate(clean) if re.search("[a-z]", t)} <= found and len(clean) > 40


def test_short_texts_of_a_language_of_many_letters_stay(spark):
    """Texts over thousands of letters share few trigrams with their language, however clean they are."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    chance = random.Random(9)
    chinese = [(-1 - i, "".join(chr(0x4E00 + int(chance.paretovariate(0.4)) % 4_000) for _ in range(150)), "zh", "s", 0) for i in range(60)]
    both = docs.unionByName(spark.createDataFrame(chinese, docs.schema))
    assert STAGE["identify_language"](spark, both, SF).count() == both.count()


def test_one_document_of_each_group_stays(results):
    before, after = results["drop_near_duplicates"]
    component = brute([(r.doc_id, r.text) for r in before], 5, 80)
    assert sorted(r.doc_id for r in after) == sorted(set(component.values()))
    assert len(after) < len(before)


def test_leaks_go_and_others_stay(spark, results):
    def plain(text):
        return re.findall(r"[^\s!-/:-@\[-`{-~]+", text.lower())

    before, after = results["drop_leaks"]
    items = [plain(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {r.doc_id for r in after}
    for r in before:
        text = plain(r.text)
        held = any(f" {' '.join(item)} " in f" {' '.join(text)} " for item in items)
        if held:
            assert r.doc_id not in left
        elif r.doc_id not in left:
            assert any(distance(item, text) <= len(item) // 5 for item in items)
    assert 0 < len(left) < len(before)


def test_the_mix_takes_words_near_the_targets(results):
    before, after = results["mix_sources"]
    texts = {r.doc_id: r for r in before}
    sizes, taken, copies = defaultdict(int), Counter(), Counter()
    for r in before:
        sizes[r.source] += len(words(r.text))
    for r in after:
        whole = texts[r.doc_id]
        assert whole.text.startswith(r.text) and r.n_chars == len(r.text)
        assert (r.lang, r.source) == (whole.lang, whole.source)
        taken[r.source] += len(words(r.text))
        copies[r.doc_id] += len(words(r.text))
    assert all(n <= 2 * len(words(texts[i].text)) for i, n in copies.items())
    assert abs(sum(taken.values()) - 1.5 * sum(sizes.values())) <= 16 * (len(sizes) + 1)


def test_shards_hold_all_rows(results):
    before, after = results["shard"]
    counts = Counter(r.shard for r in after)
    assert max(counts.values()) - min(counts.values()) <= 1 and len(after) == len(before)
    assert all(sorted(r.slot for r in after if r.shard == s) == list(range(n)) for s, n in counts.items())
    assert sorted(tuple(r[:5]) for r in after) == sorted(tuple(r) for r in before)


def test_run_is_all_stages(spark, results):
    assert sorted(pipeline.run(spark, SF).collect()) == sorted(results["shard"][1])


def test_empty_documents_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).collect() == []
    names = ["size", "score", "taken", "kept", "target", "source_size", "passes", "number", "_row", "_doc", "_version", "_text", "_length", "id", "place"]
    extra = docs.limit(40).selectExpr("*", *[f"'mine' AS `{name}`" for name in names])
    for name, stage in pipeline.STAGES:
        found = stage(spark, extra, SF)
        assert found.columns == [*extra.columns, *(["shard", "slot"] if name == "shard" else [])], name
        assert all(row[column] == "mine" for row in found.collect() for column in names), name


def test_null_columns(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    text = "the and of words that run on and on to the end of this line"
    docs = spark.createDataFrame([(None, text, None, None, None), (1, None, None, None, None), (2, text, "en", None, None)], schema)
    for _, stage in pipeline.STAGES:
        docs = pipeline.staged(stage(spark, docs, SF), "nulls")
    assert {r.doc_id for r in docs.collect()} <= {None, 2}
