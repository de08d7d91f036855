from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.quality_rules import Rule, _covered, cascade, in_order, judge, measured, sample_of

PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80))


def run(spark, texts, **settings):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, kept STRING, n_words STRING")
    return {r.doc_id: r for r in judge(docs, **settings).collect()}


def windows(text):
    words = text.split()
    runs = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({j for i, r in enumerate(runs) if runs.count(r) > 1 for j in (i, i + 1, i + 2)})


def test_counts_and_verdicts(spark):
    texts = [
        PROSE, None, "", "  \n\t ", PROSE + "\n" + PROSE, "a b c " * 40, PROSE.replace("a", "#"),
        PROSE + " one two three x one two three y two three one two three", "123 " * 20 + PROSE.replace("word", "77"),
    ]
    found = run(spark, texts)
    for i, text in enumerate(texts):
        assert found[i].n_repeat_words == windows(text or "")
        assert found[i].n_words == len((text or "").split())
        assert found[i].word_chars == len("".join((text or "").split()))
    assert [found[i].kept for i in range(9)] == [True, False, False, False, False, False, False, True, False]
    assert [found[i].base_failed for i in range(7)] == [False, True, True, True, True, True, False]


def test_a_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(60_000)) + " w1 w2 w3"
    found = run(spark, [text])[0]
    assert (found.n_words, found.n_repeat_words, found.n_dup_lines) == (60_003, 6, 0)


def test_an_empty_table(spark):
    assert run(spark, []) == {}


def test_repeated_rows_are_judged_alike(spark):
    found = run(spark, [PROSE, PROSE])
    assert found[0][3:] == found[1][3:]


def test_order_by_rejections_per_second_and_ties_keep_their_order():
    rules = [Rule(name, None) for name in "abcd"]
    costs = {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (1.0, 0.9), "d": (1.0, 0.1)}
    assert [rule.name for rule in in_order(rules, costs)] == ["b", "c", "a", "d"]


def test_the_first_rule_that_rejects_names_the_row(spark):
    rows = spark.createDataFrame([(1,), (5,), (9,), (None,)], "x INT")
    rules = [Rule("over8", F.col("x") > 8), Rule("over4", F.col("x") > 4)]
    assert [r[0] for r in rows.select(cascade(rules)).collect()] == [None, "over4", "over8", None]


def test_slow_rules_cost_more(spark):
    """Of two rules that reject the same rows, the one that does more work comes last, whatever their order and the machine's mood."""
    text = F.col("text")
    slow = Rule("slow", (F.length(F.regexp_replace(text, "[a-z]+", "x")) >= 0) & (F.col("n") % 4 == 0))
    fast = Rule("fast", F.col("n") % 4 == 0)
    frame = spark.createDataFrame([(i, f"words and words {i} " * 600) for i in range(64)], "n INT, text STRING")
    for turn in range(10):
        rules = [slow, fast] if turn % 2 else [fast, slow]
        costs = measured(frame, rules)
        assert [rule.name for rule in in_order(rules, costs)] == ["fast", "slow"], costs
        assert costs["slow"][1] == costs["fast"][1] == 0.25


def test_the_sample_covers_all_rows(spark):
    frame = spark.range(0, 20_000, numPartitions=8).selectExpr("id", "concat('text ', id) AS text", "map('a', id) AS more")
    one, other = ({r.id for r in sample_of(f, 200).collect()} for f in (frame, frame.repartition(5)))
    assert one == other and len(one) == 200
    assert len({i // 2_500 for i in one}) == 8


def test_names_of_the_input_never_meet_its_own(spark):
    helpers = ("_words", "_bits", "_packed", "_copy", "_order", "doc", "text_")
    frame = spark.createDataFrame([(1, "a b c a b c " * 30)], "doc_id INT, text STRING").withColumns({name: F.lit("mine") for name in helpers})
    (found,) = judge(frame).collect()
    assert all(found[name] == "mine" for name in helpers) and found.n_repeat_words == 180


def test_equal_hashes_of_other_words_are_no_repeat(spark):
    """The upper bits of a hash are few for a long text; here there are none."""
    frame = spark.createDataFrame([("a b c d e f g".split(),)], "found ARRAY<STRING>")
    packed = F.sort_array(F.transform(F.sequence(F.lit(0), F.size("found") - 3), lambda i: i.cast("bigint")))
    rows = frame.withColumns({"packed": packed, "bits": F.lit(8)}).select(_covered(F.col("packed"), F.col("bits"), F.col("found")))
    assert [r[0] for r in rows.collect()] == [0]
