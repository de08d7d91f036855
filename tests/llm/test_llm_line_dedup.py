from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.llm.line_dedup import drop_shared_lines

LINE = "this line is certainly longer than forty characters"


def run(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING, n_lines STRING, place STRING")
    found = drop_shared_lines(docs, **settings)
    assert sorted(found.columns) == ["doc_id", "n_dropped", "n_lines", "place", "text"]
    return sorted(((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found.collect()), key=str)


def test_shared_lines_stay_in_the_largest_id(spark):
    rows = [(i, f"own {i}\n  {LINE.upper()}\t\n{LINE}\nend", "x", "y") for i in range(5)]
    found = run(spark, rows)
    assert found[:4] == [(i, f"own {i}\nend", 4, 2) for i in range(4)]
    assert found[4] == (4, rows[4][1], 4, 0)


def test_four_documents_are_too_few_and_short_lines_never_count(spark):
    rows = [(i, f"{LINE}\n", "x", "y") for i in range(4)] + [(i, "short", "x", "y") for i in range(10, 20)]
    assert all(dropped == 0 for _, _, _, dropped in run(spark, rows))


def test_repeated_rows_nulls_and_empty_texts(spark):
    rows = [(1, LINE, "x", "y")] * 6 + [(None, LINE, "x", "y")] * 6 + [(2, None, "x", "y"), (3, "", "x", "y")]
    found = run(spark, rows)
    assert (2, None, 1, 0) in found and (3, "", 1, 0) in found
    assert all(dropped == 0 for _, _, _, dropped in found)  # one document and rows without identity
    assert len(found) == 14


def test_rows_that_repeat_an_id_with_another_text_lose_their_own_lines(spark):
    rows = [(i, LINE, "x", "y") for i in range(2, 7)] + [(1, f"a\n{LINE}", "x", "y"), (1, f"{LINE}\nb\nc", "x", "y")]
    found = run(spark, rows)
    assert [f for f in found if f[0] == 1] == [(1, "a", 2, 1), (1, "b\nc", 3, 1)]


def test_only_ascii_letters_fold(spark):
    rows = [(i, ("É" if i % 2 else "é") + LINE, "x", "y") for i in range(8)]
    assert all(dropped == 0 for _, _, _, dropped in run(spark, rows))


def test_empty_table(spark):
    assert run(spark, []) == []


def test_names_of_the_input_never_meet_its_own(spark):
    helpers = ("_doc", "_version", "_places", "doc", "version", "places", "of_doc", "_row")
    rows = [(i, "x" * 50 + f"\nown {i}") for i in range(6)]
    frame = spark.createDataFrame(rows, "doc_id INT, text STRING").withColumns({name: F.lit("mine") for name in helpers})
    found = drop_shared_lines(frame).collect()
    assert all(r[name] == "mine" for r in found for name in helpers)
    assert sorted(r.text for r in found) == [f"own {i}" for i in range(5)] + ["x" * 50 + "\nown 5"]
