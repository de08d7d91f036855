"""Words and shingles of many texts at once, against one text at a time."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm.tokens import joined, pieces, shingles, texts_of, words_of

LETTERS = st.text(alphabet=" \t\n\r\x0b\x0c\x1f\xa0aBbÉßz.,#0", max_size=40)


def plain(text: str | None) -> list[str]:
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x20\x09-\x0D]+", text or "")]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), max_size=6))
def test_words(texts):
    column = pa.array(texts, pa.string())
    read, words = texts_of(column), words_of(texts_of(column))
    found = [bytes(read.data[a:b]).decode() for a, b in zip(words.begin, words.end, strict=True)]
    assert found == [w for t in texts for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
    assert words.counts.tolist() == [len(plain(t)) for t in texts]
    hashes = {}
    for word, value in zip([w for t in texts for w in plain(t)], words.hashes.tolist(), strict=True):
        assert hashes.setdefault(word, value) == value
    assert len(set(hashes.values())) == len(hashes)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), LETTERS), max_size=6), st.integers(1, 4))
def test_shingle_sets(texts, width):
    sets = list(shingles(words_of(texts_of(pa.array(texts, pa.string()))), width))
    assert len(sets) == len(texts)
    for text, values in zip(texts, sets, strict=True):
        words = plain(text)
        runs = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
        assert len(values) == len(runs)
        assert (np.diff(values.astype(object)) > 0).all()


def test_pieces_hold_every_row_and_split_long_batches():
    texts = ["a b", None, "x " * 400_000, "", "c"] * 3
    batch = pa.RecordBatch.from_arrays([pa.array(range(15)), pa.array(texts)], names=["id", "text"])
    parts = list(pieces(iter([batch, batch.slice(0, 0)]), 1))
    assert len(parts) > 3
    assert [i for part, _ in parts for i in part.column(0).to_pylist()] == list(range(15))
    assert [n for _, t in parts for n in words_of(t).counts.tolist()] == [2, 0, 400_000, 0, 1] * 3


def test_runs_of_different_widths_differ():
    values = np.array([5, 6], np.uint64)
    assert joined(values, 2)[0] not in joined(values, 1)
    assert len(joined(values, 3)) == 0


def test_a_slice_of_a_column_is_read_from_its_own_start():
    column = pa.array(["one two", "three", None, "four five six"]).slice(1)
    assert words_of(texts_of(column)).counts.tolist() == [1, 0, 3]
