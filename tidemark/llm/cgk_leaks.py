"""Benchmark decontamination: passages within a small edit distance of a benchmark item.

Words of a text and of an item are compared, letters alone; in scripts that are written without spaces every character
is a word. Items, and item-sized windows of the texts, are embedded by
random walks (CGK): a walk reads a sequence, writes the word it stands on, and moves on by a random bit that
depends on the step and the word. Two sequences at a small edit distance fall into step again after each
edit, so their outputs have a small Hamming distance. Samples of a few output places are the keys of a bucket table of the
items; windows are looked up in it by their own samples, and the edit distance to what is found is computed exactly. An item
has as many walks as its length needs for the recall ``TARGET`` at the limit of its edits.

Windows stand where a text has a run of three words that some item has, as far into the window and as long as in such items. This
loses nothing: an item with at most k edits, cut in k + 1 pieces of three words or more, has a piece without an edit. The run
says where a window may stand, not which item it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.tokens import Texts, Words, joined, mixed, pieces, texts_of, words_of

ANCHOR = 3  # words of a shared run
EDITS = 0.2  # edits per word of an item, at most
TARGET = 0.98  # recall of items of a length at the limit of their edits, by which their walks are chosen
SAMPLES, PLACES = 6, 3  # samples per walk; output places per sample
MOST_WALKS = 64
TRIALS, LONGEST_TRIED = 60, 512  # pairs on which a number of walks is tried; longer items have the walks of this length
BLOCK_BYTES = 16 << 20  # benchmark text per pass over the documents
_CELLS = 1 << 20  # words of windows that wait, or are compared, at once
_POSTINGS = 1 << 20  # shared runs looked at at once
_FILTER_BITS = 20
_KEY_BASE = np.uint64(0xD6E8FEB86659FD93)

# Punctuation and white space beyond ASCII, and scripts without spaces between words.
_PARTS = r"[^\PP\x00-\x7F]|[^\PZ\x00-\x7F]|\x{85}"
_SCRIPTS = (
    "Han", "Hiragana", "Katakana", "Bopomofo", "Yi", "Thai", "Lao", "Khmer", "Myanmar", "Tai_Le", "New_Tai_Lue", "Tai_Tham",
    "Tai_Viet", "Javanese", "Balinese",
)
_UNSPACED = "([" + "".join(rf"\p{{{name}}}" for name in _SCRIPTS) + "])"

_random = np.random.default_rng(104_729)
_STEP_KEYS = _random.integers(0, 1 << 63, (MOST_WALKS, 4_096), dtype=np.uint64) | np.uint64(1)
_PLACES = _random.random((MOST_WALKS, SAMPLES * PLACES))


def samples_of(sequences: np.ndarray, lengths: np.ndarray, rows: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """Sampled outputs of walks ``walk`` over ``rows`` of ``sequences`` (0 after the end of a row), all step by step together."""
    pairs, steps = np.arange(len(rows)), 2 * int(lengths[rows].max())
    padded = np.concatenate([sequences, np.zeros((len(sequences), 1), np.uint64)], axis=1)
    places = (_PLACES[walk] * (2 * lengths[rows])[:, None]).astype(np.int64)
    out = np.zeros((len(rows), steps), np.uint64)
    at = np.zeros(len(rows), np.int64)
    for step in range(steps):
        turn, number = divmod(step, _STEP_KEYS.shape[1])  # long sequences use the keys in turn, times a number of the turn
        word = padded[rows, np.minimum(at, padded.shape[1] - 1)]
        out[:, step] = word
        at += (word * (_STEP_KEYS[walk, number] * np.uint64(2 * turn + 1)) >> np.uint64(63)).astype(np.int64)
    return out[pairs[:, None], places].reshape(len(rows), SAMPLES, PLACES)


def sample_keys(sequences: np.ndarray, lengths: np.ndarray, rows: np.ndarray, walk: np.ndarray) -> np.ndarray:
    """Bucket of every sample of walks over rows; 0 for a sample beyond the end of a sequence, which no bucket holds."""
    outputs = samples_of(sequences, lengths, rows, walk)
    number = np.arange(SAMPLES)[None, :] + walk[:, None] * SAMPLES + 1
    keys = mixed(lengths[rows].astype(np.uint64)[:, None] * _KEY_BASE + number.astype(np.uint64))
    for place in range(PLACES):
        keys = mixed(keys * _KEY_BASE + outputs[:, :, place])
    return np.where((outputs != 0).all(axis=2), keys | np.uint64(1), np.uint64(0))


@cache
def walks_tried(length: int, edits: float) -> int:
    """Walks with which seeded pairs of so many words, at the limit of their edits, share a bucket as often as ``TARGET`` asks."""
    chance = np.random.default_rng(length)
    allowed = int(allowed_edits(np.array([length]), edits)[0])
    first = chance.integers(1, 1 << 63, (TRIALS, length), dtype=np.uint64)
    other = np.zeros_like(first)
    for row, words in enumerate(first.tolist()):
        for at, kind in zip(chance.integers(0, length, allowed).tolist(), chance.integers(0, 3, allowed).tolist(), strict=True):
            at = min(at, len(words) - 1)
            words[at : at + (kind != 1)] = [] if kind == 2 and len(words) > 1 else [int(chance.integers(1, 1 << 63))]
        words += chance.integers(1, 1 << 63, length).tolist()  # what follows the passage
        other[row] = words[:length]
    lengths, rows, found = np.full(TRIALS, length), np.arange(TRIALS), np.zeros(TRIALS, bool)
    for walk in range(MOST_WALKS):
        mine, theirs = (sample_keys(words, lengths, rows, np.full(TRIALS, walk)) for words in (first, other))
        found |= ((mine == theirs) & (mine != 0)).any(axis=1)
        if found.mean() >= TARGET:
            return walk + 1
    return MOST_WALKS


def walks_for(lengths: np.ndarray, edits: float) -> np.ndarray:
    """Walks of items: those that the next power of two asks for."""
    sizes = np.minimum(1 << np.ceil(np.log2(np.maximum(lengths, 4))).astype(np.int64), LONGEST_TRIED)
    tried = {size: walks_tried(size, edits) for size in np.unique(sizes).tolist()}
    return np.array([tried[size] for size in sizes.tolist()], np.int64)


def bucket_keys(sequences: np.ndarray, lengths: np.ndarray, walks: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (of ascending lengths) and buckets of their samples; every row has its own number of walks, and some are taken at once."""
    rows = np.repeat(np.arange(len(walks)), walks)
    walk = np.arange(len(rows)) - np.repeat(np.cumsum(walks) - walks, walks)
    for some in groups(2 * lengths[rows], 4 * _CELLS):
        keys = sample_keys(sequences, lengths, rows[some], walk[some])
        held = keys != 0
        yield np.repeat(rows[some], SAMPLES).reshape(keys.shape)[held], keys[held]


def edit_distances(items: np.ndarray, lengths: np.ndarray, areas: np.ndarray) -> np.ndarray:
    """Least edit distance between each item and any stretch of its area (0 is no word in either)."""
    width = areas.shape[1]
    ramp = np.arange(width + 1)
    row = np.zeros((len(items), width + 1), np.int64)
    best = np.full(len(items), np.iinfo(np.int64).max)
    for i in range(int(lengths.max())):
        change = (areas != items[:, i : i + 1]) | (areas == 0)
        free = np.concatenate([row[:, :1] + 1, np.minimum(row[:, :-1] + change, row[:, 1:] + 1)], axis=1)
        row = np.minimum.accumulate(free - ramp, axis=1) + ramp
        ended = lengths == i + 1
        best[ended] = row[ended].min(axis=1)
    return best


def allowed_edits(lengths: np.ndarray, edits: float) -> np.ndarray:
    """Edits per item: its part of the words, and fewer where the anchors could not stay whole."""
    return np.maximum(0, np.minimum((lengths * edits).astype(np.int64), lengths // ANCHOR - 1))


@dataclass
class Items:
    """Benchmark items of one pass: their words, where windows may stand, and their buckets."""

    ids: np.ndarray
    words: np.ndarray  # of all items, one after the other
    begin: np.ndarray  # first word of every item
    lengths: np.ndarray
    edits: np.ndarray
    part: float  # edits per word
    sizes: np.ndarray  # distinct lengths
    walks: np.ndarray  # of items of these lengths
    anchors: np.ndarray  # distinct hashes of runs
    first: np.ndarray  # first posting of every anchor, and the end
    size: np.ndarray  # postings: number of the length in ``sizes``, and how far into such items the run stands
    offset: np.ndarray
    filter: np.ndarray
    buckets: np.ndarray  # distinct keys
    held: np.ndarray  # first item of every bucket in ``item``, and the end
    item: np.ndarray


def parted(texts: pa.Array) -> pa.Array:
    """Texts in lower case whose words ASCII white space and punctuation part."""
    lower = pc.utf8_lower(texts)
    if pc.all(pc.string_is_ascii(lower)).as_py() is not False:
        return lower
    return pc.replace_substring_regex(pc.replace_substring_regex(lower, _PARTS, " "), _UNSPACED, r" \1 ")


def index_items(ids: list, texts: list[str], edits: float, short: bool = False) -> Items:
    """The index of items; those under ``ANCHOR`` words are in it only if ``short``, and allow no edit."""
    words = words_of(texts_of(parted(pa.array(texts, pa.string()))), marks=True)
    lengths, firsts = words.counts, words.firsts()
    sizes, number = np.unique(lengths, return_inverse=True)
    runs, at = anchors_of(words, short)
    text = words.text[at]
    # One posting per run, length and offset, however many items agree in them.
    postings = np.unique(np.stack([runs, number[text].astype(np.uint64), (at - firsts[text]).astype(np.uint64)]), axis=1) if len(runs) else np.zeros((3, 0), np.uint64)
    distinct, first = np.unique(postings[0], return_index=True)
    known = np.zeros(1 << _FILTER_BITS, bool)
    known[distinct >> np.uint64(64 - _FILTER_BITS)] = True
    walks = walks_for(sizes, edits)
    keys, held, item = item_buckets(words.hashes, firsts[:-1], lengths, walks[number])
    return Items(
        np.array(ids, np.int64), words.hashes, firsts[:-1], lengths, allowed_edits(lengths, edits), edits, sizes, walks, distinct,
        np.append(first, postings.shape[1]), postings[1].astype(np.int64), postings[2].astype(np.int64), known, keys, held, item,
    )


def item_buckets(words: np.ndarray, begin: np.ndarray, lengths: np.ndarray, walks: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys, where their items begin, and the items."""
    keys, items = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    order = np.argsort(lengths, kind="stable")
    order = order[lengths[order] > 0]
    for some in groups(lengths[order]):
        group = order[some]
        for rows, found in bucket_keys(rows_of(words, begin[group], lengths[group]), lengths[group], walks[group]):
            keys.append(found)
            items.append(group[rows])
    key, item = np.concatenate(keys), np.concatenate(items)
    order = np.lexsort((item, key))
    distinct, first = np.unique(key[order], return_index=True)
    return distinct, np.append(first, len(order)), item[order]


def anchors_of(words: Words, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first word of every run of ``ANCHOR`` words that lies in one text; with ``short``, of shorter runs too."""
    found = []
    for width in range(1 if short else ANCHOR, ANCHOR + 1):
        runs = joined(words.hashes, width)
        at = np.flatnonzero(words.text[: len(runs)] == words.text[width - 1 :][: len(runs)]) if len(runs) else np.zeros(0, np.int64)
        found.append((runs[at], at))
    return np.concatenate([runs for runs, _ in found]), np.concatenate([at for _, at in found])


def windows_of(texts: Texts, items: Items, short: bool = False) -> Iterator[tuple[np.ndarray, ...]]:
    """Text, number of the length, and the words of the area around each distinct window where an item may stand."""
    words = words_of(texts, marks=True)
    runs, at = anchors_of(words, short)
    maybe = np.flatnonzero(items.filter[runs >> np.uint64(64 - _FILTER_BITS)])
    if not len(maybe) or not len(items.anchors):
        return
    place = np.searchsorted(items.anchors, runs[maybe])
    real = items.anchors[np.minimum(place, len(items.anchors) - 1)] == runs[maybe]
    at, place, firsts = at[maybe[real]], place[real], words.firsts()
    edits = allowed_edits(items.sizes, items.part)
    for text, size, start in distinct_windows(words, firsts, items, at, place):
        begin, wide = firsts[text] + start - edits[size], items.sizes[size] + 2 * edits[size]
        for some in chunks(wide):
            low, high = firsts[text[some]], firsts[text[some] + 1]
            yield text[some], size[some], stretches(words.hashes, begin[some], wide[some], low, high)


def distinct_windows(words: Words, firsts: np.ndarray, items: Items, at: np.ndarray, place: np.ndarray) -> Iterator[tuple]:
    """Text, number of the length and first word in the text of the windows at words ``at`` with anchors ``place``.

    Postings are taken in blocks; a window stands in more than one of the results only if those are long.
    """
    counts = items.first[place + 1] - items.first[place]
    span, number = int(words.counts.max(initial=0)) + 1, len(items.sizes)
    seen = np.zeros(0, np.int64)

    def numbered(keys: np.ndarray) -> tuple[np.ndarray, ...]:
        return keys // span // number, keys // span % number, keys % span

    for some in chunks(counts, _POSTINGS):
        many = counts[some]
        posting = np.repeat(items.first[place[some]] - np.cumsum(many) + many, many) + np.arange(many.sum())
        word, size = np.repeat(at[some], many), items.size[posting]
        text = words.text[word]
        room = np.maximum(0, words.counts[text] - items.sizes[size])
        start = np.clip(word - firsts[text] - items.offset[posting], 0, room)
        seen = np.unique(np.concatenate([seen, (text * number + size) * span + start]))
        if len(seen) >= _POSTINGS:
            yield numbered(seen)
            seen = seen[:0]
    if len(seen):
        yield numbered(seen)


def chunks(sizes: np.ndarray, total: int | None = None) -> Iterator[slice]:
    """Consecutive slices whose sizes add up to about ``total`` (``_CELLS``); a larger one is alone or the last of its slice."""
    ends = np.cumsum(sizes)
    cuts = np.flatnonzero(np.diff(ends // (total or _CELLS))) + 1
    edges = [0, *cuts.tolist(), len(sizes)]
    return (slice(low, high) for low, high in zip(edges[:-1], edges[1:], strict=True) if low < high)


def groups(sizes: np.ndarray, total: int | None = None) -> Iterator[slice]:
    """Consecutive slices of ascending sizes, whose rows, all as wide as the last, have about ``total`` (``_CELLS``) cells; one row at least."""
    total, start = total or _CELLS, 0
    while start < len(sizes):
        most = sizes[start : start + total // max(1, int(sizes[start])) + 1]
        stop = start + max(1, int(np.searchsorted(np.arange(1, len(most) + 1) * most, total, "right")))
        yield slice(start, stop)
        start = stop


def stretches(words: np.ndarray, begin: np.ndarray, size: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``size`` words from each ``begin``, one stretch after the other; 0 outside of ``low`` to ``high``."""
    where = np.repeat(begin - np.cumsum(size) + size, size) + np.arange(size.sum())
    inside = (where >= np.repeat(low, size)) & (where < np.repeat(high, size))
    return np.where(inside, words[np.clip(where, 0, len(words) - 1)], np.uint64(0))


def rows_of(words: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """A row for each stretch of ``size`` words from ``begin``, 0 after its end."""
    step = np.arange(int(size.max()))[None, :]
    return np.where(step < size[:, None], words[np.minimum(begin[:, None] + step, len(words) - 1)], np.uint64(0))


def finder(items: Items, short: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``doc_id, item, distance`` of (doc_id, text) batches."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple] = []
        for batch, _ in pieces(batches, 1):
            texts = texts_of(parted(batch.column(1)))
            for text, size, area in windows_of(texts, items, short):
                waiting.append((batch.column(0).take(pa.array(text)), size, area))
                if sum(len(w[2]) for w in waiting) >= _CELLS:
                    yield from judged(waiting, items)
                    waiting = []
        if waiting:
            yield from judged(waiting, items)

    return find


def judged(waiting: list[tuple], items: Items) -> Iterator[pa.RecordBatch]:
    """Windows that share a bucket with an item and are within its edits.

    Windows are embedded in groups about as long, so that long ones do not widen the rows of short ones.
    """
    docs = pa.concat_arrays([w[0] for w in waiting])
    size, areas = np.concatenate([w[1] for w in waiting]), np.concatenate([w[2] for w in waiting])
    lengths, edits = items.sizes[size], allowed_edits(items.sizes, items.part)[size]
    wide = lengths + 2 * edits
    begin = np.cumsum(wide) - wide
    order = np.argsort(wide, kind="stable")
    for place in groups(wide[order]):
        group = order[place]
        windows = rows_of(areas, begin[group] + edits[group], lengths[group])
        rows, item = met(windows, lengths[group], items.walks[size[group]], items)
        for some in groups(wide[group[rows]]):
            window, which = group[rows[some]], item[some]
            theirs = rows_of(items.words, items.begin[which], lengths[window])
            distance = edit_distances(theirs, lengths[window], rows_of(areas, begin[window], wide[window]))
            near = np.flatnonzero(distance <= edits[window])
            columns = [docs.take(pa.array(window[near])), pa.array(items.ids[which[near]]), pa.array(distance[near])]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item", "distance"])


def met(windows: np.ndarray, lengths: np.ndarray, walks: np.ndarray, items: Items) -> tuple[np.ndarray, np.ndarray]:
    """Distinct windows and items of their length that share a bucket, windows in their order."""
    number, pairs = len(items.lengths), np.zeros(0, np.int64)
    for rows, keys in bucket_keys(windows, lengths, walks):
        place = np.searchsorted(items.buckets, keys)
        real = items.buckets[np.minimum(place, len(items.buckets) - 1)] == keys if len(items.buckets) else np.zeros(len(keys), bool)
        rows, place = rows[real], place[real]
        many = items.held[place + 1] - items.held[place]
        for some in chunks(many, _POSTINGS):
            own = many[some]
            posting = np.repeat(items.held[place[some]] - np.cumsum(own) + own, own) + np.arange(own.sum())
            pairs = np.unique(np.concatenate([pairs, np.repeat(rows[some], own) * number + items.item[posting]]))
    rows, item = pairs // number, pairs % number
    same = items.lengths[item] == lengths[rows]
    return rows[same], item[same]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    edits: float = EDITS,
    short_items: bool = False,
) -> DataFrame:
    """``doc_id, item_id, distance`` per document and benchmark item that it holds.

    Distance counts words changed, added or left out, against the best stretch of the document; it is at most
    ``edits`` of the item's words (fewer for items under fifteen words: n // 3 - 1). Words are in lower case
    and without punctuation; a character of a script without spaces (Chinese, Japanese, Thai) is a word. Sampling may miss
    an item near that limit; ``tests`` measure the recall by the number of edits.

    Items of one or two words are searched only with ``short_items``, and then as they are: clean documents hold them too. Null and empty texts
    hold nothing. Rows with a null document id are reported under a null id; rows that repeat an
    id are reported once per item with the least distance; benchmark rows that repeat an id
    likewise. Equal items are searched once, however often they stand there. Other columns are not read. The benchmark is read
    in blocks of ``BLOCK_BYTES``, each of which is one pass over the documents with an index of bounded size; an item is told by a
    64-bit hash of its text. Empty tables give an empty table.
    """
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    asked = benchmark.filter(F.col("text").isNotNull()).select(F.col(f"`{item_id}`").alias("item_id"), "text", F.xxhash64("text").alias("item"))
    texts = staged(asked.groupBy("item").agg(F.any_value("text").alias("text")), "items")
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_BYTES))
    kinds = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, item BIGINT, distance BIGINT"
    found = rows.select("doc_id", F.lit(0).cast("bigint").alias("item"), F.lit(0).cast("bigint").alias("distance")).limit(0)
    for block in range(blocks):
        taken = texts.filter(F.pmod("item", F.lit(blocks)) == block).orderBy("item").collect()
        items = index_items([row["item"] for row in taken], [row["text"] for row in taken], edits, short_items)
        if len(items.anchors):
            met_here = rows.mapInArrow(finder(items, short_items), kinds)
            found = met_here if block == 0 else found.unionByName(met_here)
    named = found.join(asked.select("item", "item_id"), "item")
    return named.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; rows with a null id stay (they cannot be named)."""
    leaked = find_leaks(docs, benchmark, text, doc_id).select(F.col("doc_id").alias(doc_id)).distinct()
    leaked = staged(leaked, "leaked")  # its real size decides whether the documents move to meet it
    return docs.join(leaked, doc_id, "left_anti").select(*docs.columns)
