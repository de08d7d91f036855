"""Words of many texts at once, on the bytes of an Arrow column.

A batch is cut into pieces of a few hundred kilobytes, and each piece is one run of array
operations, whatever the number of texts in it. A text longer than a piece is a piece of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19

# The six bytes that part words.
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_random = np.random.default_rng(20_240_229)
_BYTE_VALUE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
# ASCII punctuation, which also parts words where a caller asks for it.
_IS_MARK = np.zeros(256, bool)
_IS_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_powers = np.ones(1, np.uint64)


def mixed(value: np.ndarray) -> np.ndarray:
    """A one-to-one scramble of 64-bit numbers."""
    value = (value ^ (value >> np.uint64(30))) * _M1
    value = (value ^ (value >> np.uint64(27))) * _M2
    return value ^ (value >> np.uint64(31))


def _powers_up_to(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 1024), _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps, dtype=np.uint64)
    return _powers


@dataclass
class Texts:
    """Bytes of consecutive texts; ``bounds[i]:bounds[i + 1]`` is text i."""

    data: np.ndarray
    bounds: np.ndarray

    def __len__(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of :class:`Texts` in order: hash, first byte, byte after the last, number of the text."""

    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    text: np.ndarray
    counts: np.ndarray  # words per text

    def firsts(self) -> np.ndarray:
        """Number of the first word of every text."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def texts_of(column: pa.Array) -> Texts:
    """Null counts as empty."""
    plain = column.cast(pa.large_binary()).fill_null(b"")
    bounds = np.frombuffer(plain.buffers()[1], np.int64)[plain.offset : plain.offset + len(plain) + 1]
    body = plain.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    return Texts(data[bounds[0] : bounds[-1]], bounds - bounds[0])


def pieces(
    batches: Iterator[pa.RecordBatch], text: int, size: int = PIECE_BYTES
) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Slices of the batches with the texts of column ``text``, of about ``size`` bytes each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = texts_of(batch.column(text))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(whole.bounds, whole.bounds[start] + size, "right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            low, high = whole.bounds[start], whole.bounds[stop]
            part = Texts(whole.data[low:high], whole.bounds[start : stop + 1] - low)
            yield batch.slice(start, stop - start), part
            start = stop


def words_of(texts: Texts, lower: bool = True, marks: bool = False) -> Words:
    """Words are runs without white space; with ``lower``, A-Z hash like a-z; with ``marks``, punctuation parts words too."""
    data, bounds = texts.data, texts.bounds
    n = len(data)
    none = np.zeros(0, np.int64)
    if not n:
        return Words(none.astype(np.uint64), none, none, none, np.zeros(len(texts), np.int64))
    inside = ~((IS_SPACE | _IS_MARK) if marks else IS_SPACE)[data]
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:n]
    ends[:-1] &= ~inside[1:] | edge[1:n]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    if not len(begin):
        return Words(none.astype(np.uint64), none, none, none, np.zeros(len(texts), np.int64))
    spans = np.diff(begin, append=n)
    place = np.arange(begin[0], n) - np.repeat(begin, spans)
    folded = LOWER[data[begin[0] :]] if lower else data[begin[0] :]
    weighed = _BYTE_VALUE[folded] * _powers_up_to(int(spans.max()) + 1)[place] * inside[begin[0] :]
    hashes = mixed(np.add.reduceat(weighed, begin - begin[0]))
    text = np.searchsorted(bounds, begin, "right") - 1
    return Words(hashes, begin, end, text, np.bincount(text, minlength=len(texts)))


def joined(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` hashes; runs of different widths differ."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    value = np.full(n, mixed(np.array([width], np.uint64))[0])
    for i in range(width):
        value = mixed(value * _BASE + hashes[i : i + n])
    return value


def shingles(words: Words, width: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its runs of ``width`` words; a shorter text is one run."""
    runs, firsts = joined(words.hashes, width), words.firsts()
    for first, count in zip(firsts[:-1], words.counts, strict=True):
        if count >= width:
            yield np.unique(runs[first : first + count - width + 1])
        elif count:
            yield joined(words.hashes[first : first + count], int(count))
        else:
            yield np.zeros(0, np.uint64)
